"""Quality rules as a short-circuit cascade.

Every rule is a predicate on the text and its words.  On a bounded sample the cost (seconds a row) and the selectivity
(share of rows rejected) of each rule are measured; the cascade then asks the rules in the order of rejections per
cost, and a row that one rule rejects is not shown to the next.  The order changes the work, never the verdict: a
document is kept when no rule rejects it.

All of it is Spark SQL expressions.  Rows: a null text counts as empty; an empty text has zero words and fails the
base rules; a very long text is judged whole, and not by its length; rules of equal gain are asked in the order of their
costs, then as given (ties); an empty table gives no rows; repeated rows are judged each; extra columns, also of the names used here, stay as they are (`quality_filter`)
or are not looked at (`quality_report`).
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.llm._tables import WORD_BREAKS, let, stored

WORD_BREAK_RUN = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 8
#: Words in a run of `distinct_words`.
RUN = 1000
#: Times that the sample is shown to a rule, at most, until that takes some times as long as showing it to none.
MOST_SHOWN = 16
CLEAR = 2
#: Rows, on average, of the sample on which rules are measured.
SAMPLE_ROWS = 1000


def words_of(text: Column) -> Column:
    """The words of a text: runs of characters other than \\x20 and \\x09-\\x0D."""
    return F.filter(F.split(text, WORD_BREAK_RUN), lambda w: w != "")


def written_lines(text: Column) -> Column:
    """The \\n-split lines that have a word."""
    return F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(WORD_BREAKS)) != "")


def _joined(hashes: Column, step: int) -> Column:
    """Hashes of runs twice as long: each hash with the one ``step`` places on (at the end with none)."""
    return let(hashes, lambda h: F.zip_with(h, F.slice(h, step + 1, F.size(h)), lambda a, b: F.xxhash64(a, b)))


def repeated_words(words: Column) -> Column:
    """Words that lie in an 8-word window found twice or more in the text."""
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    for step in (1, 2, 4):
        hashes = _joined(hashes, step)
    windows = let(hashes, lambda h: F.slice(h, 1, F.greatest(F.size(h) - (WINDOW - 1), F.lit(0))))

    def covered(window: Column) -> Column:
        placed = F.sort_array(F.transform(window, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
        twice = let(
            placed,
            lambda s: F.zip_with(s, F.slice(s, 2, F.size(s)), lambda a, b: F.when(a["x"] == b["x"], F.array(a["i"], b["i"])).otherwise(F.array().cast("array<int>"))),
        )
        starts = F.sort_array(F.array_distinct(F.flatten(twice)))
        # least() ignores the null behind the last start, which so adds a whole window
        return let(starts, lambda s: F.aggregate(F.zip_with(s, F.slice(s, 2, F.size(s)), lambda a, b: F.least(b - a, F.lit(WINDOW))), F.lit(0), lambda n, x: n + x))

    return let(windows, lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(covered(w)))


def duplicate_lines(text: Column) -> Column:
    return let(written_lines(text), lambda lines: F.size(lines) - F.size(F.array_distinct(lines)))


def distinct_words(words: Column) -> Column:
    """The number of distinct words in each run of ``RUN`` words, added up: a share of the words that does not fall with length."""
    starts = F.when(F.size(words) > 0, F.sequence(F.lit(1), F.size(words), F.lit(RUN))).otherwise(F.array().cast("array<int>"))
    return F.aggregate(starts, F.lit(0), lambda n, at: n + F.size(F.array_distinct(F.slice(words, at, F.lit(RUN)))))


@dataclass(frozen=True)
class Rule:
    """``rejects(text, words)``: a boolean column that is never null."""

    name: str
    rejects: Callable[[Column, Column], Column]


def _word_chars(words: Column) -> Column:
    return F.length(F.array_join(words, ""))


BASE_RULES = [
    Rule("few_words", lambda text, words: F.size(words) < 20),
    Rule("repeated_windows", lambda text, words: 100 * repeated_words(words) > 30 * F.size(words)),
]
#: Loose limits, so that ordinary prose of any language stays.
METHOD_RULES = [
    Rule("symbols", lambda text, words: 4 * F.regexp_count(text, F.lit(SYMBOLS)) > F.size(words)),
    Rule("shouting", lambda text, words: 5 * F.regexp_count(text, F.lit("[A-Z]")) > 2 * _word_chars(words)),
    Rule("word_length", lambda text, words: let(_word_chars(words), lambda n: (n < 2 * F.size(words)) | (n > 14 * F.size(words)))),
    Rule("duplicate_lines", lambda text, words: let(written_lines(text), lambda x: 10 * (F.size(x) - F.size(F.array_distinct(x))) > 5 * F.size(x))),
    Rule("few_distinct_words", lambda text, words: 20 * distinct_words(words) < F.size(words)),
]


@dataclass(frozen=True)
class Measured:
    rule: Rule
    seconds_a_row: float
    rejected: float

    @property
    def gain(self) -> float:
        return self.rejected / max(self.seconds_a_row, 1e-9)


def measure_rules(df: DataFrame, rules: list[Rule], *, text: str = "text", sample_rows: int = SAMPLE_ROWS) -> list[Measured]:
    """Cost and selectivity of each rule on a sample of about ``sample_rows`` rows, in the order of the cascade.

    A rule's cost is measured over the sample as often as it takes to stand out from a job without a rule.  Rules are then
    chosen one after the other by the rejections, among sampled rows that no rule before rejects, for their cost; ``rejected``
    is that share.  An empty sample measures nothing and leaves the rules in their order.
    """
    total = df.count()
    if not total:
        return [Measured(rule, 0.0, 0.0) for rule in rules]
    few = df.select(F.coalesce(df[text], F.lit("")).alias("text"))
    few = few.sample(fraction=min(1.0, sample_rows / total), seed=11) if total > sample_rows else few
    # one task, so that its time is the rules' time; with the words made before
    few = stored(few.repartition(1).select("text", words_of(F.col("text")).alias("words")))
    text_, words = F.col("text"), F.col("words")

    def run(rejects: Column, times: int) -> float:
        shown = few.select("text", "words", F.explode(F.sequence(F.lit(1), F.lit(times))))
        began = time.perf_counter()
        shown.agg(F.count_if(rejects)).first()
        return time.perf_counter() - began

    idle: dict[int, float] = {}

    def cost(rule: Rule) -> float:
        times = 1
        while True:
            if times not in idle:
                idle[times] = min(run(F.size(words) < 0, times) for _ in range(2 if times == 1 else 1))
            more = min(run(rule.rejects(text_, words), times) for _ in range(2 if times == 1 else 1)) - idle[times]
            if more >= CLEAR * idle[1] or times >= MOST_SHOWN:
                return max(more, 1e-4) / times
            times *= 4

    # how many sampled rows which rules reject: at most two to the power of the rules
    verdicts = few.select(*[rule.rejects(text_, words).alias(f"r{k}") for k, rule in enumerate(rules)])
    seen = [tuple(r) for r in verdicts.groupBy(*verdicts.columns).count().collect()]
    n = sum(r[-1] for r in seen)
    costs = [cost(rule) / max(n, 1) for rule in rules] if n else [0.0] * len(rules)
    left, alive, measured = list(range(len(rules))), seen, []
    while left:
        size = sum(r[-1] for r in alive)
        shares = {k: sum(r[-1] for r in alive if r[k]) / size if size else 0.0 for k in left}
        best = max(left, key=lambda k: (shares[k] / max(costs[k], 1e-9), -costs[k], -k))
        measured.append(Measured(rules[best], costs[best], shares[best]))
        left.remove(best)
        alive = [r for r in alive if not r[best]]
    return measured


def cascade(text: Column, words: Column, rules: list[Rule]) -> Column:
    """The name of the first rule, in the given order, that rejects; null if none does.  Later rules aren't evaluated."""
    verdict = F.lit(None).cast("string")
    for rule in reversed(rules):
        verdict = F.when(rule.rejects(text, words), F.lit(rule.name)).otherwise(verdict)
    return verdict


def quality_filter(df: DataFrame, *, text: str = "text", rules: list[Rule] | None = None, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of ``df`` that no rule rejects, columns unchanged.  No shuffle."""
    rules = [m.rule for m in measure_rules(df, rules or [*BASE_RULES, *METHOD_RULES], text=text, sample_rows=sample_rows)]
    whole = F.coalesce(df[text], F.lit(""))
    return df.where(let(whole, lambda t: let(words_of(t), lambda w: cascade(t, w, rules).isNull())))


def quality_report(df: DataFrame, *, key: str = "doc_id", text: str = "text", rules: list[Rule] | None = None, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """A row for each document: the base figures, base_failed and the verdict of the cascade (kept)."""
    rules = [m.rule for m in measure_rules(df, rules or METHOD_RULES, text=text, sample_rows=sample_rows)]

    def figures(t: Column, w: Column) -> Column:
        return let(
            repeated_words(w),
            lambda repeated: let(
                (F.size(w) < 20) | (100 * repeated > 30 * F.size(w)),
                lambda failed: F.struct(
                    F.size(w).cast("long").alias("n_words"),
                    _word_chars(w).cast("long").alias("word_chars"),
                    F.regexp_count(t, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
                    duplicate_lines(t).cast("long").alias("n_dup_lines"),
                    repeated.cast("long").alias("n_repeat_words"),
                    failed.alias("base_failed"),
                    F.when(failed, F.lit(False)).otherwise(cascade(t, w, rules).isNull()).alias("kept"),
                ),
            ),
        )

    judged = df.select(df[key].alias(key), let(F.coalesce(df[text], F.lit("")), lambda t: let(words_of(t), lambda w: figures(t, w))).alias("_figures"))
    return judged.select(key, "_figures.*")
