"""Quality rules against a plain version in Python."""

import re
from collections import Counter

from pyspark.sql import functions as F

from strandline.llm import quality

PROSE = "the quick brown fox jumps over the lazy dog while seven more animals watch it from a hill far away today"
TEXTS = [
    None, "", " \n\t ", PROSE, PROSE + "\n" + PROSE, "a b c d e f g h " * 40, "one two", ("x " * 30).strip(), "\n".join(["same line of text here"] * 6 + [PROSE]),
    "### " * 10 + PROSE, PROSE.upper(), " ".join("abcdefghijklmnopq" for _ in range(25)), "é ü ½ " * 12, PROSE + "\x0b" + PROSE.replace("fox", "cat"),
    " ".join(f"word{k}" for k in range(20_000)), PROSE, " ".join(f"w{k % 90}{'yz'[k * k % 97 % 2]}{k % 7}" for k in range(30_000)), "ab cd " * 1000, "| a | b |\n" * 30,
]


def expected(text):
    text = text or ""
    words = [w for w in re.split("[\x20\x09-\x0d]+", text) if w]
    windows = Counter(tuple(words[k : k + 8]) for k in range(len(words) - 7))
    covered = {j for k in range(len(words) - 7) if windows[tuple(words[k : k + 8])] > 1 for j in range(k, k + 8)}
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    n, chars, symbols, dups = len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", text)), len(lines) - len(set(lines))
    failed = n < 20 or 100 * len(covered) > 30 * n
    bad = 4 * symbols > n or 5 * len(re.findall("[A-Z]", text)) > 2 * chars or chars < 2 * n or chars > 14 * n or 10 * dups > 5 * len(lines) or 20 * sum(len(set(words[k : k + 1000])) for k in range(0, n, 1000)) < n
    return n, chars, symbols, dups, len(covered), failed, not (failed or bad)


def test_report(spark):
    rows = [(k, t, "clash") for k, t in enumerate(TEXTS)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, kept string").repartition(3)
    got = {r["doc_id"]: tuple(r)[1:] for r in quality.quality_report(df).collect()}
    assert got == {k: expected(t) for k, t in enumerate(TEXTS)}


def test_filter_keeps_columns_and_agrees_with_the_report(spark):
    df = spark.createDataFrame([(k, t, k % 2) for k, t in enumerate(TEXTS)], "doc_id bigint, text string, words int")
    kept = quality.quality_filter(df)
    assert kept.columns == df.columns
    assert {r["doc_id"] for r in kept.collect()} == {k for k, t in enumerate(TEXTS) if expected(t)[-1]}


def test_the_order_of_rules_changes_no_verdict(spark):
    rules = [*quality.BASE_RULES, *quality.METHOD_RULES]
    df = spark.createDataFrame([(t or "",) for t in TEXTS], "text string").withColumn("words", quality.words_of(F.col("text")))
    one, other = (df.select(quality.cascade(F.col("text"), F.col("words"), r).isNull().alias("kept")).collect() for r in (rules, rules[::-1]))
    assert one == other


def test_rules_that_reject_more_for_less_come_first(spark):
    cheap = quality.Rule("cheap", lambda text, words: F.size(words) < 20)
    never = quality.Rule("never", lambda text, words: F.size(words) < 0)
    df = spark.createDataFrame([(k, t) for k, t in enumerate(TEXTS)], "doc_id bigint, text string")
    measured = quality.measure_rules(df, [never, cheap])
    assert [m.rule.name for m in measured] == ["cheap", "never"]
    assert measured[0].rejected == sum(expected(t)[0] < 20 for t in TEXTS) / len(TEXTS)


def test_a_rule_gains_nothing_from_what_others_reject(spark):
    first = quality.Rule("first", lambda text, words: F.size(words) < 20)
    same = quality.Rule("same", lambda text, words: F.size(F.transform(words, lambda w: F.md5(w.cast("binary")))) < 20)
    other = quality.Rule("other", lambda text, words: F.size(F.transform(words, lambda w: F.md5(w.cast("binary")))) > 100)
    df = spark.createDataFrame([(k, t) for k, t in enumerate(TEXTS)], "doc_id bigint, text string")
    measured = quality.measure_rules(df, [same, other, first])
    assert [m.rule.name for m in measured] == ["first", "other", "same"] and measured[2].rejected == 0


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert quality.quality_report(df).count() == 0 and quality.quality_filter(df).count() == 0
