"""Runs (maximal stretches of repeating words) by Lyndon roots, and texts with the repetition taken out.

A run is a stretch of words with a smallest period q, at least ``LEAST`` words and ``EXPONENT`` periods long, that no
neighbouring word extends.  Its root (the least rotation of one period, in an order of the words or in the reverse one) is a
Lyndon word, and where it stands inside of the run, it is the longest Lyndon word that begins there.  So the candidates are
the longest Lyndon words at all places, under both orders: each gives one place and one period, and the longest common
extensions to both sides of a place and of the place one period on tell how far a run goes.

The lengths of the longest Lyndon words come from the first phase of Baier's suffix sorter as they are: groups of suffixes
are taken from the highest to the lowest; the nearest place before a suffix that belongs to a lower group takes in the group's
word, and places that take in the same number of words move to a new group just above their old one.  When a group's turn
comes, its word is the longest Lyndon word at its places.  No suffix array is made, and each place is moved as often as
others hand it their words: linear time.

Any ``LEAST`` - 1 words inside of a run occur again one period away, so only stretches of words whose every window of that
many words occurs twice in the text are sorted; a run lies inside of one of them, and ends there as it ends in the text.  That is
told by hashes of windows over whole texts (equal hashes of unequal windows only make a stretch longer).

Rows: a null or empty text has no run, and nothing is left of it; a very long text is taken whole, in one task, in memory in
proportion to it; equal rows give equal results; runs of one length are told apart by their starts and then their
periods; an empty table gives no rows; extra columns, of whatever name, are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm._tables import ship_package

#: Shortest run, in words and in periods.  Windows of LEAST - 1 words recur in every run of LEAST words and EXPONENT periods:
#: beside a window of 5 words one more period fits (5 + 1 words of period 1, 5 + q <= 4q words of a period q >= 2).
LEAST = 6
EXPONENT = 4
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
#: Bytes of text after which results are handed on.
HANDED = 1 << 24

_FACTORS = np.random.default_rng(11).integers(0, 2**64, LEAST - 1, np.uint64) | np.uint64(1)


def lyndon_lengths(symbols: list[int]) -> list[int]:
    """Length of the longest Lyndon word that begins at each place: phase one of Baier's sorter."""
    n = len(symbols)
    by_symbol: dict[int, list[int]] = {}
    for place, symbol in enumerate(symbols):
        by_symbol.setdefault(symbol, []).append(place)
    members = [by_symbol[s] for s in sorted(by_symbol)]
    below, above = list(range(-1, len(members) - 1)), list(range(1, len(members) + 1))
    group = [0] * n
    for number, places in enumerate(members):
        for place in places:
            group[place] = number
    length, before, done = [1] * n, [-1] * n, [False] * (n + 1)  # done[-1] stands before the first place
    now = len(members) - 1
    above[now] = -1
    while now >= 0:
        own = [place for place in members[now] if group[place] == now]
        for place in own:
            done[place] = True
        taken: dict[int, int] = {}
        for place in own:
            lower = place - 1
            while done[lower]:
                lower = before[lower]
            before[place] = lower
            if lower >= 0:
                taken[lower] = taken.get(lower, 0) + 1
        if taken:
            word = length[own[0]]
            by_count: dict[int, list[int]] = {}
            for place, count in taken.items():
                by_count.setdefault(count, []).append(place)
            for count in sorted(by_count, reverse=True):
                fresh: dict[int, int] = {}
                for place in by_count[count]:
                    old = group[place]
                    new = fresh.get(old)
                    if new is None:
                        new = fresh[old] = len(members)
                        members.append([])
                        over = above[old]
                        below[over] = above[old] = new  # the group taken now is above all that move
                        below.append(old)
                        above.append(over)
                    members[new].append(place)
                    group[place] = new
                    length[place] += count * word
        now = below[now]
    return length


def _same(symbols: np.ndarray, i: int, j: int) -> int:
    """Symbols that are equal from places i and j (i < j) on."""
    n, far, step = 0, len(symbols), 32
    while j + n < far:
        step = min(step, far - j - n)
        unequal = symbols[i + n : i + n + step] != symbols[j + n : j + n + step]
        if unequal.any():
            return n + int(unequal.argmax())
        n += step
        step *= 4
    return n


def runs_of(symbols: np.ndarray) -> set[tuple[int, int, int]]:
    """All runs (start, length, period) of a stretch of symbols."""
    n, found = len(symbols), set()
    backward = symbols[::-1].copy()
    for order in (symbols, -symbols):
        period = np.array(lyndon_lengths(order.tolist()), np.int64)
        first = np.flatnonzero(EXPONENT * period <= n)
        q = period[first]
        # of a long enough run three roots follow each other that are the longest Lyndon words at their places
        first, q = (x[first + 2 * q < n] for x in (first, q))
        alike = (period[first + q] == q) & (period[first + 2 * q] == q) & (symbols[first] == symbols[first + q]) & (symbols[first] == symbols[first + 2 * q])
        until: dict[int, int] = {}
        for place, p in zip(first[alike].tolist(), q[alike].tolist()):
            if place + p <= until.get(p, 0):  # a root inside of the last run of this period
                continue
            end = place + p + _same(symbols, place, place + p)
            start = place - (_same(backward, n - place - p, n - place) if place else 0)
            if end - start >= 2 * p:
                until[p] = end
                if end - start >= max(LEAST, EXPONENT * p):
                    found.add((start, end - start, p))
    return found


def stretches(symbols: np.ndarray) -> list[tuple[int, int]]:
    """Stretches (start, end) of words in which every window of LEAST - 1 words is one that occurs twice."""
    width = LEAST - 1
    n = len(symbols) - width + 1
    if n < 2:
        return []
    hashes = np.zeros(n, np.uint64)
    for k, factor in enumerate(_FACTORS):
        hashes += symbols[k : k + n].astype(np.uint64) * factor
        hashes ^= hashes >> np.uint64(31)
    ordered = np.sort(hashes)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return []
    edges = np.diff(np.isin(hashes, twice).astype(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    return [(int(s), int(e) + width - 1) for s, e in zip(starts, ends) if e - s + width - 1 >= LEAST]


def find_runs(words: list) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) of words, by start and period."""
    numbers = {w: k for k, w in enumerate(dict.fromkeys(words))}
    symbols = np.array([numbers[w] for w in words], np.int64)
    found = [(start + s, length, p) for start, end in stretches(symbols) for s, length, p in runs_of(symbols[start:end])]
    return sorted(found, key=lambda run: (run[0], run[2]))


def left_over(words: list, runs: list[tuple[int, int, int]]) -> list:
    """Words that no run contains behind its first period."""
    if not runs:
        return words
    edges = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    return [words[k] for k in np.flatnonzero(np.cumsum(edges)[:-1] == 0)]


def periodic_runs(df: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, runs (start in words from 0, length, period; by start, then period) and collapsed (the words left, joined by spaces).

    Words stand between ASCII white space.  No shuffle.
    """
    ship_package(df.sparkSession)
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs, texts, begun, size = [], [], 0, 0

            def made(until: int, begun=0) -> pa.RecordBatch:
                flat = np.array([r for each in runs for r in each], np.int64).reshape(-1, 3)  # noqa: B023
                structs = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(flat[:, k])) for k in range(3)], ["start", "length", "period"])
                ends = np.cumsum([0, *map(len, runs)]).astype(np.int32)  # noqa: B023
                columns = [batch.column(0).slice(begun, until - begun), pa.ListArray.from_arrays(pa.array(ends), structs), pa.array(texts, pa.string())]  # noqa: B023
                return pa.RecordBatch.from_arrays(columns, ["key", "runs", "collapsed"])

            for k, x in enumerate(batch.column(1)):
                whole = x.as_buffer()
                words = whole.to_pybytes().split() if whole is not None else []
                runs.append(find_runs(words))
                texts.append(b" ".join(left_over(words, runs[-1])))
                size += len(texts[-1])
                if size > HANDED:
                    yield made(k + 1, begun)
                    runs, texts, begun, size = [], [], k + 1, 0
            if runs:
                yield made(batch.num_rows, begun)
        pa.default_memory_pool().release_unused()  # the worker lives on

    made = df.select(df[key].alias("key"), df[text].cast("string").alias("text")).mapInArrow(run, f"key {kind}, runs {RUNS}, collapsed string")
    return made.withColumnRenamed("key", key)


def planted_runs(df: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``text``; of one key in ten, from one word on, the words are the first ones from there, again and again.

    By h, the CRC-32 of the decimal key, and g = h / 10: where 10 divides h, words from a = g mod n on repeat with a period of
    1 + (n - a) / (3 + g mod 8).  Rows with a null key, or without words, stay as they are.
    """
    h = F.crc32(df[key].cast("string").cast("binary"))
    g = F.floor(h / 10)

    def rewritten(words):
        n = F.size(words)
        begin = (g % n).cast("int")
        period = (1 + F.floor((n - begin) / (3 + g % 8))).cast("int")
        return F.when(n > 0, F.array_join(F.transform(words, lambda w, i: F.when(i < begin, w).otherwise(F.get(words, begin + (i - begin) % period))), " ")).otherwise(df[text])

    words = F.filter(F.split(df[text], r"[\x20\x09-\x0D]+"), lambda w: w != "")
    bound = F.element_at(F.transform(F.array(words), rewritten), 1)
    return df.select(df[key], F.when(h % 10 == 0, bound).otherwise(df[text]).alias(text))


def run_digests(found: DataFrame, *, key: str = "doc_id") -> DataFrame:
    """From `periodic_runs`: ``key``, n_runs, the longest run (start, length, period, exponent_milli), and digests of all runs and of the words left."""
    # of one length the smallest start, then period
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    rows = found.withColumn("longest", longest)
    length, period = F.col("longest.length"), -F.col("longest.period")
    return rows.select(
        key, F.size("runs").cast("bigint").alias("n_runs"), (-F.col("longest.start")).alias("start"), length.alias("length"), period.alias("period"),
        F.floor(1000 * length / period).cast("bigint").alias("exponent_milli"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
