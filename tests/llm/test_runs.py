"""Runs against a brute force over all periods; Lyndon lengths against their definition."""

import random
import zlib
from hashlib import sha256

import numpy as np
import pytest

from strandline.llm import queries, runs
from tests.llm.plain import plain_rows

BREAKS = b" \t\n\x0b\x0c\r"


def brute_runs(words: list) -> list[tuple[int, int, int]]:
    """Every maximal stretch of each period; one that a smaller period has as well is not of its smallest period."""
    numbers = {w: k for k, w in enumerate(dict.fromkeys(words))}
    s = np.array([numbers[w] for w in words])
    n, found = len(s), {}
    for q in range(1, n // 4 + 1):
        equal = np.concatenate([[False], s[:-q] == s[q:], [False]]).astype(int)
        starts, ends = np.flatnonzero(np.diff(equal) == 1), np.flatnonzero(np.diff(equal) == -1)
        for a, b in zip(starts, ends):
            start, length = int(a), int(b - a) + q
            if length >= max(6, 4 * q):
                found.setdefault((start, length), q)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def plain(doc_id: int | None, text: str | None) -> tuple:
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = brute_runs(words)
    gone = {k for s, length, q in found for k in range(s + q, s + length)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    left = b" ".join(w for k, w in enumerate(words) if k not in gone)
    return (doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None, sha256(lines.encode()).hexdigest(), sha256(left).hexdigest())


def digests(spark, rows, schema="doc_id bigint, text string") -> list[tuple]:
    df = spark.createDataFrame(rows, schema)
    return sorted(map(tuple, runs.run_digests(runs.periodic_runs(runs.planted_runs(df))).collect()), key=repr)


@pytest.mark.parametrize("letters", [1, 2, 3, 8])
def test_lyndon_lengths(letters):
    rng = random.Random(letters)
    for n in [*range(1, 12), 40, 90]:
        for _ in range(30):
            s = [rng.randrange(letters) for _ in range(n)]
            # the longest Lyndon word at a place ends before the next smaller suffix
            want = [next((j for j in range(i + 1, n) if s[j:] < s[i:]), n) - i for i in range(n)]
            assert runs.lyndon_lengths(s) == want


def test_runs_of_random_and_periodic_words():
    rng = random.Random(5)
    for k in range(1500):
        s = [rng.randrange(rng.choice((1, 2, 3, 5))) for _ in range(rng.randrange(0, 70))]
        if k % 2:
            root = [rng.randrange(3) for _ in range(rng.randrange(1, 9))]
            s = s[: rng.randrange(0, 20)] + (root * 12)[: rng.randrange(4 * len(root), 9 * len(root))] + s[20:] + root * rng.randrange(0, 6)
        assert runs.find_runs(s) == brute_runs(s), s


def test_square_and_fibonacci_words():
    for start in ("a", "b"):
        x, y = "ab", start
        for _ in range(10):
            x, y = x + y, x
        for s in (x, x * 5, "c".join([x] * 5), "".join(k * 7 for k in x[:40])):
            assert runs.find_runs(list(s)) == brute_runs(list(s))


def test_short_runs_and_limits():
    assert runs.find_runs(list("xaaaaay")) == [] and runs.find_runs(list("xaaaaaay")) == [(1, 6, 1)]
    assert runs.find_runs(list("abababa")) == [] and runs.find_runs(list("abababab")) == [(0, 8, 2)]
    assert runs.find_runs(list("abcabcabcab")) == [] and runs.find_runs(list("zabcabcabcabcz")) == [(1, 12, 3)]


def test_lines_of_one_text(spark):
    text = "one two\nthree " * 9 + " odd " + "again\x0b" * 7 + "end"
    got = runs.periodic_runs(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).first()
    assert [tuple(r) for r in got["runs"]] == [(0, 27, 3), (28, 7, 1)]
    assert got["collapsed"] == "one two three  odd again end"


def test_nulls_ties_and_odd_texts(spark):
    tie = "a b a b a b a b c d c d c d c d"
    rows = [(None, "x " * 20), (1, None), (2, ""), (3, " \t\n"), (4, tie), (4, tie), (5, "one"), (6, "é è " * 10), (23, "w " * 100_000)]
    rows += [(k, " ".join(str(j % (3 + k % 5)) for j in range(k))) for k in range(30, 130)]
    assert digests(spark, rows) == sorted([plain(*r) for r in rows], key=repr)
    assert digests(spark, []) == []


def test_results_are_handed_on_in_parts(spark, monkeypatch):
    monkeypatch.setattr(runs, "HANDED", 100)
    rows = [(k, "word " * k + f"other {k}") for k in range(50)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    got = {r["doc_id"]: (len(r["runs"]), r["collapsed"]) for r in runs.periodic_runs(df).collect()}
    assert got == {k: (int(k >= 6), " ".join((["word"] if k >= 6 else ["word"] * k) + ["other", str(k)])) for k in range(50)}


def test_clashing_columns(spark):
    df = spark.createDataFrame([(1, "b " * 8, "k", [1], "c")], "doc_id bigint, text string, key string, runs array<int>, collapsed string")
    assert runs.periodic_runs(df).first()["collapsed"] == "b"


def test_query_on_given_tables(spark):
    got = sorted(map(tuple, queries.op11_periodic_runs(spark, plain_rows.folder).collect()))
    assert got == sorted(plain(r["doc_id"], r["text"]) for r in plain_rows("documents"))
    assert sum(r[1] > 0 for r in got) > 3
