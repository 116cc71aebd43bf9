"""Near copies against a brute force over all pairs, on texts that the 64-bit SimHash of op4 leaves apart."""

import random

import numpy as np
import pytest

import corpus_pipeline
from strandline.llm import near_copies
from strandline.llm.components import min_components


def shingles(text):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()


def grouped(rows):
    root = {k: k for k, _ in rows}

    def top(k):
        return k if root[k] == k else top(root[k])

    sets = [(k, shingles(t)) for k, t in rows]
    for n, (k, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a == b or 5 * len(a & b) >= 4 * len(a | b):
                x, y = sorted((top(k), top(j)))
                root[y] = x
    return {k: top(k) for k, _ in rows}


def some_rows():
    rnd = random.Random(3)
    words = [f"w{k}" for k in range(500)]
    rows = []
    for n in (6, 20, 60, 200, 200, 400, 800):
        first = [rnd.choice(words) for _ in range(n)]
        rows.append(first)
        for changed in (1, 1, max(1, n // 60), n // 40, n // 30, n // 10):
            copy = list(rnd.choice((first, rows[-1])))
            for _ in range(changed):
                copy[rnd.randrange(n)] = "new"
            rows.append(copy)
    return [(k, " ".join(x)) for k, x in enumerate(rows)] + [(900, None), (901, ""), (902, "ONE two"), (903, "one  Two")]


@pytest.mark.parametrize("memory", [near_copies.SET_MEMORY, 1500])
def test_components_against_all_pairs(spark, memory):
    rows = some_rows()
    want = grouped(rows)
    assert 10 < len(set(want.values())) < len(rows) - 10
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    assert {r["doc_id"]: r["component_id"] for r in near_copies.near_copies(df, memory=memory).collect()} == want


def test_blocks_that_pass_each_other(spark):
    """Sets that all share one key, in a chain whose ends are unlike: blocks of few sets, in parts, give the same components."""
    rnd = random.Random(5)
    rows = [(0, np.arange(40))]
    for k in range(1, 30):  # each has two of the one before replaced, now and then most
        last = rows[rnd.randrange(max(0, k - 3), k)][1].copy()
        last[rnd.sample(range(40), 30 if k % 9 == 0 else 2)] = [rnd.randrange(1000, 10**6) for _ in range(30 if k % 9 == 0 else 2)]
        rows.append((k, last))
    sets = {k: np.unique(v.astype(np.uint64)) for k, v in rows}
    want = near_copies.exact_links(np.array(list(sets), np.int64), list(sets.values()))
    roots = dict(zip(*map(list, want)))
    want = {k: roots.get(k, k) for k in sets}
    assert 3 < len(set(want.values())) < 20
    members = spark.createDataFrame([(k, len(v), [7]) for k, v in sets.items()], "name bigint, size bigint, keys array<bigint>")
    bodies = spark.createDataFrame([(k, v.tobytes()) for k, v in sets.items()], "name bigint, shingles binary")
    for memory in (10**6, 600, 100):
        links = near_copies._crowded_links(members, bodies, memory)
        found = {r["node"]: r["component"] for r in min_components(links).collect()}
        assert {k: found.get(k, k) for k in sets} == want
        assert links.count() < 60 * len(sets)


def test_stage_drops_near_copies(spark):
    rows = some_rows()
    df = spark.createDataFrame([*rows, (None, rows[0][1]), rows[-1]], "doc_id bigint, text string").repartition(5)
    kept = [r["doc_id"] for r in corpus_pipeline.near_dedup(spark, df, "").collect()]
    assert sorted(k for k in kept if k is not None) == sorted(set(grouped(rows).values())) and kept.count(None) == 0


@pytest.mark.parametrize("order", [1, -1])
def test_rows_that_share_a_key(spark, order):
    a, b = "some words that are here twice", "another text that nothing else is like"
    df = spark.createDataFrame([(3, a), (5, a), (5, b), (None, "alone with no key at all"), (6, ""), (None, None)][::order], "doc_id bigint, text string").repartition(2)
    kept = sorted((str(r["doc_id"]), r["text"]) for r in near_copies.drop_near_copies(df).collect())
    assert kept == sorted([("3", a), ("5", b), ("None", "alone with no key at all"), ("6", "")])


def test_no_rows(spark):
    assert near_copies.near_copies(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0
