"""Exact top-k against all inner products."""

import math
import random

import pytest

from strandline.llm import vectors


def expected(rows, k=5):
    usable = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n_q, (q, v) in enumerate(usable):
        if q % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, c)), i) for n_c, (i, c) in enumerate(usable) if n_c != n_q and len(c) == len(v))
            out += [(q, n, i, -s) for n, (s, i) in enumerate(scores[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize(("block", "dims", "broadcast"), [(4096, 24, 10**9), (64, 40, 10**9), (50, 3, 10**9), (64, 24, 0)])
def test_against_all_pairs(spark, monkeypatch, block, dims, broadcast):
    monkeypatch.setattr(vectors, "QUERY_BYTES", broadcast)
    monkeypatch.setattr(vectors, "BLOCK", block)
    monkeypatch.setattr(vectors, "QUERY_BLOCK", 3)
    rnd = random.Random(dims)
    rows = [(k, [rnd.gauss(0, 1) for _ in range(dims)]) for k in range(400)]
    rows += [(400 + k, rows[3][1]) for k in range(30)]  # ties
    rows += [(7, rows[7][1]), (50, rows[50][1]), (50, rows[50][1]), (50, rows[9][1]), (None, rows[1][1]), (500, None), (501, [None] * dims), (502, [math.nan] * dims), (503, [math.inf] * dims), (550, [0.5]), (600, []), (601, [1.0]), (602, [])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").selectExpr("*", "1 AS rank", "'x' AS score").repartition(5)
    collected = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    got = sorted(tuple(r) for r in vectors.top_k(df, df["vec_id"] % 50 == 0).select("query_id", "rank", "vec_id", "score").collect())
    assert got == expected(collected)


def test_large_components_stay_exact(spark):
    rows = [(0, [3e12, 1.0]), (1, [2e12, 5.0]), (2, [2e12, 5.0 + 1 / 256]), (3, [-1e12, 0.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = [tuple(r) for r in vectors.top_k(df, df["vec_id"] == 0).orderBy("rank").collect()]
    assert [g[2] for g in got] == [1, 2, 3] and got[0][3] == vectors.LONG  # both saturate; ties go to the smaller id


def test_fewer_candidates_and_no_rows(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [1.0])], "vec_id bigint, embedding array<float>")
    assert [tuple(r) for r in vectors.top_k(df, df["vec_id"] == 0).collect()] == [(0, 1, 1, 65536)]
    empty = df.where("vec_id > 5")
    assert vectors.top_k(empty, empty["vec_id"] == 0).count() == 0
