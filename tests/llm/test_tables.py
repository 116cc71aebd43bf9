"""Joins of names that many rows share."""

from collections import Counter

from strandline.llm import _tables


def test_hot_names_are_broadcast_and_nothing_is_lost(spark, monkeypatch):
    rows = [("hot", k) for k in range(300)] + [("warm", k) for k in range(20)] + [(f"n{k}", k) for k in range(50)] + [(None, 1), ("unnamed", 2)]
    named = [("hot", 300, "H"), ("warm", 20, "W"), *[(f"n{k}", 1, f"N{k}") for k in range(50)], ("nobody", 9, "X")]
    left, right = spark.createDataFrame(rows, "name string, k int"), spark.createDataFrame(named, "name string, n int, what string")
    want = Counter((n, k, w) for n, k in rows for m, _, w in named if n == m)
    for most, least in ((1_000, 1_000), (1, 10), (5, 10), (1, 0)):
        monkeypatch.setattr(_tables, "HOT_NAMES", most)
        monkeypatch.setattr(_tables, "HOT_ROWS", least)
        assert Counter((r["name"], r["k"], r["what"]) for r in _tables.dealt_join(left, right, ["name"]).collect()) == want


def test_names_of_two_columns(spark, monkeypatch):
    monkeypatch.setattr(_tables, "HOT_ROWS", 3)
    left = spark.createDataFrame([(k % 2, k % 3, k) for k in range(60)], "a int, b int, k int")
    found = _tables.dealt_join(left, left.groupBy("a", "b").count().withColumnRenamed("count", "n").selectExpr("*", "a * 10 + b AS what"), ["a", "b"])
    assert Counter((r["k"], r["what"]) for r in found.collect()) == Counter((k, k % 2 * 10 + k % 3) for k in range(60))
