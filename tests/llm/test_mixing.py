"""Temperature mixing against a plain version in Python."""

import hashlib
import math
from collections import defaultdict

import pytest

from strandline.llm import mixing


def rows_of(sizes):
    rows, k = [], 0
    for source, n in sizes.items():
        for j in range(n):
            rows.append((k, None if j % 17 == 0 else "w " * (j % 9), None if source == "none" else source, "clash"))
            k += 1
    return rows


def plain(rows, entropy_share, most_repeats, block_rows):
    """(doc_id, epoch, block) of everything taken, and the exponent."""
    docs = [(d, s, len((t or "").split())) for d, t, s, _ in rows]
    tokens, count = defaultdict(int), defaultdict(int)
    for _, s, n in docs:
        tokens[s] += n
        count[s] += 1
    total = sum(tokens.values())
    names = sorted(tokens, key=lambda s: (s is not None, s or ""))
    share = [tokens[s] / total if total else 0.0 for s in names]

    def weights(a):
        raised = [x**a if x > 0 else 0.0 for x in share]
        return [r / sum(raised) if sum(raised) else 0.0 for r in raised]

    entropy = lambda w: -sum(x * math.log(x) for x in w if x > 0)
    target = entropy(share) + entropy_share * max(math.log(max(1, sum(x > 0 for x in share))) - entropy(share), 0)
    repeats = lambda a: max((w / x for w, x in zip(weights(a), share) if x > 0), default=0)

    def bisect(holds):
        if holds(1.0):
            return 1.0
        lo, hi = 0.0, 1.0
        for _ in range(40):
            mid = (lo + hi) / 2
            lo, hi = (mid, hi) if holds(mid) else (lo, mid)
        return lo

    exponent = round(max(bisect(lambda a: entropy(weights(a)) >= target - 1e-9), 1 - bisect(lambda b: repeats(1 - b) <= most_repeats)), 6)
    quota = {s: math.floor(w * total * (1 + 1e-12)) for s, w in zip(names, weights(exponent))}
    out = []
    for s in names:
        passes = quota[s] // tokens[s] if tokens[s] else 1
        room = max(quota[s] - passes * tokens[s], 0)
        blocks = max(1, (count[s] + block_rows - 1) // block_rows)
        for epoch in range(passes + 1):
            place = []
            for d, source, n in docs:
                if source == s:
                    h = hashlib.md5(f"{epoch}:{d}".encode()).hexdigest()
                    place.append((int(h[:8], 16) * blocks >> 32, int(h[8:23], 16), d, n))
            so_far = 0
            for block, _, d, n in sorted(place):
                so_far += n
                if epoch < passes or (tokens[s] and so_far <= room):
                    out.append((d, epoch, block))
    return sorted(out), exponent


@pytest.mark.parametrize(("entropy_share", "most_repeats"), [(0.5, 4.0), (1.0, 3.0), (0.0, 4.0)])
def test_against_plain(spark, monkeypatch, entropy_share, most_repeats):
    monkeypatch.setattr(mixing, "BLOCK_ROWS", 16)
    rows = rows_of({"a": 400, "b": 60, "c": 20, "none": 30, "d": 1})
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string, weight string").repartition(3)
    want, exponent = plain(rows, entropy_share, most_repeats, 16)
    plan = mixing.mixing_plan(df, entropy_share=entropy_share, most_repeats=most_repeats).collect()
    assert sorted((r["doc_id"], r["epoch"], r["block"]) for r in plan) == want
    assert {r["exponent"] for r in plan} == {exponent}
    mixed = mixing.mix(df, entropy_share=entropy_share, most_repeats=most_repeats)
    assert mixed.columns == df.columns
    assert sorted(r["doc_id"] for r in mixed.collect()) == sorted(d for d, _, _ in want)


def test_more_sources_than_are_broadcast(spark, monkeypatch):
    rows = rows_of({"a": 50, "b": 10, "none": 5})
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string, weight string")
    one = sorted(mixing.mixing_plan(df).collect())
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 1)
    assert sorted(mixing.mixing_plan(df).collect()) == one


def test_one_source_and_tables_without_tokens_or_rows(spark):
    schema = "doc_id bigint, text string, source string"
    alone = spark.createDataFrame([(k, "x y", "a") for k in range(30)], schema)
    assert sorted(r["doc_id"] for r in mixing.mix(alone).collect()) == list(range(30))
    silent = spark.createDataFrame([(1, None, "a"), (2, "", "b"), (2, "", "b")], schema)
    assert sorted(r["doc_id"] for r in mixing.mix(silent).collect()) == [1, 2, 2]
    assert mixing.mixing_plan(alone.where("doc_id > 99")).count() == 0


def weighed(spark, sizes, **limits):
    df = spark.createDataFrame([(f"s{k}", n, 1) for k, n in enumerate(sizes)], "source string, tokens bigint, rows bigint")
    return mixing.source_weights(df, **limits).collect()


def test_many_equal_sources_keep_their_tokens(spark):
    """Weights of 3e-7 and 1.67e-6 round to 0 and to 2e-6; quotas come from the whole weight."""
    for n in (3_000_000, 600_000):
        df = spark.range(n).selectExpr("concat('s', id) AS source", "10L AS tokens", "1L AS rows")
        quotas = mixing.source_weights(df).groupBy("quota").count().collect()
        assert [(r["quota"], r["count"]) for r in quotas] == [(10, n)]


def test_tiny_sources_are_not_dropped(spark):
    sizes = [40_000_000, 9_000_000] + [3] * 500
    got = weighed(spark, sizes)
    assert all(r["quota"] >= 3 for r in got if r["tokens"] == 3)
    assert sum(r["quota"] for r in got) <= sum(sizes)


@pytest.mark.parametrize("share", [0.3, 1.0])
def test_quotas_stay_within_the_budget(spark, share):
    sizes = [7 * k * k + 1 for k in range(900)] + [10**9] * 3
    got = weighed(spark, sizes, budget_share=share)
    budget = int(share * sum(sizes))
    assert budget - len(sizes) <= sum(r["quota"] for r in got) <= budget


def test_cells_of_many_sizes_give_nearly_the_same(spark, monkeypatch):
    """Sources of about one size share a cell: the exponent moves in its last digits at most."""
    sizes = [100_000 + 13 * k for k in range(4_000)] + [5 * 10**8]
    monkeypatch.setattr(mixing, "CELLS_A_FOLD", 10**8)  # a cell each
    alone = weighed(spark, sizes)[0]["exponent"]
    monkeypatch.undo()
    assert abs(weighed(spark, sizes)[0]["exponent"] - alone) <= 2e-6


def test_groups_of_blocks(spark, monkeypatch):
    rows = rows_of({"a": 400, "b": 60, "none": 30})
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string, weight string")
    monkeypatch.setattr(mixing, "BLOCK_ROWS", 4)
    monkeypatch.setattr(mixing, "GROUP_BLOCKS", 3)
    want, _ = plain(rows, 0.5, 4.0, 4)
    assert sorted((r["doc_id"], r["epoch"], r["block"]) for r in mixing.mixing_plan(df).collect()) == want


def test_taken_tokens_stay_within_the_budget(spark):
    rows = [(k, "w " * (1 + k % 7), f"s{k % 40}" if k % 3 else "hot") for k in range(1_500)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    taken = mixing.mixing_plan(df).groupBy().sum("n_tokens").first()[0]
    assert 0.9 * sum(1 + k % 7 for k in range(1_500)) <= taken <= sum(1 + k % 7 for k in range(1_500))
