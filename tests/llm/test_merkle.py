"""Manifests against a plain version that builds every tree in memory."""

import zlib
from hashlib import sha256

from pyspark.sql import functions as F

from strandline.llm import merkle, queries
from tests.llm.plain import plain_rows

CELLS = ["doc_id", "source", "lang", "n_chars", "text"]
SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string, key string, tree int, digest string"


def h(*parts: str) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def leaf_of(row: dict) -> str:
    cells = [None if row[c] is None else str(row[c]) for c in CELLS]
    return h(*["-" if c is None else f"{len(c.encode())}:{c}" for c in cells])


def grown(nodes: list[str]) -> tuple[str, list[list[tuple[str, str]]]]:
    """The top of a tree and the steps of each leaf."""
    steps: list[list[tuple[str, str]]] = [[] for _ in nodes]
    under = [[k] for k in range(len(nodes))]
    while len(nodes) > 1:
        up, over = [], []
        for start in range(0, len(nodes), 16):
            run = nodes[start : start + 16]
            for k in range(len(run)):
                for leaf in under[start + k]:
                    steps[leaf].append(("".join(run[:k]), "".join(run[k + 1 :])))
            up.append(h(*run))
            over.append([leaf for x in under[start : start + 16] for leaf in x])
        nodes, under = up, over
    return nodes[0], steps


def plain_manifest(rows: list[dict]) -> list[tuple]:
    trees: dict = {}
    for row in rows:
        trees.setdefault(row["source"], []).append((row["doc_id"] is not None, row["doc_id"] or 0, leaf_of(row), row))
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    own = {s: grown([x[2] for x in sorted(trees[s], key=lambda x: x[:3])]) for s in order}
    root, tops = grown([own[s][0] for s in order]) if order else (None, [])
    out = []
    for s, top in zip(order, tops):
        for (_, _, leaf, row), steps in zip(sorted(trees[s], key=lambda x: x[:3]), own[s][1]):
            path = steps + top
            now = leaf
            if row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 5 == 0 and row["text"] is not None:
                now = leaf_of(row | {"text": row["text"].encode().lower().decode()})
            for left, right in path:
                now = h(left, now, right)
            out.append((row["doc_id"], leaf, own[s][0], root, h(*[a + b for a, b in path]), now, now == root))
    return sorted(out, key=repr)


def made(spark, rows: list[tuple]):
    return spark.createDataFrame(rows, SCHEMA)


def found(df) -> list[tuple]:
    return sorted(map(tuple, queries.tampered_manifest(df).collect()), key=repr)


def test_trees_of_many_sizes(spark):
    rows = [(s * 100_000 + k, f"s{s}", "en", k, f"Text {k} of {s}", "x", 1, "y") for s, n in enumerate((1, 2, 15, 16, 17, 31, 256, 257, 300)) for k in range(n)]
    df = made(spark, rows)
    want = plain_manifest([r.asDict() for r in df.collect()])
    assert found(df) == want
    assert {r[-1] for r in want} == {True, False}


def test_blocks_above_blocks(spark, monkeypatch):
    """With blocks of one digit, trees need several rounds; results don't change."""
    rows = [(k, "a" if k % 3 else f"t{k % 40}", None, k, f"TEXT {k}", "x", 1, "y") for k in range(2_000)]
    df = made(spark, rows)
    want = found(df)
    assert want == plain_manifest([r.asDict() for r in df.collect()])
    monkeypatch.setattr(merkle, "DIGITS", 1)
    assert found(df) == want


def test_more_leaves_than_a_block(spark):
    df = spark.range(9_000).select(F.col("id").alias("doc_id"), F.lit("hot").alias("source"), F.lit(None).cast("string").alias("lang"), F.col("id").alias("n_chars"), F.concat(F.lit("T"), "id").alias("text"))
    assert found(df) == plain_manifest([r.asDict() for r in df.collect()])


def test_nulls_ties_and_odd_texts(spark):
    odd = [None, "", "A" * 300_000, "ÄÖ ß 漢字 A", "plain lower"]
    rows = [(k % 7 if k % 11 else None, [None, "", "b", "é", "="][k % 5], None if k % 4 else "en", None if k % 3 else k, odd[k % len(odd)], "x", None, None) for k in range(90)]
    df = made(spark, rows + rows[:40])  # repeated rows, equal keys
    assert found(df) == plain_manifest([r.asDict() for r in df.collect()])


def test_empty_and_one_row(spark):
    assert found(made(spark, [])) == []
    one = made(spark, [(3, "s", None, None, "One", None, None, None)])
    got = found(one)
    assert got == plain_manifest([r.asDict() for r in one.collect()]) and got[0][1] == got[0][2] == got[0][3]


def test_query_on_given_tables(spark):
    rows = plain_rows("documents")
    assert sorted(map(tuple, queries.op12_merkle_manifest(spark, plain_rows.folder).collect()), key=repr) == plain_manifest(rows)


def test_no_join_below_the_ranks(spark):
    """Proofs are emitted without a join: the only one deals out ranks."""
    df = made(spark, [(k, "s", None, None, str(k), None, None, None) for k in range(50)])
    leaves = merkle.ranked(df.select(F.lit("").alias("tree"), F.col("doc_id").alias("key"), F.sha2("text", 256).alias("digest")), "key", "digest").withColumn("item", F.col("key"))
    blocks = merkle._emitted(merkle._blocks(merkle.stored(leaves)), "root")
    plan = blocks._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange") == 1
