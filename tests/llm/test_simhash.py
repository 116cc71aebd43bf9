"""SimHash near-duplicates against all pairs; components against union-find."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from strandline.llm import components, simhash


def fingerprint(text):
    text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = [w for w in re.split("[\x20\x09-\x0d]+", text) if w]
    shingles = [" ".join(words[k : k + 3]) for k in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def grouped(prints):
    """Component of each position, by comparing all pairs."""
    root = list(range(len(prints)))

    def find(k):
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(k) for k in range(len(prints))]


def signed(x):
    return int(np.uint64(x).view(np.int64))


def texts():
    rnd = random.Random(7)
    words = [f"w{k}" for k in range(400)]
    out = [None, "", " \t\n", "One", "one", "one two", "one two three", "É é"]
    for _ in range(25):
        own = [rnd.choice(words) for _ in range(rnd.randint(30, 300))]
        out.append(" ".join(own))
        for _ in range(rnd.randint(0, 3)):
            near = list(own)
            near[rnd.randrange(len(near))] = rnd.choice(words)
            out.append(" ".join(near))
    return out + [out[10]] * 5


def test_documents(spark):
    all_texts = texts()
    df = spark.createDataFrame([(k * 3 + 1, t, "x") for k, t in enumerate(all_texts)], "doc_id bigint, text string, fingerprint string").repartition(4)
    prints = [fingerprint(t) for t in all_texts]
    root = grouped(prints)
    least = {r: min(k for k in range(len(root)) if root[k] == r) for r in set(root)}
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(df).collect()}
    assert got == {k * 3 + 1: (f"{prints[k]:016x}", least[root[k]] * 3 + 1) for k in range(len(prints))}
    kept = simhash.drop_near_duplicates(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(k * 3 + 1 for k in least.values())


@pytest.mark.parametrize("memory", [50_000, 12, 3, 1])
def test_crowded_anchors_lose_no_link(spark, memory):
    rnd = random.Random(memory)
    prints = set()
    for _ in range(8):
        centre = rnd.getrandbits(64)
        for _ in range(40):
            x = centre
            for _ in range(rnd.randint(0, 4)):
                x ^= 1 << rnd.randrange(64)
            prints.add(x)
    prints = sorted(prints)
    df = spark.createDataFrame([(signed(x),) for x in prints], "fingerprint bigint")
    found = {r["node"]: r["component"] for r in components.min_components(simhash.fingerprint_links(df, memory=memory)).collect()}
    own = [found.get(signed(x), signed(x)) for x in prints]
    pairs = {}
    for want, have in zip(grouped(prints), own):
        assert pairs.setdefault(want, have) == have
    assert len(set(pairs.values())) == len(pairs)


def test_the_last_round_holds_few_and_loses_no_pair(spark):
    """Prints that share five bytes: two that differ in three bits share a place again, and a place's prints differ in 18 bits at most."""
    rnd = random.Random(6)
    base = rnd.getrandbits(64)
    prints = sorted({base ^ (rnd.getrandbits(24) & sum(1 << b for b in rnd.sample(range(24), 3))) << 16 for _ in range(150)})
    dealt = simhash._five_bytes(spark.createDataFrame([(signed(x),) for x in prints], "a bigint"))
    crowded = dealt.join(dealt.groupBy("place").count().where("count > 20").select("place"), "place", "left_semi").withColumnRenamed("print", "a")
    places = {}
    for r in simhash._six_bits(crowded).collect():
        places.setdefault(r["place"], set()).add(r["print"])
    met = {(x, y) for held in places.values() for x in held for y in held if x < y}
    close = {(x, y) for x in map(signed, prints) for y in map(signed, prints) if x < y and ((x ^ y) & (1 << 64) - 1).bit_count() <= 3}
    assert close <= met and close
    for held in places.values():
        differ = 0
        for x in held:
            differ |= x ^ next(iter(held))
        assert (differ & (1 << 64) - 1).bit_count() <= 18


def test_halves_that_differ_in_a_bit_share_an_anchor():
    rnd = random.Random(1)
    for _ in range(200):
        x = rnd.getrandbits(32)
        near = x ^ (1 << rnd.randrange(32))
        one, other = (set(simhash.anchors(np.array([v], np.uint64))[1].tolist()) for v in (x, near))
        assert one & other and len(one) <= 17


def test_components_of_chains_and_stars(spark):
    rnd = random.Random(2)
    links = [(k, k + 1) for k in range(0, 60)] + [(100, k) for k in range(101, 140)] + [(200, 201), (201, 200), (202, 202)]
    rnd.shuffle(links)
    got = {r["node"]: r["component"] for r in components.min_components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {**{k: 0 for k in range(61)}, **{k: 100 for k in range(100, 140)}, 200: 200, 201: 200}


@pytest.mark.parametrize("order", [1, -1])
def test_rows_that_share_a_key_are_judged_by_their_texts(spark, order):
    a, b = "some words that are here twice", "another text that nothing else is like"
    rows = [(3, a, 1), (5, a, 2), (5, b, 3), (None, a, 4), (7, b + " x", 5), (7, b + " x", 5), (None, None, 6)]
    df = spark.createDataFrame(rows[::order], "doc_id bigint, text string, judged_key int").repartition(2)
    kept = sorted((str(r["doc_id"]), str(r["text"])) for r in simhash.drop_near_duplicates(df).collect())
    assert kept == sorted([("3", a), ("5", b), ("7", b + " x"), ("None", "None")])


def test_a_very_long_text_and_many_copies(spark, monkeypatch):
    monkeypatch.setattr(simhash, "COUNTED", 1000)
    long = " ".join(f"w{k % 977}" for k in range(30_000))
    rows = [(k, long if k < 2 else "a copy that many rows have") for k in range(300)]
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == {k: (f"{fingerprint(t):016x}", 0 if k < 2 else 2) for k, t in rows}


def test_repeated_rows_null_keys_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "a b c d"), (1, "a b c d"), (None, "a b c d"), (2, "a b c d"), (3, "other words entirely here")], "doc_id bigint, text string")
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in simhash.drop_near_duplicates(df).collect()) == [(False, 1), (False, 3)]
    assert {r["component_id"] for r in simhash.near_duplicates(df).where(F.col("doc_id").isNull() | (F.col("doc_id") < 3)).collect()} == {1}
    empty = df.where("doc_id = 99")
    assert simhash.near_duplicates(empty).count() == 0 and simhash.drop_near_duplicates(empty).count() == 0
