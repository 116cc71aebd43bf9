"""The similarity join against all pairs of sets."""

import random
import re

import numpy as np
import pytest

from strandline.llm import ngram_join, queries
from tests.llm.plain import plain_rows


def shingles(text: str | None) -> frozenset:
    words = [w for w in re.split("[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or "")) if w]
    return frozenset(" ".join(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()


def plain(rows: list[tuple]) -> list[tuple]:
    """doc_id, n_shingles and component_id by comparing all pairs of distinct sets that share a shingle."""
    sets = sorted({shingles(t) for _, t in rows} - {frozenset()}, key=lambda s: (len(s), sorted(s)))
    root = list(range(len(sets)))

    def find(k):
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    holders: dict = {}
    for k, s in enumerate(sets):
        near: dict = {}
        for g in s:
            for other in holders.setdefault(g, []):
                near[other] = near.get(other, 0) + 1
            holders[g].append(k)
        for other, both in near.items():
            if 100 * both >= 80 * (len(s) + len(sets[other]) - both):
                root[find(k)] = find(other)
    place = {s: find(k) for k, s in enumerate(sets)}
    least: dict = {}
    for doc_id, t in rows:
        if shingles(t) and doc_id is not None:
            c = place[shingles(t)]
            least[c] = min(least.get(c, doc_id), doc_id)
    return sorted(((d, len(shingles(t)), least.get(place[shingles(t)]) if shingles(t) else d) for d, t in rows), key=repr)


def found(spark, rows, **columns) -> list[tuple]:
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    return sorted(map(tuple, ngram_join.similar_documents(df).collect()), key=repr)


def near_group(rng: random.Random, n: int, size: int, changes: int) -> list[str]:
    base = [f"w{rng.randrange(10**6)}" for _ in range(size)]
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randrange(changes + 1)):
            words[rng.randrange(size)] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(words))
    return out


def documents(seed: int) -> list[tuple]:
    rng = random.Random(seed)
    texts = []
    passage = " ".join(f"p{k}" for k in range(60))
    for size in (6, 12, 40, 150):
        for changes in (1, 2, 4):
            texts += near_group(rng, 12, size, changes)
    texts += [f"{passage} " + " ".join(f"o{rng.randrange(10**6)}" for _ in range(rng.randrange(0, 40))) for _ in range(60)]
    texts += [" ".join(f"r{rng.randrange(50)}" for _ in range(rng.randrange(1, 60))) for _ in range(60)]
    texts += texts[:30] + [t.upper() for t in texts[30:60]] + [None, "", " \n", "one", "One", "a b c d", "a b c d e"]
    rng.shuffle(texts)
    return [(k * 3 + 1, t) for k, t in enumerate(texts)]


@pytest.fixture
def tight(monkeypatch):
    """Small figures, so that every way is taken: full cells, many fragments."""
    for name, value in {"FRAGMENT": 50, "HEAVY": (5, 0), "PACKED": 300}.items():
        monkeypatch.setattr(ngram_join, name, value)


def test_ngrams():
    assert len(ngram_join.ngrams(b"a b c d e f a b c d e")) == 6 == len(shingles("a b c d e f a b c d e"))
    assert len(ngram_join.ngrams(b"A b\x0bc")) == 1 and np.array_equal(ngram_join.ngrams(b"A b\x0bc"), ngram_join.ngrams(b"a  B c"))
    assert not np.array_equal(ngram_join.ngrams(b"a b c"), ngram_join.ngrams(b"c b a"))
    assert len(ngram_join.ngrams(None)) == len(ngram_join.ngrams(b" ")) == 0


def test_linked_sets_share_a_leading_ngram():
    rng = np.random.default_rng(1)
    counts = rng.integers(0, 9, ngram_join.CELLS)
    for _ in range(300):
        n = int(rng.integers(1, 90))
        one = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        keep = one[rng.random(len(one)) < 0.95]
        other = np.unique(np.concatenate([keep, rng.integers(0, 2**63, int(rng.integers(0, 1 + n // 10))).astype(np.uint64)]))
        both = len(np.intersect1d(one, other))
        if both and 100 * both >= 80 * (len(one) + len(other) - both):
            assert len(np.intersect1d(ngram_join.leading(one, counts)[0], ngram_join.leading(other, counts)[0]))


def test_bits_bound_how_far_sets_differ():
    rng = np.random.default_rng(2)
    for _ in range(300):
        one = np.unique(rng.integers(0, 2**64, int(rng.integers(0, 400)), np.uint64))
        other = np.unique(np.concatenate([one[rng.random(len(one)) < 0.9], rng.integers(0, 2**64, int(rng.integers(0, 60)), np.uint64)]))
        apart = len(np.setxor1d(one, other))
        bits = int(np.bitwise_count((ngram_join.parities(one) ^ ngram_join.parities(other)).view(np.uint64)).sum())
        assert bits <= apart and (apart > 40 or bits >= apart * 0.6)


def test_sizes_that_can_be_similar_are_in_neighbouring_classes():
    sizes = np.arange(1, 2_000_000, dtype=np.float64)
    of = lambda x: np.floor(np.log(x) / np.log(100 / ngram_join.SHARE))
    assert (of(np.floor(sizes * 100 / ngram_join.SHARE)) - of(sizes)).max() <= 1


def test_only_what_cannot_be_similar_is_left_out():
    rng = np.random.default_rng(4)
    for _ in range(200):
        n = int(rng.integers(1, 12))
        token, size = rng.integers(0, 3, n), rng.integers(1, 60, n)
        rest = np.minimum(rng.integers(0, 60, n), size - 1)
        kept = ngram_join.meets(token, size, rest)
        for i in range(n):
            for j in range(i):
                least, most = sorted((size[i], size[j]))
                if token[i] == token[j] and 5 * least >= 4 * most and 180 * (1 + min(rest[i], rest[j])) >= 80 * (least + most):
                    assert kept[i] and kept[j]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_pairs(spark, seed):
    rows = documents(seed)
    assert found(spark, rows) == plain(rows)


def test_every_way_gives_the_same(spark, tight):
    rows = documents(3)
    assert found(spark, rows) == plain(rows)


def test_one_giant_group(spark, tight):
    """Near copies of one text, half of all rows: pairs are few, links are kept."""
    rng = random.Random(9)
    rows = list(enumerate(near_group(rng, 250, 80, 3) + [" ".join(f"u{rng.randrange(10**6)}" for _ in range(30)) for _ in range(250)]))
    assert found(spark, rows) == plain(rows)


def test_just_the_share(spark):
    """Four of five shingles in common link, seven of nine do not."""
    words = [f"w{k}" for k in range(11)]
    rows = [(1, " ".join(words[:9])), (2, " ".join(words[:8])), (3, " ".join(f"v{k}" for k in range(13))), (4, " ".join(f"v{k}" for k in range(11)))]
    assert found(spark, rows) == plain(rows) == [(1, 5, 1), (2, 4, 1), (3, 9, 3), (4, 7, 4)]


def test_nulls_and_odd_rows(spark):
    long = " ".join(f"w{k}" for k in range(120_000))
    rows = [(None, "a b c d e f"), (None, None), (5, "a b c d e f"), (None, "only null keys"), (None, "only null keys"), (7, None), (7, ""), (8, long), (9, long + " end"), (9, long + " end"), (10, "É é"), (11, "é É")]
    assert found(spark, rows) == plain(rows)
    assert found(spark, []) == []


def test_clashing_columns(spark):
    df = spark.createDataFrame([(1, "a b", 1, "k", 2), (2, "A B", 3, "m", 4)], "doc_id bigint, text string, name int, key string, component_id int")
    assert sorted(map(tuple, ngram_join.similar_documents(df).collect())) == [(1, 1, 1), (2, 1, 1)]


def test_query_on_given_tables(spark):
    got = sorted(map(tuple, queries.op13_ngram_join(spark, plain_rows.folder).collect()), key=repr)
    assert got == plain([(r["doc_id"], r["text"]) for r in plain_rows("documents")])
    assert len({r[2] for r in got}) < len(got)
