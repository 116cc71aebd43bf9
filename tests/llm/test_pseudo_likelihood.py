"""Masked pseudo-likelihood: scores against plain loops, gradients against differences, training that helps."""

import math
import random
from collections import Counter

import numpy as np
import pytest

from strandline.llm import pseudo_likelihood as pl


def some_network(side=3, seed=2):
    rnd = np.random.default_rng(seed)
    named = rnd.integers(3, 100, pl.BREADTH * side * side).astype(float)
    net = pl.Network.fresh(named, rnd.integers(1, 9, pl.TAIL).astype(float))
    for a in net.arrays:
        a += rnd.normal(0, 0.3, a.shape).astype(np.float32)
    return net


def softmax(logits):
    e = np.exp(logits - logits.max())
    return e / e.sum()


def plain_scores(net, ids):
    """Log-probabilities of words (in the tail: of classes) one position after the other."""
    embed, cls, cls_bias, word, word_bias = (a.astype(float) for a in net.arrays)
    side, breadth, out = net.side, pl.BREADTH * net.side, []
    for k, target in enumerate(ids):
        hidden = np.zeros(pl.WIDTH)
        for d in (*range(-pl.WINDOW, 0), *range(1, pl.WINDOW + 1)):
            hidden += embed[(ids[k + d] if 0 <= k + d < len(ids) else 0) + (len(embed) // 2 if d > 0 else 0)]
        hidden = np.tanh(hidden)
        classes = softmax(hidden @ cls + cls_bias)
        if target > len(word):
            out.append(math.log(classes[side + target - 1 - len(word)]))
        else:
            c, w = divmod(target - 1, breadth)
            inner = softmax(hidden @ word[c * breadth : (c + 1) * breadth].T + word_bias[c * breadth : (c + 1) * breadth])
            out.append(math.log(classes[c]) + math.log(inner[w]))
    return out


def line_of(docs):
    return pl.laid_out(np.array([t for d in docs for t in d], np.int64), np.array([len(d) for d in docs], np.int64))


@pytest.mark.parametrize("side", [0, 1, 3, 10])
def test_scores_against_loops(side):
    net, rnd = some_network(side), random.Random(1)
    docs = [[rnd.randint(1, pl.BREADTH * side * side + pl.TAIL) for _ in range(n)] for n in (0, 1, 2, 5, 300)]
    line, at, _ = line_of(docs)
    assert np.allclose(net.score(line, at), [x for d in docs for x in plain_scores(net, d)], atol=1e-4)


def test_probabilities_of_all_words_sum_to_one():
    net = some_network(4)
    total = 0.0
    for target in range(1, 32 + pl.TAIL + 1):
        total += math.exp(plain_scores(net, [3, 7, target, 2, 9])[2])
    assert abs(total - 1) < 1e-5


def test_a_step_follows_the_gradient(monkeypatch):
    line, at, _ = line_of([[1, 2, 7, 2, 9, 1]])
    net, gradients = some_network(1), []
    monkeypatch.setattr(pl, "_move", lambda weights, gradient, seen: gradients.append((weights.shape, gradient.copy())))
    net._step(line, at, [np.zeros(len(a)) if k in (0, 3) else np.zeros(a.shape) for k, a in enumerate(net.arrays)])
    by_shape = dict(gradients)
    for which, place in ((1, (2, 1)), (2, (1,)), (4, (0,)), (3, (1, 4))):
        sums = []
        for d in (1e-2, -1e-2):
            moved = pl.Network.of(net.side, net.flat())
            moved.arrays[which][place] += d
            sums.append(float(moved.score(line, at).astype(float).sum()))
        assert abs((sums[1] - sums[0]) / 2e-2 - by_shape[net.arrays[which].shape][place]) < 2e-2


def test_training_beats_frequencies_on_text_that_was_not_seen(spark):
    rnd = random.Random(4)

    def text():
        return " ".join(w for _ in range(40) for w in rnd.choice((["on", "the", "mat"], ["a", "red", "fox"], ["two", "old", "men"])))

    seen = spark.createDataFrame([(k, text(), "x") for k in range(2000)], "doc_id bigint, text string, n_tokens string").repartition(4)
    unseen = spark.createDataFrame([(k, text()) for k in range(100)], "doc_id bigint, text string")
    vocabulary = pl.vocabulary_of(pl.word_counts(seen))
    trained = pl.fit(pl.packed(seen, vocabulary), vocabulary, rounds=6)
    pieces = pl.packed(unseen, vocabulary)

    def mean(net):
        rows = pl.scores(pieces, net).collect()
        return sum(r["pseudo_log_likelihood"] for r in rows) / sum(r["n_tokens"] for r in rows)

    assert mean(trained) > mean(pl.Network.fresh(vocabulary.named, vocabulary.tail)) + 0.3


def rows_of(frame):
    return sorted((str(r["doc_id"]), r["n_tokens"], r["pseudo_log_likelihood"]) for r in frame.collect())


def test_partitions_do_not_matter(spark, monkeypatch):
    monkeypatch.setattr(pl, "PIECE_TOKENS", 500)
    rnd = random.Random(8)
    words = [f"w{k}" for k in range(300)]
    rows = [(k % 90, " ".join(rnd.choices(words, [1 / (n + 1) for n in range(300)], k=rnd.randint(0, 90)))) for k in range(100)]
    frames = [spark.createDataFrame(rows[:: (-1) ** n], "doc_id bigint, text string").repartition(n) for n in (1, 8)]
    assert rows_of(pl.score_documents(frames[0])) == rows_of(pl.score_documents(frames[1]))


def test_odd_texts_and_no_rows(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "word " * 50_000), (3, "word " * 50_000), (None, "x"), (4, "x")], "doc_id bigint, text string")
    rows = rows_of(pl.score_documents(df))
    assert [r[:2] for r in rows] == [("1", 0), ("2", 0), ("3", 50_000), ("3", 50_000), ("4", 1), ("None", 1)]
    assert rows[0][2] == 0 and rows[2] == rows[3]
    assert pl.score_documents(df.where("doc_id > 9")).count() == 0


def test_every_position_is_a_target_once():
    _, at, begins = line_of([[1], [], list(range(1, 8)), [3, 4]])
    for parts in (1, 2, 6):
        taken = np.concatenate([pl.targets(at, begins, k, parts) for k in range(parts)])
        assert sorted(taken) == list(at)
    assert set(at[begins[[0, 2, 3]]]) <= set(pl.targets(at, begins, 0, 2))


def plain_spelling(words):
    """Counts of what stands before what in ``words`` (word and count), and with these the logarithm of a word."""
    symbol = lambda c: ord(c) - 96 if "a" <= c <= "z" else 27 + ord(c) % 5
    pairs, triples, points = Counter(), Counter(), Counter()

    def parts(word):
        s = [0, *map(symbol, word)]
        return (s[-1], s[-2]), [tuple(s[k : k + 3]) for k in range(len(s) - 2)], [c for c in word if symbol(c) > 26]

    for word, n in words.items():
        pair, three, odd = parts(word)
        pairs[pair] += n
        for t in three:
            triples[t] += n
        for c in odd:
            points[c] += n
    everything = [(a, b) for a in range(1, 32) for b in range(32)]
    of = lambda pair: (pair[0] + 7 * pair[1]) % pl.TAIL

    def log(word):
        pair, three, odd = parts(word)
        found = math.log((pairs[pair] + 0.1) / sum(pairs[p] + 0.1 for p in everything if of(p) == of(pair)))
        for a, b, c in three:
            found += math.log((triples[a, b, c] + 0.1) / sum(triples[x, b, c] + 0.1 for x in range(32)))
        for c in odd:
            same = [x for x in range(0x110000) if x % 5 == ord(c) % 5 and x != 10 and not 97 <= x <= 122]
            found += math.log((points[c] + 0.001) / (0.001 * len(same) + sum(n for x, n in points.items() if ord(x) % 5 == ord(c) % 5)))
        return of(pair), found

    return log


def test_whole_scores_from_a_trained_network(spark, monkeypatch):
    """Counts, ids, spelling and scores of words with and without an identity, end to end against loops."""
    monkeypatch.setattr(pl, "MOST_SIDE", 4)
    monkeypatch.setattr(pl, "SPELLED", 7)
    rnd = random.Random(6)
    names = ["".join(rnd.choice("abcdefghé5") for _ in range(rnd.randint(1, 5))) for _ in range(400)]
    texts = [" ".join(names[int(rnd.paretovariate(0.7)) % 400] for _ in range(60)) for _ in range(40)] + [None, "", names[0], "UNSEEN"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    vocabulary = pl.vocabulary_of(pl.word_counts(df))
    counts = Counter(w for t in texts for w in pl.words_of(t))
    named = [w for w, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:32]]
    assert vocabulary.ids == {w: k for k, w in enumerate(named, 1)}
    spelling = plain_spelling({w: n for w, n in counts.items() if w not in named})
    spelled = {w: spelling(w) for w in counts if w not in named}
    of = lambda w: vocabulary.ids.get(w) or 33 + spelled[w][0]
    pieces = pl.packed(df, vocabulary)
    net = pl.fit(pieces, vocabulary)
    got = pl.scores(pieces, net).collect()
    assert len(got) == len(texts)
    for r in got:
        words = pl.words_of(texts[r["doc_id"]])
        more = sum(spelled[w][1] for w in words if w in spelled)
        assert abs(r["pseudo_log_likelihood"] - sum(plain_scores(net, [of(w) for w in words])) - more) < 0.01


def test_spellings_of_a_class_sum_to_one():
    spelling = pl.Spelling.of(np.arange(1024.0), np.arange(32768.0) % 11, {233: 4})
    scale = lambda x: np.exp(x / pl.FIXED)
    real = np.arange(1024) >= 32
    assert np.allclose(np.bincount(pl.CLASS_OF[real], scale(spelling.pairs[real]), pl.TAIL), 1, atol=1e-4)
    assert np.allclose(scale(spelling.triples).reshape(32, -1).sum(axis=0), 1, atol=1e-4)
    others = [k for k in range(0x110000) if k % 5 == 3 and not 97 <= k <= 122]
    assert abs(scale(spelling.points[others]).sum() - 1) < 1e-3


@pytest.mark.parametrize("size, calm", [(1.0, True), (200.0, False)])
def test_large_weights_are_told_and_scored(size, calm):
    net = some_network(3)
    net.arrays[1] *= size
    net.arrays[3] *= size
    assert net.joined()[2:] == (calm, calm)
    line, at, _ = line_of([[1, 5, 18, 2, 2, 30, 7]])
    assert np.allclose(net.score(line, at), plain_scores(net, [1, 5, 18, 2, 2, 30, 7]), rtol=1e-4, atol=1e-3)
    before = net.flat()
    net.train(line, at)
    assert np.isfinite(net.flat()).all() and (net.flat() != before).any()
