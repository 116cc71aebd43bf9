"""Masked pseudo-likelihood of documents under a bidirectional window network.

The network sees ``WINDOW`` words on either side of a position, never the word itself, and gives a distribution over
all words of the corpus for the masked position.  A document's score is the sum of the log-probabilities of all its
words, each given its own neighbours.

Words are lower-cased and counted over all rows.  The most frequent of those that occur ``LEAST`` times or more get an
identity of their own in the network, up to ``BREADTH * MOST_SIDE ** 2`` of them, in classes of equal size: the network
gives the probability of a word's class and then of the word among its class, two short softmaxes that are normalised
exactly.  All other words are told by their spelling: the network gives the probability of a class of endings, and a letter model of
such words in the corpus that of the word among those with such an ending, its last two letters first and then each
letter given the two behind it.  The probabilities of all words there can be sum to one.

Documents are dealt to shards by a hash of key and text, sorted, and packed in pieces of about ``PIECE_TOKENS`` words.
What a piece holds depends on the rows alone, not on partitions.  Training is data-parallel in numpy: in each round
every piece starts from the same weights, takes as targets those positions k of each document with k mod rounds =
round (so that every position is one once), and its weights are averaged with those of the others, by their numbers of
targets.  Weights are summed as integers, in two levels of shuffles, so that no order of tasks changes a sum.  Only the
averages (as many numbers as the network has, at most 5 MB) come to the driver.  Scores are summed as integers, too.

Rows: null and empty texts have no words and score 0; a very long text is one piece; repeated rows get equal scores, up
to the last digit shown; words of equal frequency get their ids in the order of the words; with no word in the whole
table the network stays as it began; an empty table gives no rows; extra columns, also of the names used here, are not
looked at.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm._tables import ship_package, stored

WINDOW = 2
WIDTH = 16
#: Occurrences from which a word may have an identity of its own.
LEAST = 3
#: Classes of named words at most; a class has ``BREADTH`` times as many words.
MOST_SIDE = 64
BREADTH = 2
#: Classes of endings of all other words.
TAIL = 32
#: Symbols that letters are read as: 0 stands beside a word, 1 to 26 are a to z, all others share the rest.
SYMBOLS = 32
ROUNDS = 2
RATE = 0.3
#: Positions in a gradient step (at most, and at least where there are as many), positions scored at once, and those
#: whose classes are looked at together.
BATCH = 1 << 14
LEAST_BATCH = 128
STRETCH = 1 << 14
BLOCK = 1 << 11
#: Words in a piece, and pieces at least (of tables with so many rows).
PIECE_TOKENS = 1_000_000
LEAST_PIECES = 8
#: Distinct words that a task counts before it passes the counts on.
COUNTED = 200_000
#: Words whose letters are looked at together.
SPELLED = 50_000
#: What logarithms and weights are multiplied with to be summed as integers.
FIXED = 1 << 20
#: Groups in which tasks' weights are summed first.
SALTS = 16
#: Weights in a row that is shuffled.
CHUNK = 8192


@dataclass
class Network:
    """Arrays, all float32: embed (2 * (1 + words + TAIL), WIDTH; words on the left, then words on the right), cls
    (WIDTH, side + TAIL) and its bias, word (words, WIDTH) and its bias.  Id 0 is what stands outside of a document."""

    side: int
    arrays: list[np.ndarray]

    @staticmethod
    def shapes(side: int) -> list[tuple[int, ...]]:
        n = BREADTH * side * side
        return [(2 * (1 + n + TAIL), WIDTH), (WIDTH, side + TAIL), (side + TAIL,), (n, WIDTH), (n,)]

    @staticmethod
    def fresh(named: np.ndarray, tail: np.ndarray) -> Network:
        """Small fixed weights, and biases that give the words' own frequencies (of ``named`` words, of tail classes)."""
        side = math.isqrt(len(named) // BREADTH)
        arrays = [np.zeros(s, np.float32) for s in Network.shapes(side)]
        arrays[0][:] = np.random.default_rng(5).normal(0, 0.3, arrays[0].shape)
        within = named.reshape(side, BREADTH * side)
        mass = np.concatenate([within.sum(axis=1), tail]) + 1.0
        arrays[2][:] = np.log(mass / mass.sum())
        if side:
            arrays[4][:] = np.log(within / within.sum(axis=1, keepdims=True)).ravel()
        return Network(side, arrays)

    def flat(self) -> np.ndarray:
        return np.concatenate([a.ravel() for a in self.arrays])

    @staticmethod
    def of(side: int, flat: np.ndarray) -> Network:
        shapes = Network.shapes(side)
        cuts = np.cumsum([math.prod(s) for s in shapes])[:-1]
        return Network(side, [x.astype(np.float32).reshape(s) for x, s in zip(np.split(flat, cuts), shapes)])

    def joined(self) -> tuple[np.ndarray, np.ndarray, bool, bool]:
        """cls and word with their biases as a last row and column, to be met by the one at the end of `hidden`; for both, whether no logit can be large."""
        _, cls, cls_bias, word, word_bias = self.arrays
        full, words = np.concatenate([cls, cls_bias[None]]), np.concatenate([word, word_bias[:, None]], axis=1)
        most = (np.abs(full).sum(axis=0).max(initial=0), np.abs(words).sum(axis=1).max(initial=0))
        return full, words, bool(most[0] < 60), bool(most[1] < 60)

    def hidden(self, context: np.ndarray) -> np.ndarray:
        """Positions by WIDTH, and a one behind."""
        embed = self.arrays[0]
        hidden = embed.take(context[0], axis=0)  # faster than by brackets
        for ids in context[1:]:
            hidden += embed.take(ids, axis=0)
        found = np.ones((len(hidden), WIDTH + 1), np.float32)
        found[:, :WIDTH] = np.tanh(hidden, out=hidden)
        return found

    def neighbours(self, line: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Rows of embed for the neighbours of positions: 2 * WINDOW by positions."""
        right = len(self.arrays[0]) // 2
        return np.stack([line[at + d] + np.int64(right * (d > 0)) for d in (*range(-WINDOW, 0), *range(1, WINDOW + 1))])

    def classes(self, target: np.ndarray) -> np.ndarray:
        """The class of each id."""
        breadth = BREADTH * self.side
        named = self.side * breadth
        return np.where(target <= named, (target - 1) // max(breadth, 1), self.side + target - 1 - named)

    def runs(self, classes: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Each class of words that is there, and where."""
        order, starts, which = _runs(classes)
        for c, begin, end in zip(which.tolist(), starts, [*starts[1:], len(order)]):
            if c >= self.side:
                break
            yield c, order[begin:end]

    def score(self, line: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Log-probability of the word (in the tail: of its class) at each position ``at`` given its neighbours."""
        full, words, calm, calm_words = self.joined()
        found, breadth = np.empty(len(at), np.float32), BREADTH * self.side
        for start in range(0, len(at), STRETCH):
            p = at[start : start + STRETCH]
            target = line[p].astype(np.int64)
            classes = self.classes(target)
            hidden = self.hidden(self.neighbours(line, p))
            own = np.empty(len(p), np.float32)
            for b in range(0, len(p), BLOCK):
                own[b : b + BLOCK] = _log_softmax(hidden[b : b + BLOCK] @ full, classes[b : b + BLOCK], calm)
            for c, rows in self.runs(classes):
                mine = words[c * breadth : (c + 1) * breadth].T
                for b in range(0, len(rows), BLOCK):
                    some = rows[b : b + BLOCK]
                    own[some] += _log_softmax(hidden.take(some, axis=0) @ mine, target[some] - 1 - c * breadth, calm_words)
            found[start : start + STRETCH] = own
        return found

    def train(self, line: np.ndarray, at: np.ndarray) -> None:
        """One pass of gradient steps, each scaled by the gradients that its weights have seen, over positions ``at``."""
        seen = [np.full(len(a) if k in (0, 3) else a.shape, 1e-6, np.float32) for k, a in enumerate(self.arrays)]
        batch = min(BATCH, max(LEAST_BATCH, len(at) // 32))
        for start in range(0, len(at), batch):
            self._step(line, at[start : start + batch], seen)

    def _step(self, line: np.ndarray, p: np.ndarray, seen: list[np.ndarray]) -> None:
        embed, cls, cls_bias, word, word_bias = self.arrays
        breadth, target, context = BREADTH * self.side, line[p].astype(np.int64), self.neighbours(line, p)
        classes = self.classes(target)
        hidden = self.hidden(context)
        full, words, calm, calm_words = self.joined()
        back, of_cls = np.empty((len(p), WIDTH), np.float32), np.zeros_like(full)
        for b in range(0, len(p), BLOCK):
            some = hidden[b : b + BLOCK]
            error, scale = _errors(some @ full, classes[b : b + BLOCK], calm)
            back[b : b + BLOCK] = (error @ cls.T) * scale
            of_cls += (error.T @ (some * scale)).T
        gradient = np.zeros_like(words)
        for c, rows in self.runs(classes):
            of = slice(c * breadth, (c + 1) * breadth)
            mine = words[of]
            for b in range(0, len(rows), BLOCK):
                which = rows[b : b + BLOCK]
                some = hidden.take(which, axis=0)
                error, scale = _errors(some @ mine.T, target[which] - 1 - c * breadth, calm_words)
                back[which] = back.take(which, axis=0) + (error @ word[of]) * scale
                gradient[of] += error.T @ (some * scale)
        _move(word, gradient[:, :WIDTH], seen[3])
        _move(word_bias, gradient[:, WIDTH], seen[4])
        _move(cls, of_cls[:WIDTH], seen[1])
        _move(cls_bias, of_cls[WIDTH], seen[2])
        back *= 1 - np.square(hidden[:, :WIDTH])
        ids = context.ravel()
        order, starts, rows = _runs(ids)
        moved, acc = embed.take(rows, axis=0), seen[0][rows]
        _move(moved, np.add.reduceat(back.take(order % len(p), axis=0), starts), acc)
        embed[rows], seen[0][rows] = moved, acc


def _runs(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order of small numbers by value, where each value begins in it, and the values."""
    order = np.argsort(ids.astype(np.uint16), kind="stable")  # a radix sort
    values = ids[order]
    starts = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(ids) else np.zeros(0, np.int64)
    return order, starts, values[starts]


def _errors(logits: np.ndarray, own: np.ndarray, calm: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities, less one at ``own``, in place; each row is still to be multiplied with the second result.  ``calm``: no logit is large."""
    if not calm:
        logits -= logits.max(axis=1, keepdims=True)
    np.exp(logits, out=logits)
    sums = logits @ np.ones(logits.shape[1], np.float32)
    logits[np.arange(len(own)), own] -= sums
    return logits, (1 / sums)[:, None]


def _log_softmax(logits: np.ndarray, at: np.ndarray, calm: bool = False) -> np.ndarray:
    if not calm:
        logits -= logits.max(axis=1, keepdims=True)
    own = logits[np.arange(len(at)), at]
    return own - np.log(np.exp(logits, out=logits) @ np.ones(logits.shape[1], np.float32))


def _move(weights: np.ndarray, gradient: np.ndarray, seen: np.ndarray) -> None:
    """A step in place; ``seen`` has one number for each weight or for each row of weights."""
    if seen.ndim < weights.ndim:
        seen += np.square(gradient).mean(axis=1)
        weights -= RATE * gradient / np.sqrt(seen)[:, None]
    else:
        seen += gradient * gradient
        weights -= RATE * gradient / np.sqrt(seen)


def laid_out(tokens: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents in one line with WINDOW zeros around each; the positions of their words; where each document begins among these."""
    begins = np.cumsum(sizes) - sizes
    at = np.arange(len(tokens)) + WINDOW * (np.repeat(np.arange(len(sizes)), sizes) + 1)
    line = np.zeros(len(tokens) + WINDOW * (len(sizes) + 1), np.uint16)
    line[at] = tokens
    return line, at, begins


def targets(at: np.ndarray, begins: np.ndarray, part: int, parts: int) -> np.ndarray:
    """Those of ``at`` whose place in their document is ``part`` modulo ``parts``."""
    sizes = np.diff(begins, append=len(at))
    return at[(np.arange(len(at)) - np.repeat(begins, sizes)) % parts == part]


def words_of(text: str | None) -> list[str]:
    return (text or "").lower().split()


def letters_of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points and symbols of words, with a line break and symbol 0 before each and behind the last."""
    points = np.frombuffer(("\n" + "\n".join(words) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    others = 27 + points % (SYMBOLS - 27)
    return points, np.where(points == 10, 0, np.where((points >= 97) & (points <= 122), points - 96, others))


def places_of(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Where words end and the pairs (last symbol, the one before) there; where symbols (or breaks) stand before two symbols of
    one word, and those triples."""
    ends = np.flatnonzero((symbols[1:-1] > 0) & (symbols[2:] == 0)) + 1
    before = np.flatnonzero((symbols[1:-1] > 0) & (symbols[2:] > 0))
    return ends, symbols[ends] * SYMBOLS + symbols[ends - 1], before, (symbols[before] * SYMBOLS + symbols[before + 1]) * SYMBOLS + symbols[before + 2]


#: The class of endings of each pair.
CLASS_OF = (np.arange(SYMBOLS * SYMBOLS) // SYMBOLS + 7 * (np.arange(SYMBOLS * SYMBOLS) % SYMBOLS)) % TAIL


@dataclass
class Spelling:
    """Fixed-point logarithms: of pairs given their class, of symbols given the two behind them, of code points given their symbol."""

    pairs: np.ndarray
    triples: np.ndarray
    points: np.ndarray

    @staticmethod
    def of(pairs: np.ndarray, triples: np.ndarray, points: dict[int, int]) -> Spelling:
        """From counts; everything that can be has a little more than what was counted."""
        real = np.arange(SYMBOLS * SYMBOLS) >= SYMBOLS  # a word's last symbol is no break
        pairs = np.where(real, pairs + 0.1, 0.0)
        share = pairs / np.maximum(np.bincount(CLASS_OF, pairs, TAIL)[CLASS_OF], 1e-9)
        behind = triples.reshape(SYMBOLS, -1) + 0.1
        other = np.full(0x110000, 0.001)
        other[97:123] = 0
        other[10] = 0
        other[list(points)] += list(points.values())
        symbol = 27 + np.arange(0x110000) % (SYMBOLS - 27)
        rest = np.where(other > 0, other / np.bincount(symbol, other)[symbol], 1.0)
        fixed = lambda x: np.rint(np.log(np.maximum(x, 1e-300)) * FIXED).astype(np.int64)
        return Spelling(fixed(np.where(real, share, 1.0)), fixed((behind / behind.sum(axis=0)).ravel()), fixed(rest).astype(np.int32))

    def spelled(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The class and the logarithm among its class of each word."""
        points, symbols = letters_of(words)
        ends, pairs, before, triples = places_of(symbols)
        each = np.where(symbols > 0, self.points[points], 0).astype(np.int64)
        each[ends] += self.pairs[pairs]
        each[before] += self.triples[triples]
        return CLASS_OF[pairs], np.add.reduceat(each, np.flatnonzero(symbols == 0)[:-1])


def word_counts(df: DataFrame, *, text: str = "text") -> DataFrame:
    """word and n over all rows."""
    ship_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()

        def passed() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])
            counts.clear()
            return out

        for batch in batches:
            for x in batch.column(0):
                counts.update(words_of(x.as_py()))
                if len(counts) > COUNTED:
                    yield passed()
        yield passed()

    return df.select(df[text].alias("text")).mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Vocabulary:
    """Ids of the named words, their counts, the counts of the classes of endings, and the spelling of all other words."""

    ids: dict[str, int]
    named: np.ndarray
    tail: np.ndarray
    spelling: Spelling


def vocabulary_of(counts: DataFrame) -> Vocabulary:
    """From word and n; the most frequent words are named (ties: the smaller word)."""
    side = min(MOST_SIDE, math.isqrt(counts.where(F.col("n") >= LEAST).count() // BREADTH))
    top = counts.orderBy(F.desc("n"), "word").limit(BREADTH * side * side).collect()  # at most BREADTH * MOST_SIDE squared
    ids = {r["word"]: k for k, r in enumerate(top, 1)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, triples, points = np.zeros(SYMBOLS**2), np.zeros(SYMBOLS**3), Counter()
        for batch in batches:
            for start in range(0, batch.num_rows, SPELLED):
                rows = zip(*(batch.column(k).slice(start, SPELLED).to_pylist() for k in (0, 1)))
                rest = [(w, n) for w, n in rows if w not in ids]
                if rest:
                    words, n = [w for w, _ in rest], np.array([n for _, n in rest], float)
                    codes, symbols = letters_of(words)
                    _, pair, before, triple = places_of(symbols)
                    of = np.cumsum(symbols == 0) - 1  # the word of each symbol
                    pairs += np.bincount(pair, n, SYMBOLS**2)
                    triples += np.bincount(triple, n[of[before]], SYMBOLS**3)
                    odd = symbols > 26
                    for code, k in zip(*(x.tolist() for x in _weighed(codes[odd], n[of[odd]]))):
                        points[code] += int(k)
        for kind, (at, n) in enumerate(((np.flatnonzero(pairs), pairs), (np.flatnonzero(triples), triples), (np.array(list(points), np.int64), None))):
            found = np.array(list(points.values()), np.int64) if n is None else n[at].astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), kind)), pa.array(at), pa.array(found)], ["kind", "at", "n"])

    # rows: pairs, triples and code points that occur, however large the corpus is
    sums = counts.select("word", "n").mapInArrow(run, "kind bigint, at bigint, n bigint").groupBy("kind", "at").agg(F.sum("n").alias("n")).collect()
    pairs, triples, points = np.zeros(SYMBOLS**2), np.zeros(SYMBOLS**3), {}
    for r in sums:
        (pairs, triples, points)[r["kind"]][r["at"]] = r["n"]
    return Vocabulary(ids, np.array([r["n"] for r in top], float), np.bincount(CLASS_OF, pairs, TAIL), Spelling.of(pairs, triples, points))


def _weighed(codes: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    values, which = np.unique(codes, return_inverse=True)
    return values, np.bincount(which, weights, len(values))


def packed(df: DataFrame, vocabulary: Vocabulary, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """keys, sizes, tokens, spelled: pieces of documents with two bytes a word, and of each document the sum of the
    logarithms that spell its words without a name."""
    kind = df.schema[key].dataType.simpleString()
    pieces = max(LEAST_PIECES, -(-int(vocabulary.named.sum() + vocabulary.tail.sum()) // PIECE_TOKENS))
    spark = df.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast((vocabulary.ids, vocabulary.spelling))  # a bounded number of words, and 5 MB

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, spelling = shared.value
        first = len(ids) + 1
        for batch in batches:
            tokens, sums = [], []
            lines: list[tuple[np.ndarray, np.ndarray]] = []
            unnamed: list[str] = []
            for k, x in enumerate(batch.column(2), 1):
                words = words_of(x.as_py())
                line = np.array([ids.get(w, 0) for w in words], np.int64)
                others = np.flatnonzero(line == 0)
                unnamed += [words[j] for j in others.tolist()]
                lines.append((line, others))
                if len(unnamed) >= SPELLED or k == batch.num_rows:
                    classes, logs = spelling.spelled(unnamed) if unnamed else (np.zeros(0, np.int64),) * 2
                    cuts = np.cumsum([len(o) for _, o in lines])
                    before = np.concatenate([[0], np.cumsum(logs)])
                    for (line, others), end in zip(lines, cuts.tolist()):
                        line[others] = first + classes[end - len(others) : end]
                        tokens.append(line.astype(np.uint16).tobytes())
                        sums.append(int(before[end] - before[end - len(others)]))
                    lines, unnamed = [], []
            shards = np.mod(batch.column(1).to_numpy(), pieces).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(shards), batch.column(1), batch.column(0), pa.array(tokens, pa.binary()), pa.array(sums, pa.int64())], ["shard", "mark", "key", "tokens", "spelled"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, size, held = None, 0, []

        def piece() -> pa.RecordBatch:
            keys, tokens, spelled = (pa.concat_arrays(x) for x in zip(*held))
            widths = np.diff(np.frombuffer(tokens.buffers()[1], np.int32)[: len(tokens) + 1]).astype(np.int64) // 2
            lists = [pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), x) for x in (keys, pa.array(widths), spelled)]
            whole = pa.array([b"".join(tokens.to_pylist())], pa.binary())
            return pa.RecordBatch.from_arrays([lists[0], lists[1], whole, lists[2]], ["keys", "sizes", "tokens", "spelled"])

        for batch in batches:
            sizes = np.diff(np.frombuffer(batch.column(2).buffers()[1], np.int32)[batch.column(2).offset :][: batch.num_rows + 1]) // 2 if batch.num_rows else []
            begin = 0
            for k, (this, n) in enumerate(zip(batch.column(0).to_pylist(), sizes)):
                if shard is not None and (this != shard or size >= PIECE_TOKENS):
                    if k > begin:
                        held.append([batch.column(c).slice(begin, k - begin) for c in (1, 2, 3)])
                    yield piece()
                    held, size, begin = [], 0, k
                shard, size = this, size + int(n)
            if batch.num_rows > begin:
                held.append([batch.column(c).slice(begin) for c in (1, 2, 3)])
        if held:
            yield piece()

    rows = df.select(df[key].alias("key"), F.xxhash64(df[key], df[text]).alias("mark"), df[text].alias("text"))
    encoded = rows.mapInArrow(encode, f"shard bigint, mark bigint, key {kind}, tokens binary, spelled bigint")
    # by four times as many partitions as shards, so that few shards share one
    dealt = encoded.repartition(4 * pieces, "shard").sortWithinPartitions("shard", "mark", "key", "tokens").select("shard", "key", "tokens", "spelled")
    return stored(dealt.mapInArrow(pack, f"keys array<{kind}>, sizes array<bigint>, tokens binary, spelled array<bigint>"))


def _summed(rows: DataFrame, by: list[str]) -> DataFrame:
    """Sums of values (an array of integers as bytes) and units of the rows with equal ``by``, one after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, values, units = None, None, 0

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([*(pa.array([x]) for x in key), pa.array([values.tobytes()]), pa.array([units])], [*by, "values", "units"])

        for batch in batches:
            for *this, x, n in zip(*(batch.column(k).to_pylist() for k in range(len(by))), batch.column(len(by)), batch.column(len(by) + 1).to_pylist()):
                if this != key:
                    if key is not None:
                        yield out()
                    key, values, units = this, np.zeros(len(x.as_buffer()) // 8, np.int64), 0
                values += np.frombuffer(x.as_buffer(), np.int64)
                units += n
        if key is not None:
            yield out()

    dealt = rows.select(*by, "values", "units").repartition(*by).sortWithinPartitions(*by)
    return dealt.mapInArrow(run, ", ".join([*(f"{c} bigint" for c in by), "values binary", "units bigint"]))


def _averaged(pieces: DataFrame, start: Network, part: int, parts: int) -> Network:
    """One round: every piece trains from ``start`` on its ``targets``; the weighted mean of what the pieces have."""
    side = start.side
    weights = pieces.sparkSession.sparkContext.broadcast(start.flat())  # as large as the network

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, units = None, 0
        for batch in batches:
            for sizes, tokens in zip(batch.column(0), batch.column(1)):
                line, at, begins = laid_out(np.frombuffer(tokens.as_buffer(), np.uint16), sizes.values.to_numpy())
                own = targets(at, begins, part, parts)
                if len(own):
                    network, n = Network.of(side, weights.value), 1 + len(own) // 1024
                    network.train(line, own)
                    trained = np.rint(network.flat().astype(np.float64) * FIXED).astype(np.int64) * n
                    total, units = trained if total is None else total + trained, units + n
        if total is not None:
            task = TaskContext.get().partitionId() % SALTS
            for k, begin in enumerate(range(0, len(total), CHUNK)):
                row = [pa.array([k]), pa.array([task]), pa.array([total[begin : begin + CHUNK].tobytes()]), pa.array([units])]
                yield pa.RecordBatch.from_arrays(row, ["chunk", "salt", "values", "units"])

    trained = pieces.select("sizes", "tokens").mapInArrow(run, "chunk bigint, salt bigint, values binary, units bigint")
    sums = _summed(_summed(trained, ["chunk", "salt"]), ["chunk"]).orderBy("chunk").collect()  # as large as the network
    if not sums:
        return start
    return Network.of(side, np.concatenate([np.frombuffer(r["values"], np.int64) / (FIXED * r["units"]) for r in sums]))


def fit(pieces: DataFrame, vocabulary: Vocabulary, *, rounds: int = ROUNDS) -> Network:
    """A network trained on every position of the packed documents."""
    network = Network.fresh(vocabulary.named, vocabulary.tail)
    for k in range(rounds):
        network = _averaged(pieces, network, k, rounds)
    return network


def scores(pieces: DataFrame, network: Network, *, key: str = "doc_id") -> DataFrame:
    """``key``, n_tokens, pseudo_log_likelihood (the sum) and per_token (mean; null without words) of packed documents."""
    weights = pieces.sparkSession.sparkContext.broadcast(network.flat())
    kind = pieces.schema["keys"].dataType.elementType.simpleString()
    side = network.side

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = Network.of(side, weights.value)
        for batch in batches:
            for keys, sizes, tokens, spelled in zip(*batch.columns):
                sizes = sizes.values.to_numpy()
                line, at, _ = laid_out(np.frombuffer(tokens.as_buffer(), np.uint16), sizes)
                each = np.rint(network.score(line, at).astype(np.float64) * FIXED).astype(np.int64)
                totals = _by_document(each, sizes) + spelled.values.to_numpy()
                yield pa.RecordBatch.from_arrays([keys.values, pa.array(sizes), pa.array(totals)], ["key", "n", "total"])

    found = pieces.select("keys", "sizes", "tokens", "spelled").mapInArrow(run, f"key {kind}, n bigint, total bigint")
    sums = F.col("total").cast("double") / FIXED
    mean = F.when(F.col("n") > 0, sums / F.col("n"))
    return found.select(F.col("key").alias(key), F.col("n").alias("n_tokens"), F.round(sums, 3).alias("pseudo_log_likelihood"), F.round(mean, 4).alias("per_token"))


def _by_document(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    before = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(sizes)
    return before[ends] - before[ends - sizes]


def score_documents(df: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Vocabulary, network and scores, all from ``df``."""
    vocabulary = vocabulary_of(stored(word_counts(df, text=text)))
    pieces = packed(df, vocabulary, key=key, text=text)
    return scores(pieces, fit(pieces, vocabulary), key=key)
