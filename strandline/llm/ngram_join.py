"""Similarity join of documents by the exact Jaccard similarity of their sets of five-word shingles (n-grams).

Two documents link when SHARE percent of the n-grams that either has are in both.  All work is on n-grams as they stand in
one global order, which is cut in fragments; a document's set becomes one segment in each fragment (vertical partitioning).

1.  *Order.*  Every task counts all n-grams of its documents by a hash in ``CELLS`` cells; the sums (of a fixed size) say how
    common an n-gram can be at most.  Scarce cells come first, n-grams of one cell by their hashes.  Any order gives right
    results; this one keeps passages and lines that many documents share out of the way.
2.  *Candidates.*  Of two linked sets each has an n-gram of the other among its first |set| - ceil(SHARE |set|) + 1.  Those are
    sent to the fragments, packed by the thousands; a fragment's task sorts them and keeps those that several sets have.  An
    n-gram whose cell is so full that it could fill a task (`HEAVY`) passes as rows that Spark groups.
3.  *Partial overlaps.*  For each pair to compare, segments of both are joined by fragment, and what they share is counted in
    each fragment separately; counts are summed per pair.  Before, each fragment's segment is known by 128 bits, each the parity
    of the n-grams that fall to it: two segments differ in as many n-grams as bits, at least, and pairs whose bits alone differ
    by more than linked sets may are not made.
4.  *Which pairs.*  First each candidate is compared with a few others at every n-gram that they share; sets that are connected
    get one label.  Then all candidates that have different labels and can still be similar, by their sizes, their bits and
    by what comes after the shared n-gram, are compared.  So a group of many near copies costs pairs in proportion to its size,
    and no link between sets that are not connected otherwise is lost.

Equal sets are one from the start.  Null, empty and wordless texts have the empty set and are linked with nothing, not even
with each other; texts of fewer than five words have one n-gram, all their words; very long texts are taken whole; a
similarity of just SHARE percent links (a tie, told with integers); rows with equal keys, and repeated rows, each give a row;
null keys take part but name no component (null where no row of it has a key); an empty table gives no rows; extra
columns, of whatever name, are not looked at.  Sets are told apart by 64-bit hashes of their n-grams' 64-bit hashes.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.llm import simhash
from strandline.llm._tables import dealt_join, ship_package, stored
from strandline.llm.components import min_components

SEED = 42
SHINGLE = 5
#: Percent of the union that must be shared.
SHARE = 80
#: Cells that n-grams are counted in (4 bytes each, on the driver and in each task), and cells in a row of counts.
CELLS = 1 << 20
CHUNK = 1 << 13
#: N-grams that a fragment of the candidate search holds on average, and the fewest fragments.
FRAGMENT = 1 << 20
FEWEST = 48
#: N-grams in a cell, at least and in means of all cells, from which they are not searched in one task.
HEAVY = (1 << 17, 4)
#: N-grams packed at once.
PACKED = 1 << 19
#: Bits that tell the fragments of partial counts, and bits that tell the parities of one.
FRAGMENT_BITS = 2
PARITY_BITS = 7
#: Sets of a place that all others of it are compared with first.
HEADS = 4
#: Bytes of text that are hashed at once.
PIECE = 1 << 19
#: Sets that a task remembers, so as to pack copies once.
KEPT_NAMES = 1 << 20

_MIX = np.uint64(0x9E3779B97F4A7C15)


_SPACE = np.zeros(256, bool)
_SPACE[list(b" \t\n\x0b\x0c\r")] = True
_LOWER = np.array([*bytes(range(256)).lower()], np.uint64) + np.uint64(1)
_BREAK = re.compile(rb"[ \t-\r]")


def _weights(n: int) -> np.ndarray:
    """A fixed random odd number for each place in a word (the steps and products of a well-known generator of 64 bits)."""
    x = np.arange(1, n + 1, dtype=np.uint64) * _MIX + np.uint64(SEED)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return (x ^ (x >> np.uint64(31))) | np.uint64(1)


_WEIGHTS = _weights(256)


def _word_hashes(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each word (A-Z lower-cased, between ASCII white space): its bytes, weighted by their places; and where words begin."""
    raw = np.frombuffer(text, np.uint8)
    space = np.concatenate([[True], _SPACE[raw], [True]])
    edges = np.flatnonzero(space[1:] != space[:-1])
    begins, lengths = edges[::2], edges[1::2] - edges[::2]
    if not len(begins):
        return np.zeros(0, np.uint64), begins
    first = np.cumsum(lengths) - lengths
    place = np.arange(lengths.sum()) - np.repeat(first, lengths)
    longest = int(lengths.max())
    weights = _WEIGHTS if longest <= len(_WEIGHTS) else _weights(longest)
    found = np.add.reduceat(_LOWER[raw[~space[1:-1]]] * weights[place], first)
    return (found ^ (found >> np.uint64(32))) * _MIX, begins


def _mixed(words: np.ndarray, width: int) -> np.ndarray:
    found = np.full(len(words) - width + 1, width, np.uint64)
    for k in range(width):
        found = (found ^ words[k : k + len(found)]) * _MIX
        found ^= found >> np.uint64(29)
    return found


def _distinct_sorted(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.concatenate([[True], values[1:] != values[:-1]])] if len(values) else values


def _long_words(text: bytes) -> np.ndarray:
    """The words of a long text, in pieces."""
    found, start = [], 0
    while start < len(text):
        cut = _BREAK.search(text, start + PIECE)
        end = cut.start() if cut else len(text)
        found.append(_word_hashes(text[start:end])[0])
        start = end
    return np.concatenate(found)


def ngram_sets(texts: Iterable[bytes | None]) -> Iterator[np.ndarray]:
    """Sorted distinct hashes of each text's n-grams; texts are taken together up to ``PIECE`` bytes, longer ones in pieces."""

    def sets(held: list[bytes]) -> Iterator[np.ndarray]:
        if len(held) == 1 and len(held[0]) > PIECE:
            words = _long_words(held[0])
            bounds = np.array([0, len(words)])
        else:
            words, begins = _word_hashes(b"\n".join(held))
            bounds = np.searchsorted(begins, np.cumsum([0, *[len(x) + 1 for x in held]]))
        grams = _mixed(words, SHINGLE) if len(words) >= SHINGLE else words
        for start, end in zip(bounds[:-1], bounds[1:]):
            if end - start >= SHINGLE:
                yield _distinct_sorted(grams[start : end - SHINGLE + 1])
            else:
                yield _mixed(words[start:end], int(end - start)) if end > start else words[:0]

    held, size = [], 0
    for text in texts:
        text = text or b""
        if held and size + len(text) > PIECE:
            yield from sets(held)
            held, size = [], 0
        held.append(text)
        size += len(text)
    if held:
        yield from sets(held)


def ngrams(text: bytes | None) -> np.ndarray:
    return next(ngram_sets([text]))


def _texts(column: pa.Array) -> Iterator[bytes | None]:
    for x in column:
        whole = x.as_buffer()
        yield whole.to_pybytes() if whole is not None else None


def set_name(grams: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh64_intdigest(grams.tobytes(), SEED)).view(np.int64))


def cell_of(grams: np.ndarray) -> np.ndarray:
    return (grams & np.uint64(CELLS - 1)).astype(np.int64)


WORDS = [f"bits_{k}" for k in range(1 << (FRAGMENT_BITS + PARITY_BITS - 6))]


def parities(grams: np.ndarray) -> np.ndarray:
    """The parities of each fragment's segment of a set, as int64."""
    place = ((grams >> np.uint64(64 - FRAGMENT_BITS)) << np.uint64(PARITY_BITS)) | ((grams >> np.uint64(24)) & np.uint64((1 << PARITY_BITS) - 1))
    return np.packbits(np.bincount(place.astype(np.int64), minlength=64 * len(WORDS)) & 1, bitorder="little").view("<i8")


def least_shared(size: int) -> int:
    """N-grams of a set that a set linked with it has at least."""
    return -(-SHARE * size // 100)


def leading(grams: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams that may be the first ones shared with a linked set, and how many come after each in the order."""
    n, full = len(grams) - least_shared(len(grams)) + 1, counts[cell_of(grams)]
    near = np.flatnonzero(full <= np.partition(full, n - 1)[n - 1])
    order = near[np.argsort(full[near], kind="stable")][:n]  # n-grams are sorted already
    return grams[order], len(grams) - 1 - np.arange(len(order))


def _small(counts: np.ndarray) -> bytes:
    """Counts in as few bytes as they need, the width first."""
    width = next(w for w in (1, 2, 4, 8) if counts.max(initial=0) < 1 << (8 * w - 1))
    return bytes([width]) + counts.astype(f"<i{width}").tobytes()


def _signed(docs: DataFrame) -> DataFrame:
    """From key, mark and body: id, name, size and parities of the set for each row; and rows of chunk and counts for each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(CELLS, np.int64)
        kind, columns = None, ["id", "name", "size", *WORDS, "chunk", "counts"]
        for batch in batches:
            names, sizes, bits, waiting, held = [], [], [], [], 0
            kind = batch.column(0).type
            for grams in ngram_sets(_texts(batch.column(1))):
                names.append(set_name(grams))
                sizes.append(len(grams))
                bits.append(parities(grams))
                waiting.append(cell_of(grams))
                held += len(grams)
                if held > PACKED:
                    counts += np.bincount(np.concatenate(waiting), minlength=CELLS)
                    waiting, held = [], 0
            if held:
                counts += np.bincount(np.concatenate(waiting), minlength=CELLS)
            n, words = len(names), np.array(bits, np.int64).reshape(-1, len(WORDS))
            own = [pa.array(names, pa.int64()), pa.array(sizes, pa.int64()), *[pa.array(np.ascontiguousarray(words[:, k])) for k in range(len(WORDS))]]
            yield pa.RecordBatch.from_arrays([batch.column(0), *own, pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], columns)
        if kind is not None:
            chunks = [k for k in range(CELLS // CHUNK) if counts[k * CHUNK : (k + 1) * CHUNK].any()]
            packed = [_small(counts[k * CHUNK : (k + 1) * CHUNK]) for k in chunks]
            n = len(chunks)
            yield pa.RecordBatch.from_arrays([pa.nulls(n, kind), *[pa.nulls(n, pa.int64())] * (2 + len(WORDS)), pa.array(chunks, pa.int32()), pa.array(packed, pa.binary())], columns)
        pa.default_memory_pool().release_unused()  # the worker lives on

    rows = docs.select(F.struct("key", "mark").alias("id"), "body")
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, name bigint, size bigint, {', '.join(f'{w} bigint' for w in WORDS)}, chunk int, counts binary")


def _order(chunks: DataFrame) -> np.ndarray:
    """The counts of all cells, of a fixed size; ``chunks``: chunk and counts of each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sums[chunk] = sums.get(chunk, 0) + np.frombuffer(packed, f"<i{packed[0]}", offset=1).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], ["chunk", "counts"])

    counts = np.zeros(CELLS, np.int64)
    for row in chunks.select("chunk", "counts").repartition("chunk").mapInArrow(run, "chunk int, counts binary").collect():
        counts[row["chunk"] * CHUNK : (row["chunk"] + 1) * CHUNK] = np.frombuffer(row["counts"], np.int64)
    return counts


def _packed(docs: DataFrame, counts: np.ndarray, fragments: int) -> DataFrame:
    """Leading n-grams of every set, many sets in a row for each fragment."""
    shared = docs.sparkSession.sparkContext.broadcast(counts)
    heavy = max(HEAVY[0], int(HEAVY[1] * counts.mean()))

    def rows(grams: list, rests: list, names: list, sizes: list, turn: int) -> Iterator[tuple]:
        flat, rest = np.concatenate(grams), np.concatenate(rests).astype(np.uint32)
        owner = np.repeat(np.arange(len(grams), dtype=np.uint32), [len(g) for g in grams])
        fragment = ((flat >> np.uint64(32)) * np.uint64(fragments) >> np.uint64(32)).astype(np.int64)
        place = (fragment << 32) | (flat & np.uint64(0xFFFFFFFF)).astype(np.int64)
        # full cells: their rows go anywhere, and on as they are
        to = np.where(shared.value[cell_of(flat)] > heavy, fragments + (owner + turn) % fragments, fragment)
        order = np.argsort(to, kind="stable")
        edges = np.flatnonzero(np.diff(to[order], prepend=-1, append=-1))
        name, size = np.array(names, np.int64), np.array(sizes, np.uint32)
        for start, end in zip(edges[:-1], edges[1:]):
            own = order[start:end]
            here, numbers = np.unique(owner[own], return_inverse=True)
            number = int(to[own[0]])
            token = place[own] if number >= fragments else place[own].astype(np.uint32)
            yield number, token.tobytes(), numbers.astype(np.uint32).tobytes(), rest[own].tobytes(), name[here].tobytes(), size[here].tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = 0
        grams, rests, names, sizes, held, seen = [], [], [], [], 0, set()

        def made() -> pa.RecordBatch:
            columns = list(zip(*rows(grams, rests, names, sizes, turn)))
            return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), *[pa.array(c, pa.binary()) for c in columns[1:]]], ["fragment", "tokens", "owners", "rests", "names", "sizes"])

        for batch in batches:
            for found in ngram_sets(_texts(batch.column(0))):
                if not len(found) or (name := set_name(found)) in seen:
                    continue
                seen.add(name)
                lead, rest = leading(found, shared.value)
                grams.append(lead)
                rests.append(rest)
                names.append(name)
                sizes.append(len(found))
                held += len(lead)
                if held > PACKED:
                    yield made()
                    turn += 1
                    grams, rests, names, sizes, held = [], [], [], [], 0
                    if len(seen) > KEPT_NAMES:
                        seen.clear()
        if held:
            yield made()
        pa.default_memory_pool().release_unused()

    return docs.select("body").mapInArrow(run, "fragment bigint, tokens binary, owners binary, rests binary, names binary, sizes binary")


SPOTS = "place bigint, name bigint, size bigint, rest bigint"


def meets(token: np.ndarray, size: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """Which rows may be similar to another of the same n-gram, by their sizes and what comes after it; of two rows alone, exactly."""
    able = np.flatnonzero(100 * (1 + rest) >= SHARE * size)  # else no set can share enough from here on
    order = able[np.lexsort((size[able], token[able]))]
    found = np.zeros(len(token), bool)
    if len(order) < 2:
        return found
    token, size, rest = token[order], size[order], rest[order]
    same = token[1:] == token[:-1]
    near = same & (100 * size[:-1] >= SHARE * size[1:])
    close = near & ((100 + SHARE) * (1 + np.minimum(rest[1:], rest[:-1])) >= SHARE * (size[1:] + size[:-1]))
    alone = same & ~np.concatenate([[False], same[:-1]]) & ~np.concatenate([same[1:], [False]])
    linked = np.where(alone, close, near)
    found[order[np.concatenate([linked, [False]]) | np.concatenate([[False], linked])]] = True
    return found


def _spots(packed: DataFrame, fragments: int) -> DataFrame:
    """place (an n-gram), name, size and rest of leading n-grams that several sets have which may be similar (of full cells: of all)."""

    def table(place: np.ndarray, name: np.ndarray, size: np.ndarray, rest: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.asarray(c, np.int64)) for c in (place, name, size, rest)], ["place", "name", "size", "rest"])

    def several(parts: list[tuple]) -> Iterator[pa.RecordBatch]:
        if not parts:
            return
        fragment = parts[0][0]
        shift = np.cumsum([0, *[len(p[4]) for p in parts]])
        token, rest, names, sizes = (np.concatenate([p[k] for p in parts]) for k in (1, 3, 4, 5))
        owner = np.concatenate([p[2] + np.uint64(s) for p, s in zip(parts, shift)]).astype(np.int64)
        names, first, same = np.unique(names, return_index=True, return_inverse=True)
        owner = same[owner]
        order = np.lexsort((-rest.astype(np.int64), owner, token))
        token, owner, rest = token[order], owner[order], rest[order]
        once = np.concatenate([[True], (token[1:] != token[:-1]) | (owner[1:] != owner[:-1])])
        token, owner, rest = token[once], owner[once], rest[once]
        size, rest = sizes[first][owner].astype(np.int64), rest.astype(np.int64)
        kept = np.flatnonzero(meets(token, size, rest))
        yield table((fragment << 32) | token[kept].astype(np.int64), names[owner[kept]], size[kept], rest[kept])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple] = []
        for batch in batches:
            for row in range(batch.num_rows):
                fragment = batch.column(0)[row].as_py()
                cells = [batch.column(k)[row].as_buffer() for k in range(1, 6)]
                kinds = (np.int64 if fragment >= fragments else np.uint32, np.uint32, np.uint32, np.int64, np.uint32)
                token, owner, rest, names, sizes = (np.frombuffer(c, kind) for c, kind in zip(cells, kinds))
                if fragment >= fragments:
                    yield table(token, names[owner], sizes[owner], rest)
                    continue
                if parts and parts[0][0] != fragment:
                    yield from several(parts)
                    parts = []
                parts.append((fragment, token.copy(), owner.astype(np.uint64), rest.copy(), names.copy(), sizes.copy()))
        yield from several(parts)
        pa.default_memory_pool().release_unused()

    spots = packed.repartition("fragment").sortWithinPartitions("fragment").mapInArrow(run, SPOTS)
    return spots


def _segments(docs: DataFrame) -> DataFrame:
    """name, fragment and grams of the sets of ``docs``, a row for each fragment that has any."""
    shift = np.uint64(64 - FRAGMENT_BITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, numbers, segments = [], [], []
            for grams in ngram_sets(_texts(batch.column(0))):
                edges = np.flatnonzero(np.diff((grams >> shift).astype(np.int64), prepend=-1, append=-1))
                for start, end in zip(edges[:-1], edges[1:]):
                    numbers.append(int(grams[start] >> shift))
                    segments.append(grams[start:end].view(np.int64))
                names += [set_name(grams)] * (len(edges) - 1)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(numbers, pa.int32()), pa.array(segments, pa.list_(pa.int64()))], ["name", "fragment", "grams"])
        pa.default_memory_pool().release_unused()

    return docs.select("body").mapInArrow(run, "name bigint, fragment int, grams array<bigint>")


def _overlaps(pairs: DataFrame, segments: DataFrame) -> DataFrame:
    """a, b and shared of pairs a, b: what they share in each fragment, summed; none where no fragment has both."""
    of_b = pairs.select("a", "b").join(segments.withColumnsRenamed({"name": "b", "grams": "grams_b"}), "b")
    both = of_b.join(segments.withColumnsRenamed({"name": "a", "grams": "grams_a"}), ["a", "fragment"])
    counted = both.select("a", "b", "fragment", F.size(F.array_intersect("grams_a", "grams_b")).cast("bigint").alias("shared"))
    # a segment stands twice where a text does; its count is one
    each = counted.repartition("a", "b").groupBy("a", "b", "fragment").agg(F.max("shared").alias("shared"))
    return each.groupBy("a", "b").agg(F.sum("shared").alias("shared"))


def _linked(pairs: DataFrame, segments_of: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Those of ``pairs`` (a, b, sizes) that are similar enough, as a, b; ``segments_of``: segments of the sets of some names."""
    pairs = stored(pairs)
    sums = _overlaps(pairs, stored(segments_of(_names(pairs))))
    return pairs.join(sums, ["a", "b"]).where(100 * F.col("shared") >= SHARE * (F.col("size_a") + F.col("size_b") - F.col("shared"))).select("a", "b")


def _names(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("name")).distinct()


def _possible(one: str, other: str) -> Column:
    """Whether two sets that meet at an n-gram can be similar, and this can be the first one that they share: by sizes and by what comes after it.

    Names of columns have these beginnings.
    """
    size_a, size_b = F.col(f"{one}size"), F.col(f"{other}size")
    rest = F.least(F.col(f"{one}rest"), F.col(f"{other}rest"))
    return (100 * F.least(size_a, size_b) >= SHARE * F.greatest(size_a, size_b)) & ((100 + SHARE) * (1 + rest) >= SHARE * (size_a + size_b))


def _near(one: str, other: str, sizes: Column) -> Column:
    """Whether parities differ by no more than linked sets may: these share SHARE / (100 + SHARE) of their sizes, and differ in the rest."""
    apart = reduce(add, [F.bit_count(F.col(f"{one}{w}").bitwiseXOR(F.col(f"{other}{w}"))) for w in WORDS])
    return (100 + SHARE) * apart <= (100 - SHARE) * sizes


#: What is known of a set at a place.
_SET = ["name", "label", "size", "rest"]


def _size_class(size: Column) -> Column:
    """Sizes in classes: those of sets that can be similar are in one class or in neighbouring ones."""
    return F.floor(F.log(size.cast("double")) / float(np.log(100 / SHARE))).cast("int")


def _open(spots: DataFrame, labels: DataFrame | None) -> DataFrame:
    """``spots`` with label, class of size, and top (the label that most of the place have), of places with several labels."""
    rows = spots.withColumn("label", F.col("name"))
    if labels is not None:
        rows = spots.join(labels, "name", "left").withColumn("label", F.coalesce("label", "name"))
    each = rows.groupBy("place", "label").agg(F.count(F.lit(1)).alias("n"))
    tops = each.groupBy("place").agg(F.max(F.struct("n", "label"))["label"].alias("top"), F.count(F.lit(1)).alias("several")).where("several > 1").drop("several")
    return stored(rows.withColumn("class", _size_class(F.col("size"))).join(tops, "place"))


def _few_pairs(rows: DataFrame, bits: DataFrame) -> DataFrame:
    """Rows of `_open` with ``HEADS`` others of their place, of other labels, and of the same or the next smaller class.

    Heads are the first by as many hashes of labels and names, so that places with about the same members have about the same heads.
    """
    hashes = [F.struct(F.xxhash64("label", F.lit(k)).alias("h"), F.xxhash64("name").alias("g"), *_SET) for k in range(HEADS)]
    heads = rows.groupBy("place", "class").agg(F.array_distinct(F.transform(F.array(*[F.min(x) for x in hashes]), lambda x: x.dropFields("h", "g"))).alias("heads"))
    heads = heads.withColumn("class", F.explode(F.array(F.col("class"), F.col("class") + 1))).withColumn("head", F.explode("heads"))
    met = rows.join(heads.select("place", "class", "head"), ["place", "class"]).where((F.col("head.label") != F.col("label")) & _possible("", "head."))
    pairs = _distinct(met.select(F.col("head.name").alias("a"), F.col("name").alias("b"), F.col("head.size").alias("size_a"), F.col("size").alias("size_b")))
    for end in ("a", "b"):
        pairs = pairs.join(bits.select(F.col("name").alias(end), *[F.col(w).alias(f"{end}_{w}") for w in WORDS]), end)
    return pairs.where(_near("a_", "b_", F.col("size_a") + F.col("size_b"))).select("a", "b", "size_a", "size_b")


def _all_pairs(rows: DataFrame, bits: DataFrame) -> DataFrame:
    """All pairs of rows of `_open` that meet at a place, have different labels and can still be similar.

    One of a pair does not have the label that most of the place have, so that a large group is met by few.
    """
    rows = stored(rows.join(bits, "name"))
    few = rows.where("label <> top").select("place", *[F.col(c).alias(f"one_{c}") for c in (*_SET, *WORDS)], F.explode(F.array(F.col("class") - 1, F.col("class"), F.col("class") + 1)).alias("class"))
    met = few.join(rows, ["place", "class"]).where(F.expr("one_label <> label AND (label = top OR one_name < name)") & _possible("one_", "") & _near("one_", "", F.col("one_size") + F.col("size")))
    return _distinct(met.select(F.col("name").alias("a"), F.col("one_name").alias("b"), F.col("size").alias("size_a"), F.col("one_size").alias("size_b")))


def _distinct(pairs: DataFrame) -> DataFrame:
    """Each pair once; the larger name, by its hash, is b."""
    swap = F.xxhash64("a") > F.xxhash64("b")
    either = lambda x, y: F.when(swap, F.col(y)).otherwise(F.col(x)).alias(x)
    pairs = pairs.select(either("a", "b"), either("b", "a"), either("size_a", "size_b"), either("size_b", "size_a"))
    return pairs.groupBy("a", "b").agg(F.first("size_a").alias("size_a"), F.first("size_b").alias("size_b"))


def _links(spots: DataFrame, bits: DataFrame, segments_of: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Links a, b that connect what is similar, from candidates by place: of each with few others, then of all that are still apart."""
    first = stored(_linked(_few_pairs(_open(spots, None), bits), segments_of))
    labels = stored(min_components(first).select(F.col("node").alias("name"), F.col("component").alias("label")))
    return first.union(stored(_linked(_all_pairs(_open(spots, labels), bits), segments_of)))


def similar_documents(df: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, n_shingles (size of the set) and component_id (smallest key reachable by links, itself included) of every row."""
    ship_package(df.sparkSession)
    docs = df.select(df[key].alias("key"), simhash.mark_of(df, key, text).alias("mark"), df[text].cast("string").alias("body"))
    made = stored(_signed(docs))
    counts = _order(made.where("chunk IS NOT NULL"))
    made = made.where("chunk IS NULL").select("id.*", "name", "size", *WORDS)
    some = made.where("size > 0")
    names = stored(some.groupBy("name").agg(F.min("key").alias("first"), F.count(F.lit(1)).alias("n"), F.min("mark").alias("mark"), *[F.first(c).alias(c) for c in ("size", *WORDS)]))
    n_leading = names.agg(F.sum(F.col("size") - F.ceil(F.col("size") * SHARE / 100) + 1)).first()[0] or 0
    fragments = max(FEWEST, -(-int(n_leading) // FRAGMENT))
    spots = stored(_spots(_packed(docs, counts, fragments), fragments))

    def segments_of(wanted: DataFrame) -> DataFrame:
        marks = stored(wanted.join(names, "name").select("mark").distinct())
        return _segments(docs.join(simhash.small(marks), "mark", "left_semi"))

    components = min_components(_links(spots, names.select("name", *WORDS), segments_of)).withColumnRenamed("node", "name")
    placed = stored(names.select("name", "first", "n").join(components, "name", "left").withColumn("component", F.coalesce("component", "name")))
    least = placed.groupBy("component").agg(F.min("first").alias("component_id"), F.count(F.lit(1)).alias("rows"))
    named = stored(dealt_join(placed, least.withColumnRenamed("rows", "n"), ["component"]).select("name", F.col("n"), "component_id"))
    linked = dealt_join(some, named.select("name", "n", "component_id"), ["name"])
    empty = made.where("size = 0").withColumn("component_id", F.col("key"))
    both = linked.select("key", "size", "component_id").union(empty.select("key", "size", "component_id"))
    return both.select(F.col("key").alias(key), F.col("size").alias("n_shingles"), "component_id")
