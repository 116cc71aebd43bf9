"""Near copies of documents by the Jaccard similarity of their five-word shingles, verified exactly.

Two texts link when the sets of their shingles have a similarity of ``SIMILAR`` or more; components of links are the
groups.  Candidates are, first, what the anchor-point covering of `simhash` links: SimHash fingerprints of the sets that
differ in three bits or fewer.  Pairs of a similarity of 0.8 differ in about 10 of 64 bits, too far for a covering; so
``BANDS`` keys a text, each made of ``ROWS`` minimum hashes of its shingles, reach the rest: a pair of similarity s shares
a key with a probability of 1 - (1 - s^ROWS)^BANDS, 0.999995 at 0.8.  All that are candidates, directly or by way of others, are
searched together in one task with their whole sets, so that every link among them is found and none is made that is
not exact.

A task holds ``SET_MEMORY`` shingles.  Candidates that are more than this together are not searched in one: they are dealt
anew by what makes two of them candidates, a key of their own each.  Where one key still has more, all its sets pass its
smallest one, in as many parts as they need; most of a group of near copies link to it and need no further comparison
with each other.  Those that don't are held in blocks, and each block is passed by all the others in parts.  So no
link between two sets that share a key is lost, and no task holds more than a block and the set that passes.

Rows: equal sets are collapsed before anything is compared; null and empty texts, and such without words, have the empty
set and are copies of each other; very long texts are hashed in parts; rows with a null key take part and come last in the choice
of what stays; repeated rows, and rows that share a key but not the text, are told apart by their texts; a similarity of just
0.8 links (a tie, told with integers); an empty table gives no rows; extra columns stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.llm import simhash
from strandline.llm._tables import dealt_join, give_back, ship_package, stored
from strandline.llm.components import min_components

SEED = 42
SHINGLE = 5
SIMILAR = 0.8
BANDS = 40
ROWS = 6
#: Shingles that one task holds at once (8 bytes each), but for a single set that is larger.
SET_MEMORY = 4_000_000
#: Shingles whose minima are taken at once.
HASHED = 1 << 12

_FACTORS = np.random.default_rng(SEED).integers(0, 2**64, BANDS * ROWS, np.uint64) | np.uint64(1)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles; A-Z lower-cased, words between ASCII white space."""
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(x) for x in zip(*(words[k:] for k in range(SHINGLE)))] if len(words) > SHINGLE else [b" ".join(words)] if words else []
    return np.unique(np.array([xxhash.xxh64_intdigest(s, SEED) for s in shingles], dtype=np.uint64))


def set_name(shingles: np.ndarray) -> int:
    """A hash of a whole set, as a bigint."""
    return int(np.uint64(xxhash.xxh64_intdigest(shingles.tobytes(), SEED)).view(np.int64))


def set_print(shingles: np.ndarray) -> int:
    """The SimHash fingerprint of a set, as a bigint."""
    counts = np.zeros(64, np.int64)
    for start in range(0, len(shingles), simhash.COUNTED):
        bits = np.unpackbits(shingles[start : start + simhash.COUNTED].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += np.add.reduce(bits, axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(shingles), bitorder="little").view("<i8")[0])


def band_keys(shingles: np.ndarray) -> np.ndarray:
    """``BANDS`` keys (bigint) of a set; none of the empty one."""
    if not len(shingles):
        return np.zeros(0, np.int64)
    least = np.full(BANDS * ROWS, 2**64 - 1, np.uint64)
    for start in range(0, len(shingles), HASHED):
        least = np.minimum(least, (shingles[start : start + HASHED, None] * _FACTORS).min(axis=0))
    keys = np.arange(BANDS, dtype=np.uint64)
    for row in least.reshape(ROWS, BANDS):
        keys = (keys ^ row) * _MIX
        keys ^= keys >> np.uint64(29)
    return keys.view(np.int64)


def exact_links(names: np.ndarray, sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Links (a member, the smallest name of its component) that connect what a similarity of ``SIMILAR`` connects.

    Sets are taken one after the other and compared with those not yet reached, so that a dense group costs little more
    than one pass.
    """
    values, line = np.unique(np.concatenate(sets), return_inverse=True)
    sizes = np.array([len(s) for s in sets])
    begins = np.cumsum(sizes) - sizes
    own = [line[b : b + n] for b, n in zip(begins, sizes)]
    marks = np.zeros(len(values), bool)
    left = np.arange(len(sets))
    rest, starts = line, begins  # the sets that are left, in one line
    members, roots = [], []
    while len(left) > 1:
        waiting, group = [left[0]], [left[0]]
        rest, left = rest[sizes[left[0]] :], left[1:]
        starts = np.cumsum(sizes[left]) - sizes[left]
        while waiting and len(left):
            one = waiting.pop()
            marks[own[one]] = True
            shared = np.add.reduceat(marks[rest], starts, dtype=np.int64)
            marks[own[one]] = False
            # integers, so that 0.8 itself is no matter of rounding
            close = 5 * shared >= 4 * (sizes[one] + sizes[left] - shared)
            if close.any():
                waiting += list(left[close])
                group += list(left[close])
                rest, left = rest[np.repeat(~close, sizes[left])], left[~close]
                starts = np.cumsum(sizes[left]) - sizes[left]
        if len(group) > 1:
            found = np.sort(names[group])
            members.append(found[1:])
            roots.append(np.full(len(found) - 1, found[0]))
    none = np.zeros(0, np.int64)
    return (np.concatenate(members), np.concatenate(roots)) if members else (none, none)


def _signed(df: DataFrame) -> DataFrame:
    """id, name, size (of the set), print and keys of every row with columns id and body."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, sizes, prints, keys = [], [], [], []
            for x in batch.column(1):
                shingles = shingle_set(x.as_py())
                names.append(set_name(shingles))
                sizes.append(len(shingles))
                prints.append(set_print(shingles))
                keys.append(band_keys(shingles))
            columns = [pa.array(x, pa.int64()) for x in (names, sizes, prints)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns, pa.array(keys, pa.list_(pa.int64()))], ["id", "name", "size", "print", "keys"])
        give_back()

    return df.select("id", "body").mapInArrow(run, f"id {df.schema['id'].dataType.simpleString()}, name bigint, size bigint, print bigint, keys array<bigint>")


def _sets(df: DataFrame) -> DataFrame:
    """name and shingles (8 bytes each) of every row with a column body."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(x.as_py()) for x in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array([set_name(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], ["name", "shingles"])
        give_back()

    return df.select("body").mapInArrow(run, "name bigint, shingles binary")


def _searched(dealt: DataFrame) -> DataFrame:
    """Links a, b from place, name and shingles, dealt and sorted by place and name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, held = None, {}

        def close() -> Iterator[pa.RecordBatch]:
            if len(held) > 1:
                a, b = exact_links(np.array(list(held), np.int64), [np.frombuffer(s, np.uint64) for s in held.values()])
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        for batch in batches:
            for p, name, shingles in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if p != place:
                    yield from close()
                    place, held = p, {}
                if name not in held:
                    held[name] = shingles.as_py()
        yield from close()
        held.clear()
        give_back()

    return dealt.mapInArrow(run, "a bigint, b bigint")


def _passed(dealt: DataFrame) -> DataFrame:
    """Links place, a, b from place, part, turn, name and shingles: in each part of a place the sets of turn 0 are held and linked among themselves.

    Those of turn 1 pass one at a time; one gives a link for each group of held ones that it is close to, and makes them one group.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, ready = None, {}, False
        names = roots = sizes = starts = line = values = None
        for batch in batches:
            links: list[tuple[int, int, int]] = []
            rows = zip(*(batch.column(k).to_pylist() for k in range(4)), batch.column(4))
            for place, part, turn, name, shingles in rows:
                if (place, part) != at:
                    at, held, ready = (place, part), {}, False
                one = np.frombuffer(shingles.as_py(), np.uint64)
                if turn == 0:
                    held[name] = one
                    continue
                if not held:  # a block that no set fell to
                    continue
                if not ready:
                    ready = True
                    names, sizes = np.array(list(held), np.int64), np.array([len(x) for x in held.values()])
                    starts = np.cumsum(sizes) - sizes
                    values, line = np.unique(np.concatenate(list(held.values())), return_inverse=True)
                    roots = names.copy()
                    members, tops = exact_links(names, list(held.values()))
                    order = np.argsort(names)
                    roots[order[np.searchsorted(names, members, sorter=order)]] = tops
                    links += [(place, int(a), int(b)) for a, b in zip(members, tops)]
                found = np.searchsorted(values, one)
                found = found[(found < len(values)) & (values[np.minimum(found, len(values) - 1)] == one)]
                marks = np.zeros(len(values), bool)
                marks[found] = True
                shared = np.add.reduceat(marks[line], starts, dtype=np.int64)
                near = np.unique(roots[5 * shared >= 4 * (len(one) + sizes - shared)])
                if len(near):
                    links += [(place, name, int(root)) for root in near]
                    roots[np.isin(roots, near)] = near[0]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (zip(*links) if links else ([], [], []))], ["place", "a", "b"])

    ordered = dealt.select("place", "part", "turn", "name", "shingles").repartition("place", "part").sortWithinPartitions("place", "part", "turn", "name")
    return ordered.mapInArrow(run, "place bigint, a bigint, b bigint")


def _parts(shingles: Column, memory: int) -> Column:
    return F.ceil(shingles / memory).cast("bigint")


def _part_of(name: str, parts: Column) -> Column:
    return F.pmod(F.xxhash64(name, F.lit("part")), parts)


def _each(parts: Column) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("bigint"), parts - 1))


def _crowded_links(members: DataFrame, sets: DataFrame, memory: int) -> DataFrame:
    """Links a, b among sets that are too many for one task; ``members``: name, size and keys; ``sets``: name and shingles."""
    sets = stored(sets.dropDuplicates(["name"]))
    spots = stored(members.select("name", "size", F.explode("keys").alias("place")))
    whole = F.struct("place", "total", "leader")
    places = spots.groupBy("place").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("total"), F.min("name").alias("leader"), F.bit_xor(F.xxhash64("name")).alias("same"))
    # near copies share many keys: places that have the same members are searched once
    places = places.where("n > 1").groupBy("n", "leader", "same").agg(F.min(whole).alias("whole")).select("whole.*", "n")
    spots = stored(dealt_join(spots, places, ["place"]))
    small = spots.where(F.col("total") <= memory).join(sets, "name").select("place", "name", "shingles")
    links = stored(_searched(small.repartition("place").sortWithinPartitions("place", "name")))
    over = spots.where(F.col("total") > memory)
    if over.isEmpty():
        return links
    parts = _parts(F.col("total"), memory)
    led = over.where("name = leader").select("place", _each(parts).alias("part"), F.lit(0).alias("turn"), "name")
    rest = over.where("name <> leader").select("place", _part_of("name", parts).alias("part"), F.lit(1).alias("turn"), "name")
    first = stored(_passed(led.union(rest).join(sets, "name")))
    links = links.union(first.select("a", "b"))
    apart = over.where("name <> leader").join(first.select("place", F.col("a").alias("name")), ["place", "name"], "left_anti")
    apart = stored(apart)
    if apart.isEmpty():
        return links
    blocks = apart.groupBy("place").agg(_parts(F.sum("size"), memory).alias("blocks"))
    apart = apart.join(blocks, "place").withColumn("block", F.pmod(F.xxhash64("name", F.lit("block")), F.col("blocks")))
    held = apart.select("place", "name", "block", _each(parts).alias("k"), parts.alias("parts"), F.lit(0).alias("turn"))
    own = apart.select("place", "name", "block")
    others = over.where("name <> leader").join(blocks, "place").join(own, ["place", "name"], "left")
    # a block is passed by what is linked already and by the blocks before it
    passing = others.withColumn("to", _each(F.col("blocks"))).where("block IS NULL OR block < to")
    passing = passing.select("place", "name", F.col("to").alias("block"), _part_of("name", parts).alias("k"), parts.alias("parts"), F.lit(1).alias("turn"))
    # held sets are linked when the first one passes: the smallest set passes every part
    leaders = over.where("name = leader").join(blocks, "place").select("place", "name", _each(F.col("blocks")).alias("block"), parts.alias("parts"))
    leaders = leaders.select("place", "name", "block", _each(F.col("parts")).alias("k"), "parts", F.lit(1).alias("turn"))
    turns = held.unionByName(passing).unionByName(leaders).withColumn("part", F.col("block") * F.col("parts") + F.col("k"))
    return links.union(stored(_passed(turns.join(sets, "name"))).select("a", "b"))


def _grouped(docs: DataFrame, memory: int) -> tuple[DataFrame, DataFrame]:
    """From key, mark and body: key, mark and name (of the set) of every row; name and component of names that are in groups."""
    ship_package(docs.sparkSession)
    made = stored(_signed(docs.select(F.struct("key", "mark").alias("id"), "body")))
    firsts = [F.first(c).alias(c) for c in ("size", "print", "keys")]
    # the empty set is like no other
    distinct = stored(made.where("size > 0").groupBy("name").agg(F.min("id.mark").alias("first"), *firsts))
    prints = stored(distinct.groupBy("print").agg(F.min("name").alias("b")))
    linked = simhash.fingerprint_links(prints.select(F.col("print").alias("fingerprint")))
    ends = linked.join(prints.select(F.col("print").alias("a"), F.col("b").alias("name_a")), "a").join(prints.select(F.col("print").alias("b"), F.col("b").alias("name_b")), "b")
    covered = stored(distinct.join(prints, "print").select(F.col("name").alias("a"), "b").union(ends.select("name_a", "name_b")))
    places = distinct.select("name", F.explode("keys").alias("place"))
    least = places.groupBy("place").agg(F.min("name").alias("b"), F.count(F.lit(1)).alias("n")).where("n > 1")
    banded = dealt_join(places, least, ["place"]).select(F.col("name").alias("a"), "b")
    near = min_components(covered.union(banded).where("a <> b").distinct()).withColumnRenamed("node", "name")
    near = stored(near.join(distinct.select("name", "first", "size"), "name"))
    crowds = stored(near.groupBy("component").agg(F.sum("size").alias("total")).where(F.col("total") > memory))

    def sets(wanted: DataFrame) -> DataFrame:
        texts = docs.join(simhash.small(wanted.select(F.col("first").alias("mark")).distinct()), "mark", "left_semi")
        return _sets(texts).join(wanted.select("name", F.col("component").alias("place")), "name").select("place", "name", "shingles")

    calm = near.join(crowds, "component", "left_anti")
    links = stored(_searched(sets(calm).repartition("place").sortWithinPartitions("place", "name")))
    if not crowds.isEmpty():
        crowded = near.join(crowds, "component", "left_semi")
        alike = min_components(covered).withColumnRenamed("node", "name").select("name", F.xxhash64("component", F.lit("print")).alias("alike"))
        keys = F.when(F.col("alike").isNull(), F.col("keys")).otherwise(F.array_append("keys", F.col("alike")))
        members = crowded.select("name").join(distinct.select("name", "size", "keys"), "name").join(alike, "name", "left").select("name", "size", F.array_distinct(keys).alias("keys"))
        links = links.union(_crowded_links(members, sets(crowded).drop("place"), memory))
    return made.select("id.*", "name"), min_components(links).withColumnRenamed("node", "name")


def near_copies(df: DataFrame, *, key: str = "doc_id", text: str = "text", memory: int = SET_MEMORY) -> DataFrame:
    """``key`` and component_id (the smallest key of the group; null where no row of it has a key) of every row."""
    docs = df.select(df[key].alias("key"), simhash.mark_of(df, key, text).alias("mark"), df[text].alias("body"))
    made, groups = _grouped(docs, memory)
    names = made.groupBy("name").agg(F.min("key").alias("first"), F.count(F.lit(1)).alias("n")).join(groups, "name", "left")
    names = stored(names.withColumn("component", F.coalesce("component", "name")))
    least = names.groupBy("component").agg(F.min("first").alias("component_id"), F.count(F.lit(1)).alias("rows"))
    named = stored(dealt_join(names, least.withColumnRenamed("rows", "n"), ["component"]).select("name", "n", "component_id"))
    return dealt_join(made, named, ["name"]).select(F.col("key").alias(key), "component_id")


def drop_near_copies(df: DataFrame, *, key: str = "doc_id", text: str = "text", memory: int = SET_MEMORY) -> DataFrame:
    """``df`` with one document of each group, chosen by `simhash.keep_one`."""
    docs = df.select(df[key].alias("key"), simhash.mark_of(df, key, text).alias("mark"), df[text].alias("body"))
    return simhash.keep_one(df, *_grouped(docs, memory), key=key, text=text)
