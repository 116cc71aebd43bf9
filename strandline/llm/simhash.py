"""SimHash near-duplicates by anchor-point covering.

A text's fingerprint has 64 bits: bit b is set when it is set in over half of the hashes of the text's shingles.  Two
fingerprints link when they differ in at most three bits; components of links are the groups.

Links are found without comparing all pairs.  A fingerprint is read as two halves of 32 bits; of two linked
fingerprints one half differs in at most one bit.  In the space of a half the anchors are the words of a covering code:
31 bits of a perfect Hamming code (every point has exactly one word within distance 1), and the last bit free.  The
code's covering radius is 1, so each half is sent to every anchor within 1 + 1 = 2 bits (17 of 2^27 anchors at most):
two halves that differ in one bit meet at the anchor next to either.  Only fingerprints at one anchor are compared, all
64 bits of them.

At an anchor a search takes one fingerprint after the other from those not yet reached, so that a dense group costs
little more than one pass, and gives one link per fingerprint, never all pairs.  An anchor with more than
``ANCHOR_MEMORY`` fingerprints is not searched in one task: its fingerprints go on to a second round, where they are
dealt by a quarter of the *other* half (of at most three differing bits, one quarter of four is free of them), those that
are still crowded to a third, dealt by five of their eight bytes, and what is crowded there to a last one, dealt by
a quarter of the other three bytes as well.  Then only 18 bits are left to differ in: no place can hold more than 2^18
distinct fingerprints (2 MB).

Rows: a null, empty or wordless text has fingerprint zero and links like any other; a very long text is hashed in parts;
equal texts, and repeated rows, share a fingerprint and are collapsed before anything is compared; ties (bits set in
exactly half of the hashes) are 0; an empty table gives no rows; extra columns, also of the names used here, are not
looked at, or stay (`drop_near_duplicates`).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.llm._tables import dealt_join, free_name, ship_package, stored
from strandline.llm.components import min_components

SEED = 42
SHINGLE = 3
DIFFERENT_BITS = 3
#: Fingerprints at one anchor that one task searches at once (8 bytes each).
ANCHOR_MEMORY = 50_000
#: Hashes that are counted at once.
COUNTED = 1 << 15


def fingerprint(text: str | None) -> int:
    """The fingerprint of a whole text; A-Z lower-cased, words between ASCII white space."""
    words = (text or "").encode().lower().split()
    if len(words) > SHINGLE:
        shingles = [b" ".join(x) for x in zip(*(words[k:] for k in range(SHINGLE)))]
    else:
        shingles = [b" ".join(words)] if words else []
    if not shingles:
        return 0
    hashed = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for start in range(0, len(shingles), COUNTED):
        hashes = np.array([hashed(s, SEED) for s in shingles[start : start + COUNTED]], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += np.add.reduce(bits, axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(shingles), bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``fingerprint`` (bigint holding the 64 bits) of every row.  No shuffle."""
    ship_package(df.sparkSession)
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(x.as_py()) for x in batch.column(1)], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], ["key", "fingerprint"])
        pa.default_memory_pool().release_unused()  # the worker lives on

    return df.select(df[key].alias("key"), df[text].alias("text")).mapInArrow(run, f"key {kind}, fingerprint bigint").withColumnRenamed("key", key)


def _anchor_masks() -> list[list[int]]:
    """For each syndrome of the Hamming code: what to XOR to a half to get the anchors within two bits of it.

    Bit position p (0 to 30) has the column p + 1; bit 31 is free.
    """
    masks = []
    for syndrome in range(32):
        within = []  # changes of one or two bits (or none) that lead to a code word of the 31 bits
        if syndrome == 0:
            within.append(0)
        else:
            within.append(1 << (syndrome - 1))
            within += [(1 << (a - 1)) | (1 << (b - 1)) for a in range(1, 32) if (b := a ^ syndrome) > a]
        masks.append(within + [m | (1 << 31) for m in within if m.bit_count() <= 1])
    return masks


_MASKS = _anchor_masks()
_COLUMNS = [sum(1 << p for p in range(31) if (p + 1) >> k & 1) for k in range(5)]


def anchors(half: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions in ``half`` (uint64 below 2^32) and the anchors within two bits of those halves."""
    syndrome = np.zeros(len(half), np.int64)
    for k, column in enumerate(_COLUMNS):
        syndrome |= (np.bitwise_count(half & np.uint64(column)).astype(np.int64) & 1) << k
    at, to = [], []
    for s in range(32):
        rows = np.flatnonzero(syndrome == s)
        if len(rows):
            masks = np.array(_MASKS[s], np.uint64)
            at.append(np.repeat(rows, len(masks)))
            to.append((half[rows, None] ^ masks[None, :]).ravel())
    return (np.concatenate(at), np.concatenate(to)) if at else (np.zeros(0, np.int64), np.zeros(0, np.uint64))


def spanning_links(prints: np.ndarray, most: int = DIFFERENT_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Links (a member, the smallest of its component) that connect what ``most`` differing bits connect in ``prints``."""
    left = np.unique(prints)
    members, roots = [], []
    while len(left) > 1:
        waiting, found = [left[0]], [left[:1]]
        left = left[1:]
        while waiting and len(left):
            close = np.bitwise_count(left ^ waiting.pop()) <= most
            if close.any():
                reached = left[close]
                left = left[~close]
                waiting += list(reached)
                found.append(reached)
        group = np.concatenate(found)
        if len(group) > 1:
            root = group.min()
            group = group[group != root]
            members.append(group)
            roots.append(np.full(len(group), root, group.dtype))
    none = np.zeros(0, prints.dtype)
    return (np.concatenate(members), np.concatenate(roots)) if members else (none, none)


def _search(batches: Iterator[pa.RecordBatch], memory: float) -> Iterator[pa.RecordBatch]:
    """From rows sorted by ``place`` and print: links (a, b, null place), and whole places over ``memory`` as (print, null, place)."""
    held: list[np.ndarray] = []
    place, size, over = None, 0, False
    links: list[tuple] = []
    passed: list[tuple] = []

    def close() -> None:
        nonlocal held, size, over
        if held and not over and size > 1:
            a, b = spanning_links(np.concatenate(held).view(np.uint64))
            if len(a):
                links.append((a.view(np.int64), b.view(np.int64)))
        held, size, over = [], 0, False

    def ready() -> Iterator[pa.RecordBatch]:
        if links:
            a, b = (np.concatenate(x) for x in zip(*links))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.nulls(len(a), pa.int64())], ["a", "b", "place"])
        for p, prints in passed:
            yield pa.RecordBatch.from_arrays([pa.array(prints), pa.nulls(len(prints), pa.int64()), pa.array(np.full(len(prints), p))], ["a", "b", "place"])
        links.clear()
        passed.clear()

    for batch in batches:
        if not batch.num_rows:
            continue
        places, prints = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        starts = np.flatnonzero(np.concatenate([[True], places[1:] != places[:-1]]))
        ends = np.append(starts[1:], len(places))
        # places of one row inside the batch have nothing to compare
        inner = (ends - starts > 1) | (starts == 0) | (ends == len(places))
        for start, end in zip(starts[inner], ends[inner]):
            if place is None or places[start] != place:
                close()
                place = places[start]
            held.append(prints[start:end])
            size += end - start
            if over or size > memory:
                over = True
                passed += [(place, x) for x in held]
                held = []
        yield from ready()
    close()
    yield from ready()


def _searched(places: DataFrame, memory: float) -> DataFrame:
    """``places``: place (what must be equal) and print."""
    dealt = places.repartition("place").sortWithinPartitions("place")
    return dealt.mapInArrow(lambda batches: _search(batches, memory), "a bigint, b bigint, place bigint")


def _anchored(prints: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy().view(np.uint64)
            for which in (0, 1):
                half = (values >> np.uint64(32 * which)) & np.uint64(0xFFFFFFFF)
                at, anchor = anchors(half)
                place = (anchor << np.uint64(1)) | np.uint64(which)
                yield pa.RecordBatch.from_arrays([pa.array(place.view(np.int64)), pa.array(values[at].view(np.int64))], ["place", "print"])

    return prints.select("fingerprint").mapInArrow(run, "place bigint, print bigint")


def _quarters(crowded: DataFrame) -> DataFrame:
    """Deal crowded anchors on by each quarter of the half that the anchor doesn't tell."""
    other = F.when(F.col("place").bitwiseAND(F.lit(1)) == 0, F.shiftrightunsigned("a", 32)).otherwise(F.col("a"))
    keys = [F.xxhash64("place", F.lit(k), other.bitwiseAND(F.lit(0xFF << (8 * k)))) for k in range(4)]
    # a hash as the place: should two places ever share one, more is compared and nothing is lost
    return crowded.select(F.explode(F.array(*keys)).alias("place"), F.col("a").alias("print"))


#: Every choice of five of eight bytes: three differing bits leave five bytes alone.
_FIVE = list(combinations(range(8), 5))


def _mask(bits: list[int]) -> int:
    return int(np.uint64(sum(1 << b for b in bits)).view(np.int64))


def _five_bytes(crowded: DataFrame) -> DataFrame:
    """Deal fingerprints by every choice of five of their eight bytes; the choice's number is in the place's last six bits."""
    keys = []
    for n, chosen in enumerate(_FIVE):
        kept = F.col("a").bitwiseAND(F.lit(_mask([8 * k + j for k in chosen for j in range(8)])).cast("bigint"))
        keys.append(F.xxhash64(F.lit(n), kept).bitwiseAND(F.lit(-64).cast("bigint")).bitwiseOR(F.lit(n).cast("bigint")))
    return crowded.select("a").distinct().select(F.explode(F.array(*keys)).alias("place"), F.col("a").alias("print"))


def _six_bits(crowded: DataFrame) -> DataFrame:
    """Deal places of `_five_bytes` on by each quarter of the 24 bits that they don't tell."""
    masks = []
    for chosen in _FIVE:
        rest = [8 * k + j for k in range(8) if k not in chosen for j in range(8)]
        masks.append(F.array(*[F.lit(_mask(rest[6 * q : 6 * q + 6])).cast("bigint") for q in range(4)]))
    own = F.get(F.array(*masks), F.col("place").bitwiseAND(F.lit(63).cast("bigint")).cast("int"))
    keys = F.transform(own, lambda mask, q: F.xxhash64("place", q, F.col("a").bitwiseAND(mask)))
    return crowded.select("place", "a").select(F.explode(keys).alias("place"), F.col("a").alias("print"))


def fingerprint_links(prints: DataFrame, *, memory: float = ANCHOR_MEMORY) -> DataFrame:
    """Links a, b (a member and a smaller fingerprint of its component) between distinct fingerprints; no pair is lost.

    ``prints``: one row for each distinct ``fingerprint``.
    """
    ship_package(prints.sparkSession)
    first = stored(_searched(_anchored(prints), memory))
    links = first.where("place IS NULL")
    crowded = first.where("place IS NOT NULL")
    if crowded.isEmpty():
        return links.select("a", "b").distinct()
    second = stored(_searched(_quarters(crowded), memory))
    links = links.unionByName(second.where("place IS NULL"))
    again = second.where("place IS NOT NULL")
    if not again.isEmpty():
        third = stored(_searched(_five_bytes(again), memory))
        links = links.unionByName(third.where("place IS NULL"))
        last = third.where("place IS NOT NULL")
        if not last.isEmpty():
            links = links.unionByName(stored(_searched(_six_bits(last), math.inf)))  # bounded by the bits that are left
    return links.select("a", "b").distinct()


def near_duplicates(df: DataFrame, *, key: str = "doc_id", text: str = "text", memory: float = ANCHOR_MEMORY) -> DataFrame:
    """``key``, fingerprint (16 hex digits) and component_id (smallest key reachable by links) of every row of ``df``.

    Fingerprints are made once and written; equal ones are collapsed before the shuffle, so that copies cost nothing
    more.  Rows with a null key take part but give their group no name; a group of such rows has a null component_id.
    """
    made = stored(fingerprints(df, key=key, text=text))
    prints = stored(made.groupBy("fingerprint").agg(F.min(key).alias("first"), F.count(F.lit(1)).alias("n")))
    links = fingerprint_links(prints, memory=memory)
    members = min_components(links).join(prints, F.col("node") == F.col("fingerprint")).select("fingerprint", "component", "first")
    names = members.groupBy("component").agg(F.min("first").alias("least"), F.count(F.lit(1)).alias("n"))
    renamed = dealt_join(members, names, ["component"]).select("fingerprint", "least")
    named = stored(prints.join(renamed, "fingerprint", "left").select("fingerprint", "n", F.coalesce("least", "first").alias("component_id")))
    return dealt_join(made, named, ["fingerprint"]).select(key, F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


#: Ids of dropped documents up to which they are broadcast (8 bytes each) so that texts need no shuffle.
BROADCAST_IDS = 1_000_000


def small(ids: DataFrame) -> DataFrame:
    """``ids`` marked for a broadcast if they are few."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def keep_one(df: DataFrame, rows: DataFrame, groups: DataFrame, *, key: str, text: str) -> DataFrame:
    """``df`` with one row of each group: the one with the smallest key (null comes last) and, of such, the smallest mark.

    ``rows``: key, mark (`mark_of`) and name of every row of ``df``; ``groups``: name and component of names that are in
    groups with others.  Rows are judged, not keys: rows that share a key but not the text are told apart, and of rows
    with equal key and text one stays.  What stays does not depend on the order of rows.  Texts are shuffled only where
    very many rows go.
    """
    place = F.struct(F.col("key").isNull().alias("last"), "key", "mark")
    least = rows.groupBy("name").agg(F.min(place).alias("place"))
    least = least.join(groups, "name", "left").groupBy(F.coalesce("component", "name").alias("component")).agg(F.min("place").alias("place"))
    stays = least.select(F.col("place.key").alias("key"), F.col("place.mark").alias("mark"), F.lit(True).alias("stays"))
    each = rows.groupBy("key", "mark").agg(F.count(F.lit(1)).alias("n"))  # rows of one key and text have one name
    verdicts = each.join(stays.withColumnsRenamed({"key": "key_", "mark": "mark_"}), F.col("key").eqNullSafe(F.col("key_")) & (F.col("mark") == F.col("mark_")), "left")
    verdicts = stored(verdicts.where("stays IS NULL OR n > 1").select("key", "mark", F.coalesce("stays", F.lit(False)).alias("stays")))
    names = [free_name(df, "judged_key"), free_name(df, "judged_mark")]

    def joined(ids: DataFrame, how: str) -> DataFrame:
        ids = small(ids.select(F.col("key").alias(names[0]), F.col("mark").alias(names[1])))
        return df.join(ids, df[key].eqNullSafe(F.col(names[0])) & (mark_of(df, key, text) == F.col(names[1])), how)

    out, repeated = joined(verdicts, "left_anti"), verdicts.where("stays")
    if repeated.isEmpty():
        return out
    whole = joined(repeated, "left_semi").select(F.struct(*[df[c] for c in df.columns]).alias("whole"), df[key].alias("key"), mark_of(df, key, text).alias("mark"))
    once = whole.groupBy("key", "mark").agg(F.min_by("whole", F.xxhash64(F.to_json("whole"))).alias("whole"))
    return out.unionByName(once.select("whole.*"))


def mark_of(df: DataFrame, key: str, text: str) -> Column:
    """A hash of a row's key and text; with the key itself it names the row."""
    return F.xxhash64(df[key], df[text])


def drop_near_duplicates(df: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``df`` with one document of each group of linked fingerprints, chosen by `keep_one`."""
    marked = df.select(df[key].alias("key"), mark_of(df, key, text).alias("mark"), df[text].alias("body"))
    rows = stored(fingerprints(marked.select(F.struct("key", "mark").alias("id"), "body"), key="id", text="body"))
    rows = rows.select("id.*", F.col("fingerprint").alias("name"))
    links = fingerprint_links(rows.select(F.col("name").alias("fingerprint")).distinct())
    return keep_one(df, rows, min_components(links).withColumnRenamed("node", "name"), key=key, text=text)
