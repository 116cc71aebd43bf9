"""A Merkle manifest of a table: leaf digests of rows, a tree for each source, one root, and a proof for every row.

A leaf is the SHA-256 (lower-case hex) of its row's cells, each ``-`` if null, else its UTF-8 byte count, ``:`` and its
value.  In each tree the leaves stand in their order; while there are several nodes, every ``FAN`` consecutive ones become
the digest of their digests (hex text, concatenated).  The subroots of all trees, by name (null first, bytewise), are the
leaves of one more tree, whose top is the root.

A row's rank in its tree is written in digits of base ``FAN``.  The lowest ``DIGITS`` digits place it inside a block, the
others name the block.  A block is one row in the end: its digit columns are grouped away one after the other, each time
nesting what was grouped as an array of structs in the struct above.  All that needs one exchange, by tree and block, and
no task ever holds more than whole blocks of FAN^DIGITS leaves, whatever the size of a tree.  Block tops are the leaves of
the next round.  On the way down, a block gets the path from its top to the root as one more row of the same grouping,
and a transform and an explode for each digit hand it on to the nodes below, adding their siblings: no join is made.

Ranks come from a sort by range, written once; a partition holds consecutive rows, so a rank is a row's place in its
partition and the number of rows that its tree has in the partitions before, of which there is one sum a tree and partition.

Rows: null cells are ``-``; a null source is a tree of its own; null keys come first in their tree; rows with equal keys
stand by their leaf digests, and repeated rows are leaves of their own, in any order with the same result; empty and very
long texts are cells like any other; an empty table gives no rows; extra columns, of whatever name, are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from strandline.llm._tables import stored

FAN = 16
#: Digits (levels of a tree) inside a block: it holds FAN^DIGITS = 4,096 leaves at most.
DIGITS = 3
STEP = "struct<left:string,right:string>"
ABOVE = f"struct<path:array<{STEP}>,subroot:string,root:string>"


def leaf_digest(*cells: Column) -> Column:
    """The digest of a row's cells; integers are decimal."""
    shown = [c.cast("string") for c in cells]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-")) for s in shown]), 256)


def proof_digest(path: Column) -> Column:
    """The digest of all siblings on a path, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def folded_root(path: Column, digest: Column) -> Column:
    """The root that a path gives for a leaf's digest."""
    return F.aggregate(path, digest, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))


def ranked(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` (a column tree, and those of ``order``) with rank (from 0 in the tree) and size (rows of the tree)."""
    # rows that are equal in all of the order are dealt as well
    dealt = rows.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange("tree", *order, "tie").sortWithinPartitions("tree", *order)
    placed = stored(dealt.drop("tie").withColumn("place", F.monotonically_increasing_id()))  # consecutive in each partition
    placed = placed.withColumn("part", F.shiftright("place", 33))
    pieces = placed.groupBy("tree", "part").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
    tree = Window.partitionBy("tree")
    before = F.sum("n").over(tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    pieces = pieces.select("tree", "part", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"), F.sum("n").over(tree).alias("size"))
    return placed.join(pieces, ["tree", "part"]).withColumn("rank", F.col("place") + F.col("shift")).drop("place", "part", "shift")


def _nodes(size: Column, level: int) -> Column:
    """Nodes of a tree at a level (0: leaves) when it has ``size`` leaves."""
    return F.ceil(size / F.lit(float(FAN**level))).cast("bigint")


def _blocks(rows: DataFrame, above: DataFrame | None = None) -> DataFrame:
    """A row for each block of ``rows`` (tree, rank, size, digest, item): tree, block, size, digest, children, above.

    ``children`` are nested ``DIGITS`` deep; ``above`` (tree, block, above) gives blocks what lies above their tops.
    """
    digit = lambda level: F.shiftright("rank", 4 * level).bitwiseAND(F.lit(FAN - 1)).cast("int")
    digits = [f"d{k}" for k in range(DIGITS)]
    nested = rows.select("tree", F.shiftright("rank", 4 * DIGITS).alias("block"), "size", "digest", F.col("item").alias("children"), *[digit(k).alias(d) for k, d in enumerate(digits)], F.lit(None).cast(ABOVE).alias("above"))
    if above is not None:
        nested = nested.unionByName(above, allowMissingColumns=True)
    nested = nested.repartition("tree", "block")
    for level, d in enumerate(digits):
        child = F.when(F.col(d).isNotNull(), F.struct(F.col(d).alias("digit"), "digest", "children"))
        several = _nodes(F.col("size"), level) > 1
        nested = nested.groupBy("tree", "block", *digits[level + 1 :]).agg(F.max("size").alias("size"), F.array_sort(F.collect_list(child)).alias("children"), F.first("above", ignorenulls=True).alias("above"))
        joined = F.sha2(F.array_join(F.transform("children", lambda c: c["digest"]), ""), 256)
        nested = nested.withColumn("digest", F.when(several, joined).otherwise(F.get("children", 0)["digest"]))
    return nested


def _tops(blocks: DataFrame) -> DataFrame:
    """The tops of blocks as rows of the next round."""
    size = _nodes(F.col("size"), DIGITS)
    return blocks.select("tree", F.col("block").alias("rank"), size.alias("size"), "digest", F.lit(None).cast("string").alias("item"))


def _with_siblings(several: Column):
    """What a node's child (and its place) becomes: the child and its path, one step longer if its level has ``several`` nodes."""

    def beside(start: Column, n: Column) -> Column:
        return F.array_join(F.transform(F.slice("children", start, n), lambda c: c["digest"]), "")

    def step(child: Column, k: Column) -> Column:
        own = F.array(F.struct(beside(F.lit(1), k).alias("left"), beside(k + 2, F.lit(FAN)).alias("right")))
        path = F.when(several, F.concat(own, F.col("above.path"))).otherwise(F.col("above.path"))
        return F.struct(child.alias("child"), path.alias("path"))

    return step


def _emitted(blocks: DataFrame, top: str) -> DataFrame:
    """A row for each leaf of ``blocks``: tree, rank, digest, item, above (with its siblings).

    ``top``: what a tree's top is (``root`` or ``subroot``) where nothing lies above it yet.
    """
    none = {"path": F.array().cast(f"array<{STEP}>"), "subroot": F.lit(None).cast("string"), "root": F.lit(None).cast("string")}
    begun = F.struct(*[(F.col("digest") if name == top else c).alias(name) for name, c in none.items()])
    rows = blocks.select("tree", "size", F.col("block").alias("rank"), "digest", "children", F.coalesce("above", begun).alias("above"))
    for level in range(DIGITS - 1, -1, -1):
        with_siblings = _with_siblings(_nodes(F.col("size"), level) > 1)
        each = rows.select("tree", "size", "rank", F.col("above.subroot").alias("subroot"), F.col("above.root").alias("root"), F.explode(F.transform("children", with_siblings)).alias("x"))
        above = F.struct(F.col("x.path").alias("path"), "subroot", "root")
        rows = each.select("tree", "size", (F.col("rank") * FAN + F.col("x.child.digit")).alias("rank"), F.col("x.child.digest").alias("digest"), F.col("x.child.children").alias("children"), above.alias("above"))
    return rows.withColumnRenamed("children", "item")


def _rounds(size: int) -> int:
    """Rounds of blocks until one node is left of ``size`` leaves."""
    rounds = 1
    while (size := -(-size // FAN**DIGITS)) > 1:
        rounds += 1
    return rounds


def _grown(leaves: DataFrame) -> list[DataFrame]:
    """Rows of each round, from leaves (tree, rank, size, digest, item) up to one top a tree."""
    most = leaves.agg(F.max("size")).first()[0] or 0
    rounds = [leaves]
    for _ in range(_rounds(most)):
        bare = rounds[-1].withColumn("item", F.lit(None).cast("string"))  # what leaves carry stays below
        rounds.append(stored(_tops(_blocks(bare))))
    return rounds


def _proven(rounds: list[DataFrame], above: DataFrame | None, top: str) -> DataFrame:
    """The leaves with what lies above them; ``above``: tree and above of each tree's top."""
    if above is not None:
        above = above.withColumn("block", F.lit(0).cast("bigint"))
    for rows in rounds[-2::-1]:
        leaves = _emitted(_blocks(rows, above), top)
        above = leaves.select("tree", F.col("rank").alias("block"), "above")
    return leaves


def manifest(df: DataFrame, *, cells: list[str], key: str = "doc_id", source: str = "source", claims: Column | None = None) -> DataFrame:
    """A row for each row of ``df``: ``key``, ``source``, claim, leaf, subroot, root and proof (array of left, right siblings).

    ``cells``: columns of the leaf, in this order.  ``claims``: a digest to carry along (that of another copy of the row, say).
    """
    tree = F.coalesce(F.concat(F.lit("="), df[source].cast("string")), F.lit(""))  # null is the smallest name
    claim = F.lit(None).cast("string") if claims is None else claims
    made = stored(df.select(tree.alias("tree"), df[key].alias("key"), leaf_digest(*[df[c] for c in cells]).alias("digest"), claim.alias("claim")))
    leaves = ranked(made, "key", "digest").withColumn("item", F.struct("key", "claim")).select("tree", "rank", "size", "digest", "item")
    rounds = _grown(leaves)
    subroots = rounds[-1].select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest")
    trees = ranked(subroots, "name").withColumn("item", F.col("name")).select("tree", "rank", "size", "digest", "item")
    tops = _proven(_grown(trees), None, "root")
    below = F.struct(F.col("above.path").alias("path"), F.col("digest").alias("subroot"), F.col("above.root").alias("root"))
    proven = _proven(rounds, tops.select(F.col("item").alias("tree"), below.alias("above")), "subroot")
    name = F.when(F.col("tree") != "", F.substring("tree", 2, 1 << 30))
    return proven.select(F.col("item.key").alias(key), name.alias(source), F.col("item.claim").alias("claim"), F.col("digest").alias("leaf"), "above.subroot", "above.root", F.col("above.path").alias("proof"))


def verified_manifest(df: DataFrame, *, cells: list[str], copies: dict[str, Column], altered: Column, key: str = "doc_id", source: str = "source") -> DataFrame:
    """Proofs checked against another copy of the rows: ``key``, leaf, subroot, root, proof_sha256, folded_root, verified.

    ``copies``: cells that the other copy has differently; ``altered``: which rows are looked at in that copy.
    """
    other = F.when(altered, leaf_digest(*[copies.get(c, df[c]) for c in cells]))
    found = manifest(df, cells=cells, key=key, source=source, claims=other)
    found = found.withColumn("folded_root", folded_root(F.col("proof"), F.coalesce("claim", "leaf")))
    return found.select(key, "leaf", "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
