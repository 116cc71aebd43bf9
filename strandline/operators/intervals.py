"""Joins of positions and spans with intervals, by bins in levels.

The genome is cut in bins of ``2^bits`` bases.  Intervals of tracks are cut to the longest whole bins that fit and what is left at both
ends, so that all intervals of a bin and place are one crowd, of which only as many are kept as a track reports.  A span is stored at
the level whose bins are the first as long as itself, so that it touches one or two of them.  Two spans meet at the level of the
longer one, in the first bin that both touch, so a pair is made once; which side is the longer one is part of the key, so that
two short spans of a long bin are not compared.

Many tracks are one join: their intervals are one tagged union, kept in one row for each bin.  The number of exchanges does not
depend on the number of tracks.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Bits of a bin's width at each level: 1,024 bases to 2 billion.
LEVELS = (10, 13, 16, 19, 22, 25, 28, 31)


@dataclass(frozen=True)
class Track:
    """Intervals (chrom, start0, end0, name and others) and what a hit reports.

    ``level``: 0 that there is one (``1``), 1 ``column=value`` of ``columns``, 2 the name and these, 3 the place and all of that, joined
    by ``;``.  ``most``: only the first so many hits.
    """

    rows: DataFrame
    columns: tuple[str, ...] = field(default=())
    level: int = 2
    most: int | None = None

    def cell(self) -> Column:
        """What one interval reports."""
        if self.level == 0:
            return F.lit("1")
        parts = [F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit("."))) for c in self.columns]
        if self.level >= 2 or not parts:
            parts = [F.col("name"), *parts]
        if self.level >= 3:
            parts = [F.concat(F.col("start0") + 1, F.lit("-"), F.col("end0")), *parts]
        return F.concat_ws(";", *parts) if len(parts) > 1 else parts[0]


def level_of(length: Column) -> Column:
    """Bits of the first level whose bins are at least ``length`` long."""
    found = F.lit(LEVELS[-1])
    for bits in LEVELS[-2::-1]:
        found = F.when(length <= 1 << bits, F.lit(bits)).otherwise(found)
    return found


def _bin(position: Column, bits: Column) -> Column:
    """Number of the bin that holds a position (from 1)."""
    return F.floor(position / F.pow(F.lit(2.0), bits.cast("double"))).cast("bigint")


def _stored(intervals: DataFrame) -> DataFrame:
    """``intervals`` (chrom, start0, end0, others) in the bins (bits, bin) of their level: each in one or two."""
    sized = intervals.where("end0 > start0").withColumn("bits", level_of(F.col("end0") - F.col("start0")))
    ends = F.array_distinct(F.array(_bin(F.col("start0") + 1, F.col("bits")), _bin(F.col("end0"), F.col("bits"))))
    return sized.withColumn("bin", F.explode(ends))


#: Levels that intervals are cut to: each bin is whole bins of the level before, to 2^58 bases; a bin of ``HOME`` bits keeps all that its positions need.
CUTS = (10, 13, 16, 19, 22, 25, 28, 31, 40, 49, 58)
HOME = 16
WHOLE = (-(1 << 62), 1 << 62)


def _pieces(intervals: DataFrame) -> DataFrame:
    """``intervals`` (chrom, start0, end0, others) cut to whole bins (bits, bin), the longest that fit, and one end or two inside a bin of the first level.

    A position is in an interval just if one of its bins holds a piece with ``low < pos <= high``: whole bins have no limits.  A piece
    is at most some bins a level and side, however long the interval is.
    """
    first = CUTS[0]
    start, end = F.col("start0").cast("bigint") + 1, F.col("end0").cast("bigint")
    sized = intervals.where("end0 > start0").withColumns({"_a": F.shiftright(start, first), "_z": F.shiftright(end, first)})
    piece = lambda bits, a, z, low, high: F.struct(F.lit(bits).alias("bits"), a.alias("a"), z.alias("z"), low.alias("low"), high.alias("high"))
    a, z = F.col("_a"), F.col("_z")
    found = [piece(first, a, a, start - 1, end), F.when(z > a, piece(first, z, z, start - 1, end))]
    whole = [F.lit(n).cast("bigint") for n in WHOLE]
    for k, bits in enumerate(CUTS):
        up = bits - first
        # whole bins between the ends: from a + 1 to z - 1 at the first level
        low, high = F.shiftright(a + (1 << up), up), F.shiftright(z, up) - 1
        if k + 1 < len(CUTS):
            over = CUTS[k + 1] - first
            above, below = F.shiftright(a + (1 << over), over), F.shiftright(z, over) - 1
            times = 1 << (over - up)
            inside = above <= below
            parts = [(low, F.when(inside, above * times - 1).otherwise(high)), (F.when(inside, (below + 1) * times), high)]
        else:
            parts = [(low, high)]
        found += [F.when(x <= y, piece(bits, x, y, *whole)) for x, y in parts]
    each = sized.withColumn("_p", F.explode(F.array(*found))).where("_p IS NOT NULL")
    rest = [c for c in intervals.columns if c not in ("start0", "end0")]
    return each.select(*rest, "_p.bits", "_p.low", "_p.high", F.explode(F.sequence("_p.a", "_p.z")).alias("bin"))


def _fewest(cells: Column, limits: list[int | None]) -> Column:
    """Of pieces that are whole bins the first so many cells of each track."""

    def of(track: int, limit: int | None) -> Column:
        return F.transform(_cells(cells, track, limit), lambda cell: F.struct(F.lit(track).alias("track"), cell.alias("cell"), F.lit(WHOLE[0]).alias("low"), F.lit(WHOLE[1]).alias("high")))

    return F.concat(*[of(track, limit) for track, limit in enumerate(limits)])


def _cells(cells: Column, track: int, limit: int | None) -> Column:
    own = F.sort_array(F.transform(F.filter(cells, lambda x: x["track"] == track), lambda x: x["cell"]))
    return own if limit is None else F.slice(own, 1, limit)


def _first_of_crowds(pieces: DataFrame, limits: list[int | None]) -> DataFrame:
    """Pieces without those that as many others of the same place and track stand before, as the track reports."""
    if all(limit is None for limit in limits):
        return pieces
    bounded = F.col("track").isin([t for t, limit in enumerate(limits) if limit is not None])
    place = Window.partitionBy("chrom", "bits", "bin", "low", "high", "track").orderBy("cell")
    most = max(limit for limit in limits if limit is not None)
    few = pieces.where(bounded).withColumn("_nth", F.row_number().over(place)).where(F.col("_nth") <= most).drop("_nth")
    return few if all(limit is not None for limit in limits) else few.unionByName(pieces.where(~bounded))


def annotate_tracks(df: DataFrame, tracks: dict[str, Track]) -> DataFrame:
    """``df`` with a column for each track: what its intervals that hold the position report, sorted, joined by ``&``; ``.`` if none.

    Intervals are half-open from zero (start0 < pos <= end0), as in BED files.  Rows of ``df`` are dealt once, by their bin of ``HOME`` bits,
    to one row that keeps the bin's intervals: those that hold all of it (as many as the tracks report), and the pieces of others by
    smaller bin.  So hits that no track reports are never made.
    """
    if not tracks:
        return df
    limits = [1 if track.level == 0 else track.most for track in tracks.values()]
    union = None
    for number, track in enumerate(tracks.values()):
        rows = track.rows.select("chrom", "start0", "end0", F.lit(number).alias("track"), track.cell().alias("cell"))
        union = rows if union is None else union.union(rows)
    pieces = _first_of_crowds(_pieces(union.where("cell IS NOT NULL")), [limit if limit is None else max(limit, 1) for limit in limits])
    home = lambda pos: F.shiftright(pos.cast("bigint"), HOME)
    key = lambda bin_, bits: bin_ * 64 + bits
    small = [bits for bits in CUTS if bits < HOME]
    near = pieces.where(F.col("bits") < HOME).select(
        "chrom", F.expr(f"CASE bits {' '.join(f'WHEN {b} THEN shiftright(bin, {HOME - b})' for b in small)} END").alias("home"), key(F.col("bin"), F.col("bits")).alias("key"), F.struct("track", "cell", "low", "high").alias("piece")
    )
    large = [bits for bits in CUTS if bits >= HOME]
    homes = df.select("chrom", home(F.col("pos")).alias("home")).distinct()
    looked = homes.select("*", F.explode(F.array(*[F.struct(F.lit(b).alias("bits"), F.shiftright("home", b - HOME).alias("bin")) for b in large])).alias("x")).select("chrom", "home", "x.*")
    far = looked.join(pieces.where(F.col("bits") >= HOME), ["chrom", "bits", "bin"]).select("chrom", "home", key(F.col("home"), F.lit(HOME)).alias("key"), F.struct("track", "cell", "low", "high").alias("piece"))
    # the map's groups are where the groups by key are: one exchange for both
    held = near.union(far).repartition("chrom", "home").groupBy("chrom", "home", "key").agg(F.collect_list("piece").alias("held"))
    held = held.withColumn("held", F.when(F.col("key") == key(F.col("home"), F.lit(HOME)), _fewest(F.col("held"), limits)).otherwise(F.col("held")))
    rows = held.groupBy("chrom", "home").agg(F.map_from_entries(F.collect_list(F.struct("key", "held"))).alias("_held"))
    pos = F.col("pos").cast("bigint")
    joined = df.drop(*tracks).withColumn("home", home(F.col("pos"))).join(rows, ["chrom", "home"], "left")
    none = F.array().cast(held.schema["held"].dataType)
    found = F.concat(*[F.coalesce(F.try_element_at("_held", key(F.shiftright(pos, b), F.lit(b))), none) for b in (*small, HOME)])
    joined = joined.withColumn("_cells", F.filter(found, lambda x: (pos > x["low"]) & (pos <= x["high"]))).drop("_held", "home")
    shown = lambda t, limit: F.when(F.exists("_cells", lambda x: x["track"] == t), F.array_join(_cells(F.col("_cells"), t, limit), "&")).otherwise(".")
    return joined.withColumns({name: shown(t, limits[t]) for t, name in enumerate(tracks)}).drop("_cells")


def _met(spans: DataFrame, other: DataFrame, *, longer: int) -> DataFrame:
    """``spans`` (first, last, others) in the bins where they can meet ``other``: own (bits of their level), bits, longer, bin, and low (their first bin).

    Two spans meet at the level of the longer one: where ``longer`` is this side they are in the bins of their level, where it is the
    other in those of the levels from there on that the other side has spans of.  A level that no span has costs nothing.
    """
    levels = F.broadcast(other.agg(F.collect_set(level_of(F.col("last") - F.col("first") + 1)).alias("_levels")))  # one row
    sized = spans.withColumn("own", level_of(F.col("last") - F.col("first") + 1)).crossJoin(levels)
    there = lambda b: F.array_contains("_levels", b)
    own, at = F.col("own"), lambda b, side: F.struct(F.lit(b).alias("bits"), F.lit(side).alias("longer"))
    # equal levels: the first side counts as the longer one
    shorter = [F.when(there(b) & ((own < b) if longer == 0 else (own <= b)), at(b, 1 - longer)) for b in LEVELS]
    reached = F.array_min("_levels")
    longest = [F.when((own == b) & ((reached <= b) if longer == 0 else (reached < b)), at(b, longer)) for b in LEVELS]
    each = sized.withColumn("_x", F.explode(F.array(*shorter, *longest))).where("_x IS NOT NULL").select(*spans.columns, "_x.*")
    each = each.withColumn("low", _bin(F.col("first"), F.col("bits")))
    return each.withColumn("bin", F.explode(F.array_distinct(F.array("low", _bin(F.col("last"), F.col("bits"))))))


def overlapping_spans(a: DataFrame, b: DataFrame, *, on: list[str]) -> DataFrame:
    """Pairs of spans of ``a`` and ``b`` (columns of ``on``, first, last) that share a base, once each: ``on``, first, last, first_b, last_b.

    Spans are inclusive at both ends; equal spans of one side are one.
    """
    a, b = (side.select(*on, "first", "last").distinct() for side in (a, b))
    left = _met(a, b, longer=0)
    right = _met(b, a, longer=1).withColumnsRenamed({c: f"{c}_b" for c in ("first", "last", "low")})
    met = left.join(right, [*on, "bits", "longer", "bin"]).where("bin = greatest(low, low_b) AND first <= last_b AND first_b <= last")
    return met.select(*on, "first", "last", "first_b", "last_b")


def with_span(variants: DataFrame) -> DataFrame:
    """Adds first and last base of each variant's reference allele."""
    return variants.withColumns({"first": F.col("pos"), "last": F.col("pos") + F.greatest(F.length("ref"), F.lit(1)) - 1})


def without_overlap(a: DataFrame, b: DataFrame, *, on: list[str]) -> DataFrame:
    """Rows of ``a`` (variants) whose reference allele shares no base with one of ``b`` (anti-join of spans)."""
    spans = with_span(a)
    hit = overlapping_spans(spans, with_span(b), on=on).select(*on, "first", "last").distinct()
    return spans.join(hit, [*on, "first", "last"], "left_anti").select(*a.columns)
