"""Read-level corrections of variant counts: mate overlaps, positional duplicates, mismatches, stray bases.

Everything is keyed by the variant's position.  Reads that come as a row each are dealt by that key, once, and only those at sites that are
corrected; the mate window, the duplicate window and the final sums all find what they need in place.  Variants that hold their
reads (`overlap_corrected_counts_of_rows`) are corrected where they are.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from strandline.functions.fields import TEN_BASES, once
from strandline.storage import ship_package

KEY = ["pid", "chrom", "pos"]
DUPLICATE = ["ref_id", "ref_start", "ref_end", "next_ref_id", "next_start"]


def base_quality_lists(variants: DataFrame, reads: DataFrame) -> DataFrame:
    """For each variant with such reads: lists of base qualities and read positions of both alleles, in pileup order, and vaf.

    All reads count, whatever their qualities.  Positions of reverse reads are counted from the other end.
    """
    joined = reads.select(*KEY, "pileup_idx", "base", "bq", "is_reverse", "query_pos", "read_len").join(variants.select(*KEY, "ref", "alt"), KEY)
    place = F.when(F.col("is_reverse"), F.col("read_len") - F.col("query_pos")).otherwise(F.col("query_pos"))
    allele = F.when(F.upper("base") == F.upper("alt"), "alt").when(F.upper("base") == F.upper("ref"), "ref")
    item = F.struct("pileup_idx", F.col("bq").alias("bq"), place.alias("rp"))

    def gathered(name: str, part: str) -> Column:
        return F.transform(F.array_sort(F.collect_list(F.when(allele == name, item))), lambda x: x[part])

    lists = joined.groupBy(*KEY).agg(*[gathered(n, p).alias(f"{p}_{n}") for p in ("bq", "rp") for n in ("alt", "ref")])
    n_alt, n_ref = F.size("bq_alt"), F.size("bq_ref")
    return lists.withColumn("vaf", F.coalesce(F.try_divide(n_alt.cast("double"), (n_alt + n_ref).cast("double")), F.lit(0.0)))


def _is_letter(column: str) -> Callable[[Column], Column]:
    return lambda read: F.upper(read["base"]) == F.col(column)


def base_quality_lists_of_rows(df: DataFrame) -> DataFrame:
    """The same lists for variants that hold their reads: ``reads`` (an array in pileup order: base, bq, is_reverse, query_pos, read_len) gives way to them.

    All is made from what a row holds: no read is exploded, nothing is shuffled.
    """
    same = F.upper("ref") == F.upper("alt")
    upper = df.withColumns({"_a": F.upper("alt"), "_r": F.when(same, F.lit(None)).otherwise(F.upper("ref"))})
    of = {n: F.filter("reads", _is_letter(c)) for n, c in (("alt", "_a"), ("ref", "_r"))}
    place = lambda x: F.when(x["is_reverse"], x["read_len"] - x["query_pos"]).otherwise(x["query_pos"])
    split = upper.withColumns({f"_{n}": reads for n, reads in of.items()}).drop("reads", "_a", "_r")
    lists = split.withColumns({f"bq_{n}": F.col(f"_{n}.bq") for n in of} | {f"rp_{n}": F.transform(f"_{n}", place) for n in of}).drop("_alt", "_ref")
    n_alt, n_ref = F.size("bq_alt"), F.size("bq_ref")
    return lists.withColumn("vaf", F.coalesce(F.try_divide(n_alt.cast("double"), (n_alt + n_ref).cast("double")), F.lit(0.0)))


def correctable(*, no_control: bool = False) -> Column:
    """Calls whose counts are corrected: of one alternative base, and somatic (without a control: reclassified as somatic, confidence above 7)."""
    somatic = (F.col("confidence") > 7) & F.col("reclassification").contains("somatic") if no_control else F.col("annotation_control").contains("somatic")
    return F.coalesce(somatic & (F.length("alt") == 1), F.lit(False))


#: Sites up to which they are broadcast (under 100 bytes each), so that only their reads are dealt out.
BROADCAST_SITES = 500_000


def _at_sites(reads: DataFrame, sites: DataFrame) -> DataFrame:
    """Reads at ``sites``, dealt by position.

    Few sites go to the reads, and what is left of these is dealt; with more, both sides meet by position, where Spark sends reads
    through a Bloom filter of the sites first.
    """
    if sites.limit(BROADCAST_SITES + 1).count() <= BROADCAST_SITES:
        return reads.join(F.broadcast(sites), KEY).repartition(*KEY)
    return reads.join(sites.hint("merge"), KEY)


def overlap_corrected_counts(
    variants: DataFrame, reads: DataFrame, *, min_mapq: int = 30, min_baseq: int = 13, max_mismatches: int | None = None, no_control: bool = False
) -> DataFrame:
    """Variants with corrected trf, trr, tvf, tvr, the original ones, what was removed, and ten strand counts.

    ``variants``: pid, chrom, pos (unique), ref, alt, trf, trr, tvf, tvr, and what `correctable` reads; all other rows pass
    with their counts as they are, nothing removed, and null strand counts.  Columns added: *_original, dup_ref, dup_alt,
    pair_ref, pair_alt, mis_ref, mis_alt, stray (bases of neither allele taken off), plus, minus.
    """
    sites = variants.where(correctable(no_control=no_control)).select(*KEY, F.upper("ref").alias("_ref"), F.upper("alt").alias("_alt"))
    good = reads.where((F.col("mq") >= min_mapq) & (F.col("bq") >= min_baseq))
    rows = _at_sites(good, sites)
    base = F.upper("base")
    mismatched = F.coalesce(F.col("nm") > max_mismatches, F.lit(False)) if max_mismatches is not None else F.lit(False)
    rows = rows.withColumns({"mismatched": mismatched, "allele": F.when(base == F.col("_ref"), "ref").when(base == F.col("_alt"), "alt").otherwise("other")})
    rows = rows.withColumn("paired", F.col("is_proper_pair") & ~F.col("mismatched"))
    # of two reads with one name and the same base the second goes; of different bases the worse, of equal quality the first
    mates = Window.partitionBy(*KEY, "paired", "qname").orderBy("pileup_idx")
    whole = mates.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    first = F.first(F.struct("base", "bq")).over(whole)
    rows = rows.withColumns({"nth": F.row_number().over(mates), "first": first})
    beaten = (F.col("nth") > 1) & (F.col("base") != F.col("first.base")) & (F.col("first.bq") <= F.col("bq"))
    rows = rows.withColumn("beats", F.max(beaten).over(whole))
    overlapped = F.when(F.col("nth") == 1, F.col("beats")).otherwise(~beaten)
    rows = rows.withColumn("overlapped", F.col("paired") & overlapped)
    rows = rows.withColumn("left", F.col("paired") & ~F.col("overlapped"))
    places = Window.partitionBy(*KEY, "left", *DUPLICATE).orderBy(F.desc("bq"), F.desc("pileup_idx"))
    rows = rows.withColumn("duplicate", F.col("left") & (F.row_number().over(places) > 1))
    gone = F.col("mismatched") | F.col("overlapped") | F.col("duplicate")
    counted = ~F.col("mismatched")
    plus = F.col("is_read1") != F.col("is_reverse")  # first reads forward, second reads in reverse
    letter = F.when(F.col("is_reverse"), F.lower("base")).otherwise(base)

    def ten(side: Column, name: str) -> Column:
        return F.array(*[F.count_if(F.col("paired") & side & (letter == b)) for b in TEN_BASES]).alias(name)

    sums = rows.groupBy(*KEY).agg(
        *[F.count_if(gone & (F.col("allele") == a) & (F.col("is_reverse") if r else ~F.col("is_reverse"))).alias(f"gone_{a}_{'r' if r else 'f'}") for a in ("ref", "alt") for r in (0, 1)],
        *[F.count_if(F.col(flag) & (F.col("allele") == a)).alias(f"{n}_{a}") for n, flag in (("dup", "duplicate"), ("pair", "overlapped"), ("mis", "mismatched")) for a in ("ref", "alt")],
        F.count_if(counted & (F.col("allele") == "alt")).alias("alt_seen"),
        F.count_if(counted & (F.col("allele") == "other") & ~F.col("is_reverse")).alias("stray_f"),
        F.count_if(counted & (F.col("allele") == "other") & F.col("is_reverse")).alias("stray_r"),
        ten(plus, "plus"),
        ten(~plus, "minus"),
    )
    return _less(variants.join(sums, KEY, "left"), correctable(no_control=no_control))


#: What is counted of the reads of a site; the sums of both ways to hold them.
COUNTS = [
    *[f"gone_{a}_{side}" for a in ("ref", "alt") for side in "fr"], *[f"{n}_{a}" for n in ("dup", "pair", "mis") for a in ("ref", "alt")],
    "alt_seen", "stray_f", "stray_r",
]


def _less(out: DataFrame, due: Column) -> DataFrame:
    """``out`` (variants with the sums of their reads, null for none) with corrected counts."""
    zero = F.lit(0).cast("bigint")
    out = out.withColumns({c: F.coalesce(c, zero) for c in COUNTS} | {c: F.when(due, F.coalesce(c, F.array(*[zero] * 10))) for c in ("plus", "minus")})
    out = out.withColumns({f"{c}_original": F.col(c) for c in ("trf", "trr", "tvf", "tvr")})
    less = lambda c, n: F.greatest(F.col(c) - F.col(n), zero)
    short = due & (F.col("tvf_original") + F.col("tvr_original") > F.col("alt_seen"))
    stray = lambda c, n: F.when(short & (F.col(c) >= F.col(n)), F.col(c) - F.col(n)).otherwise(F.col(c))
    out = out.withColumns({"trf": less("trf", "gone_ref_f"), "trr": less("trr", "gone_ref_r"), "tvf": less("tvf", "gone_alt_f"), "tvr": less("tvr", "gone_alt_r")})
    out = out.withColumns({"tvf": stray("tvf", "stray_f"), "tvr": stray("tvr", "stray_r"), "stray": F.when(short, F.col("stray_f") + F.col("stray_r")).otherwise(zero)})
    return out.drop("gone_ref_f", "gone_ref_r", "gone_alt_f", "gone_alt_r", "alt_seen", "stray_f", "stray_r")


def overlap_corrected_counts_of_rows(df: DataFrame, *, min_mapq: int = 30, min_baseq: int = 13, max_mismatches: int | None = None, no_control: bool = False) -> DataFrame:
    """`overlap_corrected_counts` of variants that hold their reads: ``reads`` (an array in pileup order of what the other takes a row each) gives way to the counts.

    All is made from what a row holds: no read is exploded, nothing is shuffled or sorted beyond a batch of rows.
    """
    ship_package(df.sparkSession)

    @F.arrow_udf(f"struct<{', '.join(f'{c}:bigint' for c in COUNTS)}, plus:array<bigint>, minus:array<bigint>>")
    def sums(reads: pa.Array, ref: pa.Array, alt: pa.Array) -> pa.Array:
        return sums_of_reads(reads, ref, alt, max_mismatches=max_mismatches)

    due = correctable(no_control=no_control)
    # what is sent to Python, and waits for its answer, are good reads only
    good = F.filter("reads", lambda read: (read["mq"] >= min_mapq) & (read["bq"] >= min_baseq))
    rows = once(df, {"_good": F.when(due, good)}).drop("reads")
    counted = once(rows, {"_sums": sums("_good", F.upper("ref"), F.upper("alt"))}).drop("_good")
    return _less(counted.select("*", "_sums.*").drop("_sums"), due)


def _codes(values: pa.Array) -> tuple[np.ndarray, int]:
    """A number for each value from 0, the same for equal ones and one for all nulls; and how many there are."""
    found = values.dictionary_encode()
    return found.indices.fill_null(len(found.dictionary)).to_numpy(zero_copy_only=False).astype(np.int64), len(found.dictionary) + 1


def _true(values: pa.Array, default: bool = False) -> np.ndarray:
    return values.fill_null(default).to_numpy(zero_copy_only=False)


def _groups(site: np.ndarray, columns: list[tuple[np.ndarray, int]]) -> np.ndarray:
    """A number for each combination of site and codes; numbers stay below the rows times the codes of one column."""
    group = site.astype(np.int64)
    for codes, n in columns:
        group = group * n + codes
        if len(group) and group.max() >= 1 << 40:
            group = np.unique(group, return_inverse=True)[1].astype(np.int64)
    return group


def sums_of_reads(reads: pa.Array, ref: pa.Array, alt: pa.Array, *, max_mismatches: int | None) -> pa.Array:
    """For each site of a batch (its reads of good quality, and both alleles in upper case) ``COUNTS`` and the ten counts of both orientations; the steps of `overlap_corrected_counts`."""
    n = len(reads)
    # lists that are null have no length here; `flatten` leaves out what they may cover
    site = np.repeat(np.arange(n), pc.list_value_length(reads).fill_null(0).to_numpy(zero_copy_only=False))
    each = reads.flatten()
    of = {f.name: each.field(f.name) for f in each.type}
    bq = of["bq"].to_numpy(zero_copy_only=False)
    upper = pc.utf8_upper(of["base"])
    is_ref = _true(pc.equal(upper, ref.take(pa.array(site))))
    is_alt = _true(pc.equal(upper, alt.take(pa.array(site)))) & ~is_ref
    mismatched = np.zeros(len(site), bool) if max_mismatches is None else _true(pc.greater(of["nm"], max_mismatches))
    paired = _true(of["is_proper_pair"]) & ~mismatched
    reverse, forward, known = _true(of["is_reverse"]), ~_true(of["is_reverse"], True), of["base"].is_valid().to_numpy(zero_copy_only=False)

    # of two reads with one name and the same base the second goes; of different bases the worse, of equal quality the first
    base = _codes(of["base"])[0]
    chosen = np.flatnonzero(paired)
    name = _groups(site[chosen], [tuple(x[chosen] if i == 0 else x for i, x in enumerate(_codes(of["qname"])))])
    order = np.argsort(name, kind="stable")
    at, name = chosen[order], name[order]
    starts = np.append(True, name[1:] != name[:-1])[: len(name)]
    number = np.cumsum(starts) - 1
    first = at[np.flatnonzero(starts)][number] if len(at) else at
    later = ~starts & (bq[first] <= bq[at])
    beaten = later & (base[at] != base[first]) & known[at] & known[first]
    unknown = later & ~(known[at] & known[first])  # bases that can't be compared are left as they are
    beats = np.zeros(int(starts.sum()), bool)
    beats[number[beaten]] = True
    overlapped, left = np.zeros(len(site), bool), np.zeros(len(site), bool)
    overlapped[at] = np.where(starts, beats[number] if len(at) else starts, ~beaten & ~unknown)
    left[at] = ~overlapped[at] & ~unknown

    # of what is left, one read a place stays: of the best quality the last
    duplicate = np.zeros(len(site), bool)
    chosen = np.flatnonzero(left)
    places = _groups(site[chosen], [(codes[chosen], many) for codes, many in (_codes(of[c]) for c in DUPLICATE)])
    order = np.lexsort((bq[chosen], places))
    places = places[order]
    duplicate[chosen[order]] = np.append(places[1:] == places[:-1], False)[: len(places)]

    gone, counted = mismatched | overlapped | duplicate, ~mismatched
    count = lambda flag: pa.array(np.bincount(site[flag], minlength=n).astype(np.int64))
    alleles, sides = {"ref": is_ref, "alt": is_alt}, {"f": forward, "r": reverse}
    found = {f"gone_{a}_{side}": gone & of_allele & of_side for a, of_allele in alleles.items() for side, of_side in sides.items()}
    found |= {f"{name}_{a}": flag & of_allele for name, flag in (("dup", duplicate), ("pair", overlapped), ("mis", mismatched)) for a, of_allele in alleles.items()}
    found |= {"alt_seen": counted & is_alt} | {f"stray_{side}": counted & ~is_ref & ~is_alt & of_side for side, of_side in sides.items()}
    letter = pc.if_else(pa.array(reverse), pc.utf8_lower(of["base"]), upper)
    tenth = pc.index_in(letter, pa.array(TEN_BASES)).fill_null(-1).to_numpy(zero_copy_only=False)
    told = paired & (tenth >= 0) & _true(pc.and_(of["is_read1"].is_valid(), of["is_reverse"].is_valid()))
    plus = _true(of["is_read1"]) != reverse  # first reads forward, second reads in reverse

    def ten(side: np.ndarray) -> pa.Array:
        counts = np.bincount(site[told & side] * 10 + tenth[told & side], minlength=10 * n).astype(np.int64)
        return pa.ListArray.from_arrays(np.arange(0, 10 * n + 1, 10, dtype=np.int32), counts)

    return pa.StructArray.from_arrays([*[count(found[c]) for c in COUNTS], ten(plus), ten(~plus)], names=[*COUNTS, "plus", "minus"])
