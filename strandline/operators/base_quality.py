"""Base-quality statistics of variant and reference bases.

Lists (``bq_ref``, ``bq_alt``, arrays a row) are read in place, or exploded once and counted by key and quality; no group is gathered
again, so that what is shuffled are counts.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from strandline.functions.fields import folded_flanks, mutation_class, once, vaf
from strandline.storage import ship_package

KEY = ["pid", "chrom", "pos"]
TRIPLET = ["mutation", "before", "after"]
HIGHEST = 55


def _values(column: str) -> Column:
    return F.coalesce(F.col(column).cast("array<bigint>"), F.array().cast("array<bigint>"))


def long_form(df: DataFrame, *keep: str) -> DataFrame:
    """A row for each base: key columns, ``keep``, allele (REF, ALT), bq."""
    lists = F.array(*[F.struct(F.lit(a).alias("allele"), _values(f"bq_{a.lower()}").alias("values")) for a in ("REF", "ALT")])
    columns = [c for c in (*KEY, *keep) if c in df.columns]
    return df.select(*columns, F.explode(lists).alias("x")).select(*columns, "x.allele", F.explode("x.values").alias("bq"))


def bq_row_stats(df: DataFrame) -> DataFrame:
    """For each variant and allele (REF, ALT, BOTH): n, mean, median, cov (percent), share at or below 30, 25, 20.

    All is made from what a row holds: no base is exploded, nothing shuffled.
    """
    ref, alt = _values("bq_ref"), _values("bq_alt")
    lists = F.array(*[F.struct(F.lit(a).alias("allele"), v.alias("all")) for a, v in (("REF", ref), ("ALT", alt), ("BOTH", F.concat(ref, alt)))])
    rows = df.select(*KEY, F.explode(lists).alias("x")).select(*KEY, "x.*").where(F.size("all") > 0)
    rows = rows.withColumn("values", F.sort_array(F.array_compact("all")))
    zero, n = F.lit(0).cast("bigint"), F.size("values").cast("bigint")
    rows = rows.withColumns({"_n": n, "_sum": F.aggregate("values", zero, lambda a, x: a + x), "_squares": F.aggregate("values", zero, lambda a, x: a + x * x)})
    middle = (F.get("values", F.floor((F.col("_n") - 1) / 2).cast("int")) + F.get("values", F.floor(F.col("_n") / 2).cast("int"))) / 2.0
    mean = F.try_divide(F.col("_sum").cast("double"), F.col("_n").cast("double"))
    spread = F.sqrt(F.try_divide((F.col("_n") * F.col("_squares") - F.col("_sum") * F.col("_sum")).cast("double"), (F.col("_n") * (F.col("_n") - 1)).cast("double")))
    low = lambda q: F.round(F.size(F.filter("values", lambda x: x <= q)) / F.size("all"), 6).alias(f"below_{q}")
    return rows.select(
        *KEY, "allele", F.size("all").cast("bigint").alias("n"), F.round(mean, 6).alias("mean"), F.when(F.col("_n") > 0, middle).cast("double").alias("median"),
        F.round(F.try_divide(100.0 * spread, mean), 6).alias("cov"), low(30), low(25), low(20),
    )


def bq_histogram(df: DataFrame) -> DataFrame:
    """Counts of each base quality from 0 to 55 by allele, over all rows of a patient."""
    return long_form(df).where(F.col("bq").between(0, HIGHEST)).groupBy("pid", "allele", "bq").agg(F.count(F.lit(1)).alias("n"))


def bq_distribution(df: DataFrame) -> DataFrame:
    """Counts by class of vaf (tenths), base quality and allele; their share of the quality, and relative to its REF count."""
    n_alt, n_ref = F.size("bq_alt"), F.size("bq_ref")
    share = F.coalesce(F.try_divide(n_alt.cast("double"), (n_alt + n_ref).cast("double")), F.lit(0.0))
    rows = long_form(df.withColumn("vaf_class", F.round(share * 10) / 10), "vaf_class")
    counts = rows.groupBy("pid", "vaf_class", "bq", "allele").agg(F.count(F.lit(1)).alias("n"))
    quality = Window.partitionBy("pid", "bq")
    ref = F.sum(F.when(F.col("allele") == "REF", F.col("n"))).over(quality)
    return counts.withColumns({"share": F.round(F.col("n") / F.sum("n").over(quality), 6), "per_ref": F.round(F.coalesce(F.try_divide(F.col("n").cast("double"), ref), F.lit(0.0)), 6)})


def with_triplet(df: DataFrame, *, fold: bool = True) -> DataFrame:
    """Adds mutation, before, after; ``fold``: on the pyrimidine's strand."""
    if not fold:
        return df.withColumns({"mutation": F.concat("ref", "alt"), "before": F.col("base_before"), "after": F.col("base_after")})
    before, after = folded_flanks(F.col("ref"), F.col("base_before"), F.col("base_after"))
    return df.withColumns({"mutation": mutation_class(F.col("ref"), F.col("alt")), "before": before, "after": after})


def long_form_of_reads(variants: DataFrame, reads: DataFrame, *, fold: bool = True) -> DataFrame:
    """The rows of `long_form` with triplets, straight from reads (pid, chrom, pos, base, bq) at variants: no list is gathered first."""
    sites = with_triplet(variants, fold=fold).select(*KEY, *TRIPLET, F.upper("ref").alias("_ref"), F.upper("alt").alias("_alt"))
    base = F.upper("base")
    allele = F.when(base == F.col("_ref"), "REF").when(base == F.col("_alt"), "ALT")
    met = reads.select(*KEY, "base", F.col("bq").cast("bigint").alias("bq")).join(sites, KEY).withColumn("allele", allele)
    return met.where("allele IS NOT NULL").select(*KEY, *TRIPLET, "allele", "bq")


def triplet_bq_distribution(df: DataFrame, *, fold: bool = True) -> DataFrame:
    """`quality_shares` of the lists of each row."""
    return quality_shares(long_form(with_triplet(df, fold=fold), *TRIPLET))


def quality_shares(rows: DataFrame) -> DataFrame:
    """Histogram of base qualities by triplet and allele: n, its share, the share at or below, and the share at or below 30 with a band."""
    counts = rows.groupBy("pid", *TRIPLET, "allele", "bq").agg(F.count(F.lit(1)).alias("n"))
    cell = Window.partitionBy("pid", *TRIPLET, "allele")
    total = F.sum("n").over(cell)
    until = F.sum("n").over(cell.orderBy("bq").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    low = F.round(100.0 * F.sum(F.when(F.col("bq") <= 30, F.col("n")).otherwise(0)).over(cell) / total, 6)
    out = counts.withColumns({"share": F.round(F.col("n") / total, 6), "cumulative": F.round(until / total, 6), "auc30": low})
    return out.withColumn("band", F.when(F.col("auc30") > 50, "high").when(F.col("auc30") > 40, "medium").when(F.col("auc30") > 30, "low").otherwise("none"))


#: Terms of the continued fraction, at most.
TERMS = 500


def incomplete_beta(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Regularised incomplete beta function of whole arrays, by its continued fraction.

    The fraction converges fast below the mean; above it the other tail is taken.
    """
    a, b, x = np.broadcast_arrays(*(np.asarray(v, np.float64) for v in (a, b, x)))
    other = x > (a + 1) / (a + b + 2)
    p, q, y = np.where(other, b, a), np.where(other, a, b), np.where(other, 1 - x, x)
    inside = (y > 0) & (y < 1)
    y = np.where(inside, y, 0.5)
    gamma = np.vectorize(math.lgamma, otypes=[np.float64])
    front = np.exp(gamma(p + q) - gamma(p) - gamma(q) + p * np.log(y) + q * np.log1p(-y)) / p
    tiny = 1e-300
    off = lambda v: np.where(np.abs(v) < tiny, tiny, v)
    c = np.ones_like(y)
    d = 1 / off(1 - (p + q) * y / (p + 1))
    value = d.copy()
    for m in range(1, TERMS):
        for term in (m * (q - m) * y / ((p + 2 * m - 1) * (p + 2 * m)), -(p + m) * (p + q + m) * y / ((p + 2 * m) * (p + 2 * m + 1))):
            d = 1 / off(1 + term * d)
            c = off(1 + term / c)
            value = value * d * c
        if (np.abs(d * c - 1) < 1e-14).all():
            break
    found = np.where(inside, np.minimum(front * value, 1.0), np.where(other, 1 - x >= 1, x >= 1).astype(np.float64))
    return np.where(other, 1 - found, found)


def two_sided(t: np.ndarray, df: np.ndarray) -> np.ndarray:
    """P(|T| >= |t|) of whole arrays; 1 where there is no statistic."""
    t, df = np.asarray(t, np.float64), np.asarray(df, np.float64)
    known = np.isfinite(t) & (df > 0)
    t, df = np.where(known, t, 0.0), np.where(known, df, 1.0)
    return np.where(known, incomplete_beta(df / 2, 0.5, df / (df + t * t)), 1.0)


def t_two_sided(t: float | None, df: float | None) -> float:
    """`two_sided` of one statistic."""
    return float(two_sided(np.array([math.nan if t is None else t]), np.array([math.nan if df is None else df]))[0])


def triplet_bq_shift(df: DataFrame, *, min_bq: int = 0) -> DataFrame:
    """By triplet: figures of both alleles' base qualities, ratio and difference of means and of medians, and the t statistic of their shift.

    Welch's test; one-sample if one side has a single base.  Reverse-complement triplets are merged.
    """
    rows = long_form(with_triplet(df), *TRIPLET).where(F.col("bq") >= min_bq)
    # the few qualities that there are, each with its count: medians and variances of whole groups need no rows gathered
    counts = rows.groupBy("pid", *TRIPLET, "allele", "bq").agg(F.count(F.lit(1)).alias("k"))
    of = lambda a: F.when(F.col("allele") == a, F.col("bq"))
    sums, figures = [], []
    for a in ("REF", "ALT"):
        n = a.lower()
        many = lambda c: F.coalesce(F.sum(F.when(F.col("allele") == a, c)), F.lit(0)).cast("bigint")  # noqa: E731, B023
        sums += [
            many(F.col("k")).alias(f"n_{n}"), many(F.col("k") * F.col("bq")).alias(f"_sum_{n}"), F.percentile(of(a), 0.5, F.col("k")).cast("double").alias(f"median_{n}"),
            F.min(of(a)).alias(f"min_{n}"), F.max(of(a)).alias(f"max_{n}"), many(F.col("k") * F.col("bq") * F.col("bq")).alias(f"_squares_{n}"),
        ]
        whole = F.col(f"n_{n}")
        mean = F.try_divide(F.col(f"_sum_{n}").cast("double"), whole.cast("double"))
        exact = lambda c: F.col(c).cast("decimal(19,0)")
        parts = (exact(f"n_{n}") * exact(f"_squares_{n}")).cast("decimal(38,0)") - (exact(f"_sum_{n}") * exact(f"_sum_{n}")).cast("decimal(38,0)")
        figures += [whole, mean.alias(f"mean_{n}"), *[F.col(f"{c}_{n}") for c in ("median", "min", "max")]]
        figures += [F.try_divide(parts.cast("double"), whole.cast("double") * (whole - 1).cast("double")).alias(f"var_{n}")]
    sums = counts.groupBy("pid", *TRIPLET).agg(*sums).select("pid", *TRIPLET, *figures)
    c = F.col
    part = {n: F.try_divide(c(f"var_{n}"), c(f"n_{n}")) for n in ("ref", "alt")}
    welch = part["ref"] + part["alt"]
    squares = F.try_divide(F.pow(part["ref"], 2), c("n_ref") - 1) + F.try_divide(F.pow(part["alt"], 2), c("n_alt") - 1)
    difference = c("mean_alt") - c("mean_ref")
    t = (
        F.when((c("n_ref") > 1) & (c("n_alt") > 1), F.try_divide(difference, F.sqrt(welch)))
        .when((c("n_alt") == 1) & (c("n_ref") > 1), F.try_divide(difference, F.sqrt(part["ref"])))
        .when((c("n_ref") == 1) & (c("n_alt") > 1), F.try_divide(difference, F.sqrt(part["alt"])))
    )
    freedom = (
        F.when((c("n_ref") > 1) & (c("n_alt") > 1), F.try_divide(F.pow(welch, 2), squares))
        .when((c("n_alt") == 1) & (c("n_ref") > 1), (c("n_ref") - 1).cast("double"))
        .when((c("n_ref") == 1) & (c("n_alt") > 1), (c("n_alt") - 1).cast("double"))
    )
    out = sums.withColumns({"ratio": F.round(F.try_divide("mean_alt", "mean_ref"), 6), "difference": F.round(difference, 6), "t": F.round(t, 6), "freedom": F.round(freedom, 6)})
    out = out.withColumns({"ratio_medians": F.round(F.try_divide("median_alt", "median_ref"), 6), "difference_medians": F.col("median_alt") - F.col("median_ref")})
    return out.withColumns({k: F.round(k, 6) for k in ("mean_ref", "mean_alt")}).drop("var_ref", "var_alt")


@F.pandas_udf(DoubleType())
def t_p_value(t: pd.Series, freedom: pd.Series) -> pd.Series:
    return pd.Series(two_sided(t.to_numpy(np.float64, na_value=np.nan), freedom.to_numpy(np.float64, na_value=np.nan)))


def shift_p_values(shift: DataFrame) -> DataFrame:
    """Adds p and its Benjamini-Hochberg adjustment within a patient (at most 96 rows each)."""
    ship_package(shift.sparkSession)
    tested = shift.withColumn("p", t_p_value(F.col("t"), F.col("freedom")))
    patient = Window.partitionBy("pid")
    ranked = tested.withColumns({"_rank": F.row_number().over(patient.orderBy("p", *TRIPLET)), "_n": F.count(F.lit(1)).over(patient)})
    following = patient.orderBy("_rank").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    adjusted = F.least(F.min(F.col("p") * F.col("_n") / F.col("_rank")).over(following), F.lit(1.0))
    return ranked.withColumn("p_adjusted", F.round(adjusted, 6)).withColumn("p", F.round("p", 6)).drop("_rank", "_n")


def available_bqs(df: DataFrame) -> DataFrame:
    return long_form(df).select("pid", "allele", "bq").distinct()


def read_position_quantile(df: DataFrame, q: float = 0.5, *, positions: str = "rp_alt") -> DataFrame:
    """The rounded ``q`` quantile (linear between order statistics) of the variant's read positions, by row."""
    df, ordered = once(df, {"_ordered": F.sort_array(F.array_compact(positions))}), F.col("_ordered")
    place = F.lit(q) * (F.size(ordered) - 1)
    low = F.get(ordered, F.floor(place).cast("int"))
    high = F.get(ordered, F.ceil(place).cast("int"))
    value = F.when(F.size(ordered) > 0, low + (place - F.floor(place)) * (high - low))
    return once(df.select(*KEY, "_ordered"), {"quantile": F.round(value).cast("bigint")}).drop("_ordered")


def bq_vs_read_position(df: DataFrame, *, auc: float = 0.25) -> DataFrame:
    """Pairs of read position and base quality of variant bases by triplet, and whether the triplet has many low qualities."""
    triplets = with_triplet(df)
    pairs = triplets.select(*KEY, *TRIPLET, F.explode(F.arrays_zip("rp_alt", "bq_alt")).alias("x")).select(*KEY, *TRIPLET, F.col("x.rp_alt").alias("position"), F.col("x.bq_alt").alias("bq"))
    share = pairs.groupBy("pid", *TRIPLET).agg((F.count_if(F.col("bq") <= 30) / F.count(F.lit(1)) >= auc).alias("flagged"))
    return pairs.join(F.broadcast(share), ["pid", *TRIPLET])  # 96 rows a patient


def _median_over(column: str, window: Window) -> Column:
    return F.percentile(column, 0.5).over(window)


def bq_artifact_triplets(df: DataFrame, *, low: int = 30, least: int = 0, min_n: int = 0) -> DataFrame:
    """By triplet: variants, their share of the class, the share of variant bases in least..low; z and robust z among a patient's triplets.

    z above 2 is ``orange``, above 4 ``red``; robust ones count triplets with at least ``min_n`` variants.
    """
    triplets = with_triplet(df)
    n = triplets.groupBy("pid", *TRIPLET).agg(F.count(F.lit(1)).alias("n"))
    rows = long_form(triplets, *TRIPLET).where((F.col("allele") == "ALT") & (F.col("bq") >= least))
    auc = rows.groupBy("pid", *TRIPLET).agg(F.round(F.count_if(F.col("bq") <= low) / F.count(F.lit(1)), 3).alias("auc"))
    whole = n.join(auc, ["pid", *TRIPLET], "left").withColumn("auc", F.nullif(F.col("auc"), F.lit(0.0)))
    whole = whole.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy("pid", "mutation")), 3))
    patient = Window.partitionBy("pid")
    counted = F.when(F.col("n") >= min_n, F.col("auc"))
    whole = whole.withColumn("_x", counted)
    whole = whole.withColumns({"_mean": F.avg("_x").over(patient), "_sd": F.stddev_samp("_x").over(patient), "_median": _median_over("_x", patient)})
    whole = whole.withColumn("_off", F.abs(F.col("_x") - F.col("_median")))
    whole = whole.withColumn("_mad", _median_over("_off", patient))
    z = F.try_divide(F.col("_x") - F.col("_mean"), F.col("_sd"))
    robust = F.try_divide(F.col("_x") - F.col("_median"), 1.4826 * F.col("_mad"))
    out = whole.withColumns({"z": F.round(z, 6), "robust_z": F.round(robust, 6)})
    return out.withColumn("signal", F.when(F.col("z") > 4, "red").when(F.col("z") > 2, "orange")).select("pid", *TRIPLET, "n", "share", "auc", "z", "robust_z", "signal")


@F.arrow_udf(StructType([StructField("hist", ArrayType(LongType())), StructField("curve", ArrayType(DoubleType())), StructField("area", DoubleType())]))
def curve_of_list(values: pa.Array) -> pa.Array:
    """Counts of the base qualities 0 to 55 in each list of a batch, others not counted, their running shares to 6 decimals and the sum of these (null without any)."""
    n, width = len(values), HIGHEST + 1
    row = np.repeat(np.arange(n), pc.list_value_length(values).fill_null(0).to_numpy(zero_copy_only=False))
    each = values.flatten().fill_null(-1).to_numpy(zero_copy_only=False)
    there = (each >= 0) & (each <= HIGHEST)
    counts = np.bincount(row[there] * width + each[there], minlength=n * width).astype(np.int64)
    sums = counts.reshape(n, width).cumsum(axis=1)
    total = sums[:, -1:]
    # halves up, told with integers
    shares = (2_000_000 * sums + total) // np.maximum(2 * total, 1) / 1e6
    offsets = np.arange(0, n * width + 1, width, dtype=np.int32)
    none = pa.array(total[:, 0] == 0)
    curves = pa.ListArray.from_arrays(pa.array(offsets), pa.array(shares.ravel()), mask=none)
    area = pa.array(shares.cumsum(axis=1)[:, -1], mask=total[:, 0] == 0)  # added one after the other, as SQL does
    return pa.StructArray.from_arrays([pa.ListArray.from_arrays(offsets, counts), curves, area], names=["hist", "curve", "area"])


def cumulated(counts: Column) -> Column:
    """Running sums of an array."""
    empty = F.array().cast("array<bigint>")
    return F.aggregate(counts, empty, lambda sums, n: F.array_append(sums, F.coalesce(F.try_element_at(sums, F.lit(-1)), F.lit(0).cast("bigint")) + n))


def bq_curves(df: DataFrame) -> DataFrame:
    """``df`` with each variant's own histograms (hist_ref, hist_alt: 56 counts) and curves (curve_ref, curve_alt: shares at or below each quality; area_ref, area_alt: their sums; null without bases).

    All is made from what a row holds: nothing is exploded, nothing shuffled.
    """
    ship_package(df.sparkSession)
    out = once(df, {f"_{a}": curve_of_list(_values(f"bq_{a}")) for a in ("ref", "alt")})
    return out.select("*", *[F.col(f"_{a}.{part}").alias(f"{part}_{a}") for part in ("hist", "curve", "area") for a in ("ref", "alt")]).drop("_ref", "_alt")


#: Upper and lower ends of the ranges of base quality whose shares are looked at, and the fewest variants of a triplet.
UPPER, LOWER, FEWEST = (30, 25, 20), (0, 5, 13), (0, 5, 10)


def _thousandths(part: Column, whole: Column) -> Column:
    """part / whole to 3 decimals, halves up, told with integers; null for a whole of 0."""
    doubled = 2000 * part + whole
    return F.when(whole > 0, (doubled - doubled % (2 * whole)) / (2 * whole) / 1000.0)


def bq_artifact_grid(df: DataFrame) -> DataFrame:
    """By triplet: n, its share of the class, the share of bases in each of nine ranges of quality for both alleles, and how far the variant's share at or below 30 stands out.

    One scan makes a histogram for each triplet and allele (56 counts at most, cumulated once); all nine shares are read from it: auc_30_0_ref,
    auc_30_0_alt and so on, of all bases, to 3 decimals, 0 and none being null.  For triplets of at least 0, 5 and 10 variants: z, robust_z
    (by median and 1.4826 times the median deviation) and signal (``orange`` above 2, ``red`` above 4) among those of the patient.
    """
    rows = with_triplet(df)
    n = rows.groupBy("pid", *TRIPLET).agg(F.count(F.lit(1)).alias("n"))
    counts = long_form(rows, *TRIPLET).where(F.col("bq").between(0, HIGHEST)).groupBy("pid", *TRIPLET, "allele", "bq").agg(F.count(F.lit(1)).alias("k"))
    cells = counts.groupBy("pid", *TRIPLET).pivot("allele", ["REF", "ALT"]).agg(F.map_from_entries(F.collect_list(F.struct("bq", "k"))))  # 56 entries at most
    every = F.sequence(F.lit(0).cast("bigint"), F.lit(HIGHEST).cast("bigint"))
    cells = cells.select("pid", *TRIPLET, *[cumulated(_filled(a, every)).alias(a.lower()) for a in ("REF", "ALT")])

    def share(a: str, low: int, least: int) -> Column:
        below = F.get(F.col(a), least - 1) if least else F.lit(0)
        return F.nullif(_thousandths(F.get(F.col(a), low) - below, F.element_at(F.col(a), -1)), F.lit(0.0)).alias(f"auc_{low}_{least}_{a}")

    grid = n.join(cells, ["pid", *TRIPLET], "left").withColumn("share", _thousandths(F.col("n"), F.sum("n").over(Window.partitionBy("pid", "mutation"))))
    grid = grid.select("pid", *TRIPLET, "n", "share", *[share(a, low, least) for low in UPPER for least in LOWER for a in ("ref", "alt")])
    patient = Window.partitionBy("pid")
    x = {m: F.when(F.col("n") >= m, F.col("auc_30_0_alt")) for m in FEWEST}
    grid = grid.withColumns({f"_x{m}": c for m, c in x.items()})
    grid = grid.withColumns({f"_{name}{m}": of for m in FEWEST for name, of in (("mean", F.avg(f"_x{m}").over(patient)), ("sd", F.stddev_samp(f"_x{m}").over(patient)), ("med", _median_over(f"_x{m}", patient)))})
    grid = grid.withColumns({f"_off{m}": F.abs(F.col(f"_x{m}") - F.col(f"_med{m}")) for m in FEWEST})
    grid = grid.withColumns({f"_mad{m}": _median_over(f"_off{m}", patient) for m in FEWEST})
    for m in FEWEST:
        z = F.round(F.try_divide(F.col(f"_x{m}") - F.col(f"_mean{m}"), F.col(f"_sd{m}")), 6)
        robust = F.round(F.try_divide(F.col(f"_x{m}") - F.col(f"_med{m}"), 1.4826 * F.col(f"_mad{m}")), 6)
        grid = grid.withColumns({f"z_{m}": z, f"robust_z_{m}": robust})
        grid = grid.withColumn(f"signal_{m}", F.when(F.col(f"z_{m}") > 4, "red").when(F.col(f"z_{m}") > 2, "orange"))
    return grid.drop(*[c for c in grid.columns if c.startswith("_")])


def _filled(counts: str, qualities: Column) -> Column:
    """A map's counts for all qualities, 0 where it has none."""
    return F.transform(qualities, lambda q: F.coalesce(F.try_element_at(counts, q), F.lit(0).cast("bigint")))


def with_maf(df: DataFrame) -> DataFrame:
    return df.withColumn("maf", F.round(vaf(*[F.col(c) for c in ("trf", "trr", "tvf", "tvr")]), 2))
