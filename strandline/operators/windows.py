"""Distances between neighbouring mutations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from strandline.functions.fields import chrom_rank, genomic_region, mutation_class, vaf, vaf2

COUNTS = ("trf", "trr", "tvf", "tvr")


def intermutation_distance(df: DataFrame, *, min_vaf: float = 0.0, exclude: tuple[str, ...] = (), per_chrom: bool = True) -> DataFrame:
    """pid, chrom, pos, ref, alt, mutation, region, vaf and distance to the mutation before (0 counts as 1).

    The first of a chromosome gets its position.  ``per_chrom=False``: a chromosome's first mutation is measured from the
    last one before it in genome order if that has a smaller position.
    """
    counts = [F.col(c) for c in COUNTS]
    kept = df.where((vaf(*counts) >= min_vaf) & ~F.col("chrom").isin(list(exclude))) if exclude else df.where(vaf(*counts) >= min_vaf)
    if per_chrom:
        before = F.lag("pos", 1, 0).over(Window.partitionBy("pid", "chrom").orderBy("pos", "ref", "alt"))
        gap = F.col("pos") - before
    else:
        before = F.lag("pos", 1, 0).over(Window.partitionBy("pid").orderBy(chrom_rank(F.col("chrom")), "pos", "ref", "alt"))
        gap = F.when(F.col("pos") < before, F.col("pos")).otherwise(F.col("pos") - before)
    return kept.select(
        "pid", "chrom", "pos", "ref", "alt", mutation_class(F.col("ref"), F.col("alt")).alias("mutation"), genomic_region(F.col("annovar_function")).alias("region"),
        vaf2(*counts).alias("vaf"), F.when(gap == 0, 1).otherwise(gap).cast("bigint").alias("distance"),
    )


def rainfall(df: DataFrame, lengths: DataFrame) -> DataFrame:
    """Genome-wide place, log10 distance to the mutation before on the chromosome, and class; rows without a distance above 0 go.

    ``lengths``: chrom, length (a row a chromosome).
    """
    offsets = lengths.withColumn(
        "offset", F.coalesce(F.sum("length").over(Window.orderBy(chrom_rank(F.col("chrom"))).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ).select("chrom", "offset")
    before = F.lag("pos", 1).over(Window.partitionBy("pid", "chrom").orderBy("pos", "ref", "alt"))
    rows = df.where("ref <> 'N'").select("pid", "chrom", "pos", mutation_class(F.col("ref"), F.col("alt")).alias("mutation"), (F.col("pos") - before).alias("distance"))
    placed = rows.where("distance > 0").join(offsets, "chrom")
    return placed.select("pid", "chrom", "pos", "mutation", (F.col("offset") + F.col("pos")).alias("place"), F.round(F.log10(F.col("distance").cast("double")), 6).alias("log_distance"))
