"""Joins of variants with other positions, catalogues and tracks.

Equi-joins leave the choice of a broadcast to Spark, which knows the sizes.  Joins with intervals and spans are in `intervals`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.functions.fields import right_trim_alleles
from strandline.operators.intervals import Track, annotate_tracks, without_overlap

KEY = ["pid", "chrom", "pos"]
VARIANT = ["chrom", "pos", "ref", "alt"]


def restrict_to_candidates(pileup: DataFrame, tumour: DataFrame) -> DataFrame:
    """Control positions at tumour candidates (left semi)."""
    return pileup.join(tumour.select(*KEY).distinct(), KEY, "left_semi")


def subtract_variants(a: DataFrame, b: DataFrame, *, on: list[str] | None = None) -> DataFrame:
    """Rows of ``a`` whose reference allele shares no base with one of ``b`` in the same patient.

    ``on``: compare these columns instead, for equality.
    """
    if on is None:
        return without_overlap(a, b, on=["pid", "chrom"])
    return a.join(b.select(*on).distinct(), on, "left_anti")


def semi_merge_filtered(df: DataFrame, kept: DataFrame, *, on: list[str] | None = None) -> DataFrame:
    """Original rows of a filtered subset."""
    on = on or ["pid", *VARIANT]
    return df.join(kept.select(*on).distinct(), on, "left_semi")


def union_variants(frames: list[DataFrame]) -> DataFrame:
    """Rows of all frames under one header; what a frame lacks is null."""
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame, allowMissingColumns=True)
    return first


def annotate_known(df: DataFrame, database: DataFrame, name: str, *, normalise: bool = True) -> DataFrame:
    """``df`` with an array column ``name`` of (match, id) of the catalogue's entries at the position; empty if none.

    ``exact`` where the alleles agree, else ``position``.  Alleles agree in their minimal form: of each alternative (both sides may
    name several, and the catalogue may pad them) with the reference, without the end that both share; ``normalise=False``
    compares them as they are written.  Entries are gathered by position first (their number does not depend on the
    cohort), so that a position that many patients have is joined with one row.
    """
    forms = minimal_forms(F.col("ref"), F.col("alt")) if normalise else F.array(F.concat_ws(">", F.upper("ref"), F.upper("alt")))
    here = database.select("chrom", "pos", F.struct("ref", "alt", "id", forms.alias("forms")).alias("hit")).groupBy("chrom", "pos").agg(F.array_sort(F.collect_list("hit")).alias("_hits"))
    joined = df.join(here, ["chrom", "pos"], "left").withColumn("_forms", forms)
    hit = lambda h: F.struct(F.when(F.arrays_overlap(h["forms"], F.col("_forms")), "exact").otherwise("position").alias("match"), h["id"].alias("id"))
    found = F.transform(F.coalesce("_hits", F.array().cast(here.schema["_hits"].dataType)), hit)
    return joined.withColumn(name, found).drop("_hits", "_forms")


def minimal_forms(ref: Column, alts: Column) -> Column:
    """Each alternative of a comma-separated list as ``REF>ALT`` in upper case, both without the longest end that they share."""

    def form(alt: Column) -> Column:
        cut = right_trim_alleles(F.upper(ref), F.array(alt))
        return F.concat(cut["ref"], F.lit(">"), F.get(cut["alts"], 0))

    return F.transform(F.split(F.upper(alts), ","), form)


def rendered(hits) -> object:
    """The text form of known-site hits: ``MATCH=exact;ID=…`` joined by ``&``; ``.`` if there are none."""
    cells = F.transform(hits, lambda h: F.concat(F.lit("MATCH="), h["match"], F.lit(";ID="), h["id"]))
    return F.when(F.size(hits) > 0, F.array_join(cells, "&")).otherwise(".")


def annotate_intervals(df: DataFrame, track: DataFrame, name: str, *, most: int | None = None) -> DataFrame:
    """``df`` with column ``name``: names of the track's intervals that hold the position, sorted, joined by ``&``; ``.`` if none.

    ``most``: only the first so many names.  Several tracks are one join with `intervals.annotate_tracks`.
    """
    return annotate_tracks(df, {name: Track(track, most=most)})


def annotate_genes(df: DataFrame, genes: DataFrame) -> DataFrame:
    """The four gene columns of a computed annotation table, by chromosome, start and end (of a variant: of its reference allele).

    Of several rows for one place the smallest counts, so that no variant is multiplied.
    """
    columns = ["annovar_function", "gene", "exonic_classification", "annovar_transcripts"]
    least = genes.groupBy("chrom", F.col("start").alias("pos"), F.col("end").alias("_end")).agg(F.min(F.struct(*columns)).alias("_gene"))
    ends = df.drop(*columns).withColumn("_end", F.col("pos") + F.greatest(F.length("ref"), F.lit(1)) - 1)
    return ends.join(least, ["chrom", "pos", "_end"], "left").select(*[c for c in ends.columns if c != "_end"], "_gene.*")


def merge_base_qualities(df: DataFrame, ref: DataFrame, alt: DataFrame, positions: DataFrame, *, how: str = "left") -> DataFrame:
    """Base-quality lists of both alleles and read positions of the variant, by position (bq_ref, bq_alt, rp_alt)."""
    for frame, column in ((ref, "bq_ref"), (alt, "bq_alt"), (positions, "rp_alt")):
        df = df.join(frame.select(*KEY, F.col("values").alias(column)), KEY, how)
    return df


def attach_clinical(df: DataFrame, clinical: DataFrame) -> DataFrame:
    """Clinical columns by patient; Spark broadcasts the clinical side when it is small."""
    return df.join(clinical, "pid", "left")
