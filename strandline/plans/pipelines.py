"""User-level jobs composed of the operators."""

from __future__ import annotations

from collections.abc import Collection
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.operators import base_quality, bias, confidence, control, filters, intervals, joins, qc, reads
from strandline.storage import short_methods, stored


def pipeline_call(raw: DataFrame, pileup: DataFrame, **limits) -> DataFrame:
    """Raw calls and control pileups to candidates with their control comparison."""
    kept = filters.raw_snv_filter(raw, **limits)
    counts = control.control_counts(joins.restrict_to_candidates(pileup, kept))
    return control.compare_control(kept, counts)


def pipeline_annotate(
    candidates: DataFrame, read_rows: DataFrame | None = None, *, held: DataFrame | None = None, known: dict[str, DataFrame] | None = None, tracks: dict[str, DataFrame] | None = None,
    genes: DataFrame | None = None, options: confidence.Options | None = None, cut=stored, keep: Collection[str] | None = None,
) -> DataFrame:
    """Known sites, genes, tracks, corrected counts, and two rounds of scoring with bias flags.

    Reads come as ``read_rows``, a row each, or as ``held``: the candidates again, with their reads in each row.  Where these are dealt by
    position, they are not dealt again.  Annotations are looked up for places alone, and those that are found meet the rows by position.

    Without ``options``, the control's depth is judged by `qc.control_depth_cutoff` of each patient (column depth_cutoff).
    ``keep``: the columns of the result, by default all there are.
    """
    # no annotation bears on the correction: what reads its variants twice comes first, what forgets how rows were dealt (Python does) last
    rows = reads.overlap_corrected_counts(candidates, read_rows) if held is None else held
    if options is None:
        depths = candidates.withColumn("depth_control", F.col("crf") + F.col("crr") + F.col("cvf") + F.col("cvr"))
        cutoffs = qc.control_depth_cutoff(depths).select("pid", F.col("cutoff").alias("depth_cutoff"))
        rows = rows.join(F.broadcast(cutoffs), "pid", "left")  # a row a patient
        options = confidence.Options(cutoff="depth_cutoff")
    rows = _annotated(rows, candidates.select(*joins.KEY, "ref", "alt"), known or {}, tracks or {}, genes)
    rows = rows if held is None else reads.overlap_corrected_counts_of_rows(rows)
    return bias.two_round_bias_filter(rows, options, cut=cut, keep=keep)


def _annotated(rows: DataFrame, sites: DataFrame, known: dict[str, DataFrame], tracks: dict[str, DataFrame], genes: DataFrame | None) -> DataFrame:
    """``rows`` with the annotations of ``sites`` (their position and alleles): only those found are sent to the rows, which are not sorted."""
    found = sites
    for name, database in known.items():
        found = joins.annotate_known(found, database, name)
        found = found.withColumn(name, joins.rendered(F.col(name)))
    if genes is not None:
        found = joins.annotate_genes(found, genes)
    found = intervals.annotate_tracks(found, {name: intervals.Track(track) for name, track in tracks.items()})
    added = [c for c in found.columns if c not in sites.columns]
    if not added:
        return rows
    none = {c: F.lit(".") for c in (*known, *tracks)}  # genes that are not found are null
    there = reduce(or_, [F.col(c) != none[c] if c in none else F.col(c).isNotNull() for c in added])
    joined = rows.drop(*added).join(found.where(there).select(*joins.KEY, *added).hint("shuffle_hash"), joins.KEY, "left")
    return joined.withColumns({c: F.coalesce(c, dot) for c, dot in none.items()})


def pipeline_deep_annotate(df: DataFrame, tracks: dict[str, DataFrame | intervals.Track], *, most: int = 5) -> DataFrame:
    """All tracks (intervals, or `intervals.Track` with options of their own) in one join."""
    own = {name: track if isinstance(track, intervals.Track) else intervals.Track(track, most=most) for name, track in tracks.items()}
    return intervals.annotate_tracks(df, own)


def pipeline_filter(scored: DataFrame, *, criteria: list[tuple[str, str, str]] | None = None, min_conf: int = 8) -> tuple[DataFrame, DataFrame]:
    """Extraction classes, and the quality row of each patient's somatic class."""
    if criteria:
        scored = filters.filter_by_criteria(scored, criteria)
    extracted = filters.extract_classes(scored, min_conf=min_conf)
    return extracted, qc.qc_row(extracted.where(F.col("class") == "somatic"))


def pipeline_filter_rerun(
    scored: DataFrame, *, threshold: float = 20, min_conf: int = 8, cut=stored, keep: Collection[str] | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """After the median base-quality filter: extraction classes, functional variants that the filter lost, quality rows.

    ``cut`` (by default, written and read again) keeps the functional variants, a small part of the rows, so that both sides of the
    comparison are made of one reading of ``scored``.  ``keep``: the columns of the lost ones, by default all there are.
    """
    with_maf = base_quality.with_maf(scored)
    extracted = filters.extract_classes(filters.median_alt_bq_filter(with_maf, threshold), min_conf=min_conf)
    functional = filters.extract_class(with_maf, "somatic_functional", min_conf=min_conf)
    if keep is not None:
        asked = {*joins.KEY, "ref", "bq_alt", *keep}
        functional = functional.select(*[c for c in functional.columns if c in asked])
    with short_methods(scored.sparkSession):
        before = cut(functional)
    lost = joins.subtract_variants(before, filters.median_alt_bq_filter(before, threshold))
    return extracted, lost if keep is None else lost.select(*keep), qc.qc_row(extracted.where(F.col("class") == "somatic"))
