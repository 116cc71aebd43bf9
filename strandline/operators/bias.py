"""Strand bias over the catalogue of 96 substitutions in context."""

from __future__ import annotations

from collections.abc import Collection
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.functions.fields import BASES, CLASSES, TEN_BASES, binom_cdf_half, folded_flanks, mutation_class
from strandline.operators.confidence import PARTS, Options, finished, fixed_parts, high_confidence_somatic
from strandline.storage import short_methods, stored

CELL = ["mutation", "before", "after"]


def catalogue(spark: SparkSession) -> DataFrame:
    """The 96 cells: mutation, before, after."""
    cells = spark.range(1)
    for name, values in zip(CELL, (CLASSES, list(BASES), list(BASES))):
        cells = cells.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))
    return cells.select(*CELL)


def strand_counts(df: DataFrame) -> DataFrame:
    """Adds mutation, before, after (on the pyrimidine's strand) and pcr_plus, pcr_minus, seq_plus, seq_minus.

    Reads ``plus`` and ``minus`` (ten counts), ref, alt, base_before, base_after.  Null where the counts are missing.
    """
    place = F.array_position(F.array(*[F.lit(b) for b in TEN_BASES]), F.col("alt")) - 1
    upper = F.when(place >= 0, place % 5).cast("int")  # of an allele in either case; null for all that is no single base
    of = lambda counts, k: F.get(F.col(counts), k).cast("bigint")
    first, first_r, second, second_r = of("plus", upper), of("minus", upper + 5), of("minus", upper), of("plus", upper + 5)
    own = F.col("ref").isin("C", "T")
    pcr, pcr_back = first + second_r, second + first_r
    seq, seq_back = first + second, first_r + second_r
    before, after = folded_flanks(F.col("ref"), F.col("base_before"), F.col("base_after"))
    return df.withColumns(
        {
            "mutation": mutation_class(F.col("ref"), F.col("alt")), "before": before, "after": after,
            "pcr_plus": F.when(own, pcr).otherwise(pcr_back), "pcr_minus": F.when(own, pcr_back).otherwise(pcr),
            "seq_plus": F.when(own, seq).otherwise(seq_back), "seq_minus": F.when(own, seq_back).otherwise(seq),
        }
    )


def strand_error_matrices(df: DataFrame, *kinds: str, cut=None) -> dict[str, DataFrame]:
    """For each of ``kinds`` (``pcr``, ``seq``): pid, mutation, before, after, plus, minus, n_muts, log_ratio; all 96 cells of every patient.

    ``df`` has strand counts, and is read once for all kinds.  Rows with several alternatives, without counts or outside
    of the catalogue are left out; they only name their patient.  ``cut`` is applied to the sums (97 rows a patient at most), so
    that patients, cells and kinds are all made of one reading of the rows.
    """
    placed = F.coalesce(~F.col("alt").contains(",") & F.col("mutation").isin(CLASSES) & F.col("before").isin(*BASES) & F.col("after").isin(*BASES), F.lit(False))
    figures = []
    for kind in kinds:
        there = F.col(f"{kind}_plus").isNotNull()
        figures += [F.sum(f"{kind}_plus").alias(f"{kind}_p"), F.sum(F.when(there, F.col(f"{kind}_minus"))).alias(f"{kind}_m"), F.count_if(there).alias(f"{kind}_n")]
    narrow = df.select("pid", *[F.when(placed, F.col(c)).alias(c) for c in CELL], *[f"{k}_{side}" for k in kinds for side in ("plus", "minus")])
    sums = narrow.groupBy("pid", *CELL).agg(*figures)
    sums = cut(sums) if cut else sums
    cells = F.array(*[F.struct(F.lit(m).alias("mutation"), F.lit(b).alias("before"), F.lit(a).alias("after")) for m in CLASSES for b in BASES for a in BASES])
    whole = sums.select("pid").distinct().select("pid", F.explode(cells).alias("cell")).select("pid", "cell.*")
    filled = whole.join(sums.where("mutation IS NOT NULL"), ["pid", *CELL], "left")
    zero = F.lit(0).cast("bigint")
    found = {}
    for kind in kinds:
        matrix = filled.select("pid", *CELL, *[F.coalesce(f"{kind}_{c}", zero).alias(name) for c, name in (("p", "plus"), ("m", "minus"), ("n", "n_muts"))])
        found[kind] = matrix.withColumn("log_ratio", F.log2((F.col("plus") + 1) / (F.col("minus") + 1)))
    return found


def strand_error_matrix(df: DataFrame, kind: str = "pcr") -> DataFrame:
    """One matrix of `strand_error_matrices`."""
    return strand_error_matrices(df, kind)[kind]


def bias_matrix(
    errors: DataFrame, *, p_value: float = 0.01, min_ratio: float = 0.53, strong_ratio: float = 0.63, n_reads: int = 20, n_muts: int = 4, enforce_n_muts: bool = False
) -> DataFrame:
    """Adds bias to each cell: 0, or the direction (+: plus) times 1, or 2 where strong.

    ``enforce_n_muts``: ask for more than ``n_muts`` mutations as well; by default that limit has no effect.
    """
    plus, minus = F.col("plus"), F.col("minus")
    n = plus + minus
    top = F.try_divide(F.greatest(plus, minus).cast("double"), n.cast("double"))
    flagged = (n > n_reads) & (top > min_ratio) & (binom_cdf_half(F.least(plus, minus), n) < p_value)
    if enforce_n_muts:
        flagged = flagged & (F.col("n_muts") > n_muts)
    size = F.when(top > strong_ratio, 2).otherwise(1) * F.when(plus >= minus, 1).otherwise(-1)
    return errors.withColumn("bias", F.when(F.coalesce(flagged, F.lit(False)), size).otherwise(0).cast("bigint"))


def _flag(bias: Column, plus: Column, minus: Column, name: str, max_weak: int, max_strong: int, ratio: float) -> Column:
    total = plus + minus
    opposite = F.when(bias > 0, minus).otherwise(plus)
    allowed = F.when(F.abs(bias) == 2, max_strong).otherwise(max_weak)
    excused = (opposite > allowed) & (opposite / total > ratio)
    cell = F.concat(F.lit(f"{name}_plus="), plus.cast("string"), F.lit(f";{name}_minus="), minus.cast("string"))
    return F.when((bias != 0) & ~excused, cell).otherwise("0")


def _biased_cells(pcr: DataFrame, seq: DataFrame) -> DataFrame:
    return pcr.select("pid", *CELL, F.col("bias").alias("_pcr")).join(seq.select("pid", *CELL, F.col("bias").alias("_seq")), ["pid", *CELL])


def _flagged(df: DataFrame, cells: DataFrame, *, max_opp_weak: int = 0, max_opp_strong: int = 1, ratio: float = 0.1) -> DataFrame:
    joined = df.join(cells, ["pid", *CELL], "left")
    total = lambda k: F.col(f"{k}_plus") + F.col(f"{k}_minus")
    unknown = F.col("_pcr").isNull() | total("pcr").isNull() | (total("pcr") == 0) | (total("seq") == 0)
    limits = (max_opp_weak, max_opp_strong, ratio)
    flags = {
        "seq_bias": F.when(unknown, ".").otherwise(_flag(F.col("_pcr"), F.col("pcr_plus"), F.col("pcr_minus"), "PCR", *limits)),
        "seqing_bias": F.when(unknown, ".").otherwise(_flag(F.col("_seq"), F.col("seq_plus"), F.col("seq_minus"), "SEQ", *limits)),
    }
    return joined.withColumns(flags).drop("_pcr", "_seq")


def flag_bias(df: DataFrame, pcr: DataFrame, seq: DataFrame, *, max_opp_weak: int = 0, max_opp_strong: int = 1, ratio: float = 0.1) -> DataFrame:
    """Adds seq_bias and seqing_bias: the strand counts of artefacts, ``0`` of others, ``.`` where nothing can be said.

    ``df`` has strand counts; the matrices (96 cells a patient) are joined by patient and cell.
    """
    return _flagged(df, _biased_cells(pcr, seq), max_opp_weak=max_opp_weak, max_opp_strong=max_opp_strong, ratio=ratio)


#: What rounds read of rows that are scored without bias.
_ROUNDS = ["pid", "alt", *CELL, "pcr_plus", "pcr_minus", "seq_plus", "seq_minus", "annotation_control", "reclassification", "confidence", "filter", "_taken", "_tags"]


def two_round_bias_filter(df: DataFrame, options: Options | None = None, *, cut=stored, keep: Collection[str] | None = None, **thresholds) -> DataFrame:
    """Score, find biases among high-confidence somatic calls, flag, score with the flags; twice.

    What the rules for regions, tumour and control say does not change between rounds: it is worked out once with the score
    without bias, and ``cut`` (by default, written and read again) keeps it, so that each round only adds its bias terms.
    ``cut`` is applied to the sums and the flagged cells of each round as well, which are 96 cells a patient.

    ``keep``: the columns of the result, by default all there are; no others are carried through the rounds.
    """
    o = options or Options()
    flags = ["seq_bias", "seqing_bias", "seq_bias_1", "seqing_bias_1"]
    scored = finished(fixed_parts(strand_counts(df.drop(*flags)), o), replace(o, round=0)).drop("_start", "penalties")
    if keep is not None:
        asked = {*_ROUNDS, *keep, *(["_said"] if "penalties" in keep else [])}
        scored = scored.select(*[c for c in scored.columns if c in asked])
    with short_methods(df.sparkSession):
        current = cut(scored).withColumns({c: F.lit(".") for c in flags})
        if "_said" not in current.columns:
            current = current.withColumn("_said", F.array().cast("array<string>"))
        for number in (1, 2):
            somatic = high_confidence_somatic(current, no_control=o.no_control)
            cells = cut(_biased_cells(*(bias_matrix(m, **thresholds) for m in strand_error_matrices(somatic, "pcr", "seq", cut=cut).values())))
            if number == 2:
                current = current.withColumns({"seq_bias_1": F.col("seq_bias"), "seqing_bias_1": F.col("seqing_bias")})
            flagged = _flagged(current.drop("seq_bias", "seqing_bias"), cells)
            # the score of a round starts anew
            current = finished(flagged.withColumn("_start", F.lit(10)), replace(o, round=number))
    return current.drop(*PARTS) if keep is None else current.select(*keep)
