"""Cohort quality figures; every per-run figure of one patient is a group by ``pid`` here."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.functions.fields import BASES, CLASSES, folded_flanks, let, mutation_class, vaf, vaf2

CHROMS = [*map(str, range(1, 23)), "X", "Y"]


def control_depth_cutoff(df: DataFrame, *, depth: str = "depth_control", times: int = 5, most: int = 50_000) -> DataFrame:
    """pid and cutoff: ``times`` the lower median of the control depths above 0, capped at ``most``."""
    capped = df.where(F.col(depth) > 0).withColumn("_d", F.least(F.col(depth), F.lit(most)))
    return capped.groupBy("pid").agg((times * F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY _d)")).cast("bigint").alias("cutoff"))


def _percent(part: Column, whole: Column) -> Column:
    return F.round(F.try_divide(100.0 * part, whole), 2)


def dbsnp_overlap(df: DataFrame, *, min_conf: int = 8) -> DataFrame:
    """Per patient: rows, somatic ones (by text), scored ones, and of these those in dbSNP and 1000 genomes with percentages."""
    somatic = F.col("annotation_control").contains("somatic")
    scored = somatic & (F.col("confidence") >= min_conf)
    hit = lambda c: scored & F.col(c).contains("MATCH=exact")
    sums = df.groupBy("pid").agg(
        F.count(F.lit(1)).alias("n_all"), F.count_if(somatic).alias("n_somatic"), F.count_if(scored).alias("n_scored"),
        F.count_if(hit("dbsnp")).alias("n_dbsnp"), F.count_if(hit("kgenomes")).alias("n_1kg"),
    )
    return sums.withColumns({"dbsnp_percent": _percent(F.col("n_dbsnp"), F.col("n_scored")), "kg_percent": _percent(F.col("n_1kg"), F.col("n_scored"))})


def snv_dbsnp_ratio(df: DataFrame) -> DataFrame:
    found = df.groupBy("pid").agg(F.count(F.lit(1)).alias("n_snv"), F.count_if(F.col("dbsnp").contains("MATCH=exact")).alias("n_dbsnp"))
    return found.withColumn("ratio", F.round(F.try_divide(F.col("n_dbsnp").cast("double"), F.col("n_snv")), 6))


def synonymous_ratio(df: DataFrame) -> DataFrame:
    """Share of synonymous among exonic variants (exact matches) and what it says: contaminated, unclear, ok."""
    exonic = F.col("annovar_function") == "exonic"
    sums = df.groupBy("pid").agg(F.count_if(exonic).alias("n_exonic"), F.count_if(exonic & (F.col("exonic_classification") == "synonymous SNV")).alias("n_synonymous"))
    ratio = F.round(F.try_divide(F.col("n_synonymous").cast("double"), F.col("n_exonic")), 6)
    return sums.withColumn("ratio", ratio).withColumn("contamination", contamination_flag(F.col("ratio")))


def contamination_flag(ratio: Column) -> Column:
    return F.when(ratio > 0.5, "contaminated").when(ratio >= 0.35, "unclear").when(ratio.isNotNull(), "ok")


def tha_score(df: DataFrame, *, p: str = "pv4_tail", limit: float = 0.15) -> DataFrame:
    """Share of variants whose tail-distance bias has p < 0.05, and whether it is above ``limit``."""
    share = F.try_divide(F.count_if(F.col(p) < 0.05).cast("double"), F.count(p))
    return df.groupBy("pid").agg(F.round(share, 6).alias("tha_score")).withColumn("tha_flag", F.col("tha_score") > limit)


def mutation_context_frequencies(df: DataFrame, *, min_conf: int | None = None) -> DataFrame:
    """Counts by class, flanks, type (somatic, germline) and exonic or not: all 384 rows of every patient."""
    if min_conf is not None:
        df = df.where(F.col("confidence") >= min_conf)
    before, after = folded_flanks(F.col("ref"), F.col("base_before"), F.col("base_after"))
    rows = df.where(F.col("annotation_control").isin("somatic", "germline")).select(
        "pid", mutation_class(F.col("ref"), F.col("alt")).alias("mutation"), before.alias("before"), after.alias("after"),
        F.col("annotation_control").alias("type"), F.coalesce(F.col("annovar_function") == "exonic", F.lit(False)).alias("exonic"),
    )
    keys = ["mutation", "before", "after", "type", "exonic"]
    counts = rows.groupBy("pid", *keys).agg(F.count(F.lit(1)).alias("n"))
    whole = df.select("pid").distinct()
    for name, values in zip(keys, (CLASSES, BASES, BASES, ["somatic", "germline"], [True, False])):
        whole = whole.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))
    return whole.join(counts, ["pid", *keys], "left").withColumn("n", F.coalesce("n", F.lit(0).cast("bigint")))


def context_rollup(frequencies: DataFrame) -> DataFrame:
    """Over exonic and other."""
    return frequencies.groupBy("pid", "mutation", "before", "after", "type").agg(F.sum("n").alias("n"))


def snvs_per_chromosome(df: DataFrame, lengths: DataFrame) -> DataFrame:
    """Count and count per megabase (rounded length) by patient, chromosome and class.  ``lengths``: chrom, length."""
    counts = df.groupBy("pid", "chrom", mutation_class(F.col("ref"), F.col("alt")).alias("mutation")).agg(F.count(F.lit(1)).alias("n"))
    joined = counts.join(lengths, "chrom")
    return joined.select("pid", "chrom", "mutation", "n", F.round(F.try_divide(F.col("n").cast("double"), F.round(F.col("length") / 1e6)), 6).alias("per_mb"))


def maf_table(df: DataFrame, *, min_coverage: int = 0, min_conf: int = 8) -> DataFrame:
    """in_dbsnp (0 or 1), chrom, vaf2 and depth of confident variants."""
    counts = [F.col(c) for c in ("trf", "trr", "tvf", "tvr")]
    depth = counts[0] + counts[1] + counts[2] + counts[3]
    kept = df.where((F.col("confidence") >= min_conf) & (depth >= min_coverage))
    return kept.select("pid", F.col("dbsnp").contains("MATCH=exact").cast("bigint").alias("in_dbsnp"), "chrom", "pos", vaf2(*counts).alias("vaf"), depth.alias("depth"))


def maf_density(table: DataFrame, *, points: int = 64) -> DataFrame:
    """Gaussian kernel density of vaf at ``points`` places from 0 to 1, of all variants and of those in dbSNP (if above 3).

    Values have two decimals, so at most 101 of them per patient stand for all rows.  Bandwidth: 0.9 times the lesser of
    the standard deviation and the quartile distance / 1.34, times n^-0.2.
    """
    both = table.withColumn("of", F.explode(F.when(F.col("in_dbsnp") == 1, F.array(F.lit("all"), F.lit("dbsnp"))).otherwise(F.array(F.lit("all")))))
    binned = both.groupBy("pid", "of", "vaf").agg(F.count(F.lit(1)).alias("k"))
    figures = both.groupBy("pid", "of").agg(F.count(F.lit(1)).alias("n"), F.stddev_samp("vaf").alias("sd"), (F.percentile("vaf", 0.75) - F.percentile("vaf", 0.25)).alias("iqr"))
    spread = F.when(F.least("sd", F.col("iqr") / 1.34) > 0, F.least("sd", F.col("iqr") / 1.34)).when(F.col("sd") > 0, F.col("sd")).otherwise(F.lit(1.0))
    figures = figures.where("of = 'all' OR n > 3").withColumn("width", 0.9 * F.coalesce(spread, F.lit(1.0)) * F.pow(F.col("n").cast("double"), -0.2))
    placed = binned.join(figures, ["pid", "of"]).withColumn("at", F.explode(F.transform(F.sequence(F.lit(0), F.lit(points - 1)), lambda i: i / (points - 1.0))))
    bump = F.col("k") * F.exp(-0.5 * F.pow((F.col("at") - F.col("vaf")) / F.col("width"), 2)) / (F.col("n") * F.col("width") * F.sqrt(2 * F.pi()))
    return placed.groupBy("pid", "of", F.round("at", 6).alias("at")).agg(F.round(F.sum(bump), 6).alias("density"))


def recurrence(df: DataFrame, *, approximate: bool = False) -> DataFrame:
    """Number of patients for each variant."""
    count = F.approx_count_distinct("pid") if approximate else F.count_distinct("pid")
    return df.groupBy("chrom", "pos", "ref", "alt").agg(count.alias("n_patients"))


def local_control_af(df: DataFrame) -> DataFrame:
    """Share of the cohort's patients that have each variant; the number of patients is one row."""
    patients = df.agg(F.count_distinct("pid").alias("n_cohort"))
    joined = recurrence(df).join(F.broadcast(patients))  # one row by construction
    return joined.select("chrom", "pos", "ref", "alt", "n_patients", F.round(F.try_divide(F.col("n_patients").cast("double"), F.col("n_cohort")), 6).alias("af"))


def purity_by_chromosome(df: DataFrame) -> DataFrame:
    """pid, chrom (24 rows), gamma_tumour, gamma_control and their ratio (purity), of variants with confidence above 7.

    Only heterozygous-looking counts (vaf below 0.6) are summed; without any, the tumour's is 0 and the control's 1.
    """
    confident = df.where(F.col("confidence") > 7)
    tumour, control = (F.array(*[F.col(c) for c in names]) for names in (("trf", "trr", "tvf", "tvr"), ("crf", "crr", "cvf", "cvr")))

    def gamma(counts: Column, annotation: str, none: float) -> Column:
        ours = (F.col("annotation_control") == annotation) & (vaf(counts[0], counts[1], counts[2], counts[3]) < 0.6)
        alt = F.sum(F.when(ours, counts[2] + counts[3]))
        return F.coalesce(F.try_divide(alt.cast("double"), F.sum(F.when(ours, counts[0] + counts[1] + counts[2] + counts[3]))), F.lit(none))

    name = F.regexp_replace("chrom", "^chr", "").alias("chrom")
    sums = confident.groupBy("pid", name).agg(gamma(tumour, "somatic", 0.0).alias("gamma_tumour"), gamma(control, "germline", 1.0).alias("gamma_control"))
    whole = df.select("pid").distinct().withColumn("chrom", F.explode(F.array(*[F.lit(c) for c in CHROMS])))
    joined = whole.join(sums, ["pid", "chrom"], "left")
    joined = joined.withColumns({"gamma_tumour": F.coalesce("gamma_tumour", F.lit(0.0)), "gamma_control": F.coalesce("gamma_control", F.lit(1.0))})
    return joined.withColumn("purity", F.try_divide("gamma_tumour", "gamma_control"))


#: One-sided 1 % points of the t distribution by degrees of freedom from 1; 800 beyond 23.  The second is as the method has it (quirk Q8).
T_POINTS = [31.82, -959, 4.541, 3.747, 3.365, 3.143, 2.998, 2.896, 2.821, 2.764, 2.718, 2.681, 2.650, 2.624, 2.602, 2.583, 2.567, 2.552, 2.539, 2.528, 2.518, 2.508, 2.500]


def _critical(n: Column) -> Column:
    """What the largest of ``n`` deviations, in standard deviations, must exceed."""
    t = F.coalesce(F.get(F.array(*[F.lit(float(x)) for x in T_POINTS]), n - 3), F.lit(800.0))
    return (n - 1) / F.sqrt(n.cast("double")) * F.sqrt(t * t / (n - 2 + t * t))


def _mean(rows: Column) -> Column:
    return F.aggregate(rows, F.lit(0.0), lambda a, x: a + x["purity"]) / F.size(rows)


def _without_worst(state: Column) -> Column:
    """One step: the chromosome that is farthest from the mean goes (of equal ones the last), if it is far enough; else all is done."""
    rows = state["rows"]

    def step(mean: Column) -> Column:
        spread = F.sqrt(F.aggregate(rows, F.lit(0.0), lambda a, x: a + (x["purity"] - mean) * (x["purity"] - mean)) / (F.size(rows) - 1))
        sd = F.when(spread == 0, F.lit(1.0)).otherwise(spread)
        worst = F.array_max(F.transform(rows, lambda x: F.struct(F.abs(x["purity"] - mean).alias("off"), x["rank"].alias("rank"), x["chrom"].alias("chrom"))))

        def judged(w: Column) -> Column:
            goes = (w["off"] / sd) > _critical(F.size(rows))
            left = F.filter(rows, lambda x: x["rank"] != w["rank"])
            return F.when(goes, F.struct(left.alias("rows"), F.array_append(state["gone"], F.struct(w["rank"].alias("rank"), w["chrom"].alias("chrom"))).alias("gone"), F.lit(False).alias("done"))).otherwise(
                F.struct(rows.alias("rows"), state["gone"].alias("gone"), F.lit(True).alias("done"))
            )

        return let(worst, judged)

    ended = F.struct(rows.alias("rows"), state["gone"].alias("gone"), F.lit(True).alias("done"))
    return F.when(state["done"] | (F.size(rows) < 3), ended).otherwise(let(_mean(rows), step))


def purity_esd(by_chromosome: DataFrame) -> DataFrame:
    """A patient's purity: the mean over chromosomes after dropping outliers one by one.

    A patient's rows, at most one a chromosome, are one array, and a fold over as many steps takes outliers out of it.
    """
    rank = F.array_position(F.array(*[F.lit(c) for c in CHROMS]), F.col("chrom"))
    rows = by_chromosome.groupBy("pid").agg(F.array_sort(F.collect_list(F.struct(rank.alias("rank"), "chrom", F.col("purity").cast("double").alias("purity")))).alias("rows"))
    begin = F.struct("rows", F.array().cast("array<struct<rank:bigint,chrom:string>>").alias("gone"), F.lit(False).alias("done"))
    end = rows.withColumn("end", F.aggregate(F.sequence(F.lit(1), F.size("rows")), begin, lambda state, _: _without_worst(state)))
    purity = F.when(F.size("end.rows") > 0, F.round(_mean(F.col("end.rows")), 6)).otherwise(F.lit(0.0))
    names = F.array_join(F.transform(F.array_sort("end.gone"), lambda x: x["chrom"]), ",")
    return end.select("pid", purity.alias("purity"), F.size("end.gone").cast("bigint").alias("n_outliers"), names.alias("outliers"))


def qc_row(df: DataFrame) -> DataFrame:
    """One row a patient: snvnum, snvindbSNP, ratios and the THA score, of rows that are the somatic selection, in one grouping."""
    exonic = F.col("annovar_function") == "exonic"
    sums = df.groupBy("pid").agg(
        F.count(F.lit(1)).alias("snvnum"), F.count_if(F.col("dbsnp").contains("MATCH=exact")).alias("snvindbSNP"), F.count_if(exonic).alias("_exonic"),
        F.count_if(exonic & (F.col("exonic_classification") == "synonymous SNV")).alias("_synonymous"), F.count_if(F.col("pv4_tail") < 0.05).alias("_low"), F.count("pv4_tail").alias("_tails"),
    )
    ratio = lambda a, b, name: F.round(F.try_divide(F.col(a).cast("double"), F.col(b)), 6).alias(name)
    return sums.select("pid", "snvnum", "snvindbSNP", ratio("snvindbSNP", "snvnum", "snvInDbsnpRatio"), ratio("_synonymous", "_exonic", "synonymousRatio"), ratio("_low", "_tails", "thaScore"))
