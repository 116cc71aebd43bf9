"""Confidence scores, filter tags, reasons and reclassification of somatic calls.

A rule is a predicate with a penalty, a reason and a tag; the score is 10 less all penalties that apply, between 1 and
10.  Rules are rows of a list; one projection evaluates them, and nothing is shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.functions.fields import has_flag, info_get, is_valid, min_mapability, vaf
from strandline.operators.filters import known_germline

#: Fixed order of tags in FILTER.
TAG_ORDER = [
    "RE", "BL", "DP", "SB", "TAC", "dbSNP", "DB", "HSDEPTH", "MAP", "SBAF", "FRQ", "TAR", "UNCLEAR", "DPHIGH", "DPLOWC", "1PS",
    "ALTC", "ALTCFR", "FRC", "YALT", "VAF", "BI",
]


@dataclass(frozen=True)
class Options:
    cutoff: int | str = 150  # a depth, or the column that holds it
    punish_control: bool = True
    new_pun: float = 5
    round: int = 0
    no_pun_pcr: bool = False
    no_pun_seq: bool = False
    run_low_maf: bool = False
    run_exome: bool = False
    no_control: bool = False


@dataclass
class Rule:
    when: Column
    penalty: int | Column
    reason: str | Column = ""
    tag: str = ""
    tagged: Column | None = field(default=None)  # where the tag differs from the rule itself


def _is(name: str) -> Column:
    return is_valid(F.col(name))


def _known() -> tuple[Column, Column, Column]:
    """In 1000 genomes; in dbSNP; dbSNP entry that is precious or clinical."""
    in_1kg = F.coalesce(F.col("kgenomes").contains("MATCH=exact"), F.lit(False))
    in_dbsnp = F.coalesce(F.col("dbsnp").contains("MATCH=exact"), F.lit(False))
    return in_1kg, in_dbsnp, in_dbsnp & F.col("dbsnp").rlike(";CLN;|;PM;")


def _tumour() -> tuple[Column, Column, Column, Column]:
    tvf, tvr = F.col("tvf"), F.col("tvr")
    return tvf, tvr, F.col("trf") + F.col("trr") + tvf + tvr, vaf(F.col("trf"), F.col("trr"), tvf, tvr)


def _control() -> tuple[Column, Column]:
    return F.col("crf") + F.col("crr") + F.col("cvf") + F.col("cvr"), vaf(F.col("crf"), F.col("crr"), F.col("cvf"), F.col("cvr"))


def _two(share: Column) -> Column:
    return F.round(share, 2)


def bias_rules(o: Options) -> list[Rule]:
    rules = []

    def one(pcr: Column, seq: Column, name: str) -> None:
        pcr = pcr & F.lit(not o.no_pun_pcr and not o.run_exome)
        seq = seq & F.lit(not o.no_pun_seq)
        rules.append(Rule(pcr & seq, 3, f"bias_filter_{name}_PCR_and_SEQ(-3)", "BI"))
        rules.append(Rule(pcr & ~seq, 3, f"bias_filter_{name}_PCR(-3)", "BI"))
        rules.append(Rule(seq & ~pcr, 3, f"bias_filter_{name}_SEQ(-3)", "BI"))

    if o.round == 1:
        one(_is("seq_bias"), _is("seqing_bias"), "round1")
    if o.round == 2:
        one(_is("seq_bias_1"), _is("seqing_bias_1"), "round1")
        one(_is("seq_bias"), _is("seqing_bias"), "round2")
    return rules


def region_rules() -> list[Rule]:
    repeat = F.col("repeat_masker").rlike("Simple_repeat|Low_|Satellite")
    tandem = _is("simple_tandemrepeats")
    lowest = min_mapability(F.col("mapability"))
    steps = [(0.5, 1), (0.4, 1), (0.25, 1), (0.1, 2), (0.05, 3)]
    low = F.coalesce(lowest < 0.5, F.lit(False))
    taken = reduce(add, [F.when(lowest < limit, n).otherwise(0) for limit, n in steps])
    return [
        Rule(repeat, 2, "Simple_repeat(-2)", "RE"),
        Rule(~repeat & _is("repeat_masker"), 1, "Other_repeat(-1)", "RE"),
        Rule(tandem & ~repeat, 2, "Tandem_repeat(-2)", "RE"),
        Rule(_is("segdup") & ~repeat & ~tandem, 2, "Segmental_dup(-2)", "RE"),
        Rule(_is("duke_excluded") | _is("dac_blacklist"), 3, "Blacklist(-3)", "BL"),
        Rule(_is("hiseqdepth"), 3, "Hiseqdepth(-3)", "HSDEPTH"),
        Rule(F.col("mapability") == ".", 5, "Not_mappable(-5)", "MAP"),
        Rule(low, taken, F.concat(F.lit("Low_mappability("), F.col("mapability"), F.lit("=>-"), taken.cast("string"), F.lit(")")), "MAP"),
    ]


def tumour_rules(o: Options) -> list[Rule]:
    tvf, tvr, depth, share = _tumour()
    alt, low = tvf + tvr, o.run_low_maf
    biased = (tvf < 1) | (tvr < 1)
    rules = [
        Rule(depth <= 5, 3, "Tumor<5reads(-3)", "DP"),
        Rule(biased & (share <= 0.1), 3 if low else 5, "Strandbias_and_MAF<=0.1_and_low_maf_filter(-3)" if low else "Strandbias_and_MAF<=0.1(-5)", "SBAF"),
        Rule(biased & (share > 0.1), 2, "Strandbias(-2)", "SB"),
        Rule(alt <= 5, 0 if low else 2, "ALT<=5_and_low_maf_filter(-0)" if low else "ALT<=5(-2)", "TAC"),
    ]
    if low:
        rules.append(Rule((depth >= 150) & (alt <= 2), 3, "Coverage_above_200_and_less_than_3_variant_reads(-3)"))
    return rules + [
        Rule((tvf == 1) & (tvr == 1), 1 if low else 3, "Only_one_ALT_per_strand_and_low_maf_filter(-1)" if low else "Only_one_ALT_per_strand(-3)", "1PS"),
        Rule((alt < 5) & (share < 0.05), 1 if low else 3, "ALT<6_and_MAF<=0.1_and_low_maf_filter(-1)" if low else "ALT<6_and_MAF<=0.1(-3)", "FRQ"),
    ]


def control_rules(o: Options) -> list[Rule]:
    tvf, tvr, _, share = _tumour()
    depth, own = _control()
    annotation = F.col("annotation_control")
    somatic, germline, unclear = annotation.contains("somatic"), annotation.contains("germline"), annotation.contains("unclear")
    in_1kg, in_dbsnp, precious = _known()
    known = in_1kg | (in_dbsnp & ~precious)
    times = str(int(o.new_pun)) if float(o.new_pun).is_integer() else str(o.new_pun)
    rules = []
    if o.new_pun:
        close = F.coalesce(F.try_divide(_two(share), _two(own)) < o.new_pun, F.lit(False))
        rules.append(Rule((_two(own) > 0) & (annotation == "somatic") & close, 3, f"Alternative_allel_freq_not_{times}_times_bigger_in_tum_than_in_control(-3)", "VAF"))
    if not o.run_exome:
        cutoff = F.col(o.cutoff) if isinstance(o.cutoff, str) else F.lit(o.cutoff)
        high, very_high = (F.coalesce(depth > k * cutoff, F.lit(False)) for k in (1, 2))  # no cutoff, nothing high
        rules.append(Rule(high & ~very_high, 2, F.concat(F.lit("Controlcoverage>"), cutoff.cast("string"), F.lit("(-2)")), "DPHIGH"))
        rules.append(Rule(very_high, 4, F.concat(F.lit("Controlcoverage>2*"), cutoff.cast("string"), F.lit("(-4)")), "DPHIGH"))
    rules.append(Rule(depth <= 5, 3, "Controlcoverage<=5(-3)", "DPLOWC"))
    rules.append(Rule(somatic & (tvf + tvr < 2), 3, "Somatic_ALT<2(-3)", "TAR"))
    if o.punish_control:
        shown = own.cast("string")
        low_quality = F.coalesce(F.try_divide(F.col("tsr").cast("double"), depth.cast("double")) > 1 / 30.0, F.lit(False))
        rules += [
            Rule(somatic & (own > 0), 2, F.concat(F.lit("Somatic_Control_"), shown, F.lit("_ALT(-2)")), "ALTC"),
            Rule(somatic & (own > 0) & (share < 0.3), 3, F.concat(F.lit("Somatic_MAF<03_and_Control_"), shown, F.lit("_ALT(-3)")), "ALTCFR"),
            Rule(somatic & (own == 0) & low_quality, 3, "Somatic_Control>1/30_ALT(-3)", "ALTC"),
        ]
    rules.append(Rule(somatic & known & (depth < 10), 0, "", "DB"))
    if o.punish_control:
        rules.append(Rule(germline & (own < 0.3), 2, "Germline_ALT<0.3(-2)", "FRC"))
    original = annotation.contains("LQVSIG")
    rules.append(Rule((original | unclear) & known, 0, "", "DP"))
    if o.punish_control:
        rules.append(Rule(original & ~known, 2, "Original_LQVSIG(-2)", "ALTC"))
        rules.append(Rule(unclear & ~known, 2, "Unclear_no_known_SNP(-2)", "ALTC"))
    return rules


def final_rules(o: Options) -> list[Rule]:
    tvf, tvr, _, share = _tumour()
    alt, qual = tvf + tvr, F.col("qual")
    rules = [Rule(F.col("chrom").contains("Y") & (qual < 100), 3, "Y_mpileup_score<100(-3)", "YALT")]
    if not o.run_low_maf:
        raw = ((qual < 3) & ((_two(share) < 0.05) | (alt < 5))) | ((qual < 20) & ((tvf == 0) | (tvr == 0)) & (alt <= 3))
        rules.append(Rule(raw, 3, "raw_filter_punishment(-3)", "FRQ"))
    return rules


def no_control_evidence() -> dict[str, Column]:
    """Population databases that speak for a germline variant when there is no control."""
    in_1kg, in_dbsnp, _ = _known()
    first = F.substring_index("kgenomes", "&", 1)
    eur = F.transform(F.split(info_get(first, "EUR_AF"), ","), lambda x: x.try_cast("double"))
    return {
        "kgenomes": in_1kg & F.coalesce(F.exists(eur, lambda v: v > 0.01), F.lit(False)),
        "dbSNP": in_dbsnp & F.col("dbsnp").contains("COMMON=1") & ~F.col("dbsnp").contains(";CLN;"),
        "ExAC": known_germline("exac", "AF", 1.0),
        "EVS": known_germline("evs", "MAF", 1.0),
        "gnomAD_Exomes": known_germline("gnomad_exomes", "AF", 0.001),
        "gnomAD_Genomes": known_germline("gnomad_genomes", "AF", 0.001),
        "LocalControl_WGS": known_germline("local_control_wgs", "AF", 0.01),
        "LocalControl_WES": known_germline("local_control_wes", "AF", 0.01),
    }


def rules_for(o: Options, profile: str = "current") -> list[Rule]:
    if profile == "current":
        control = [] if o.no_control else control_rules(o)
        return [*bias_rules(o), *region_rules(), *tumour_rules(o), *control, *final_rules(o)]
    return legacy_rules(o, with_control=profile == "legacy")


def legacy_rules(o: Options, *, with_control: bool) -> list[Rule]:
    """The older rule set: known variants outside odd regions gain a point, no bias, VAF or raw-filter rules."""
    repeat, tandem = F.col("repeat_masker").rlike("Simple_repeat|Low_|Satellite"), _is("simple_tandemrepeats")
    lowest = min_mapability(F.col("mapability"))
    odd = (_is("segdup") & ~repeat & ~tandem) | _is("duke_excluded") | _is("dac_blacklist") | _is("hiseqdepth") | F.coalesce(lowest < 0.5, F.lit(False))
    in_1kg, in_dbsnp, _ = _known()
    tvf, tvr, _, share = _tumour()
    rules = [*region_rules(), Rule((in_1kg | in_dbsnp) & ~odd, -1, "SNP_known_noweirdregion(+1)")]
    rules += [r for r in tumour_rules(o) if r.tag != "FRQ"] + [Rule((tvf + tvr < 6) & (share < 0.1), 3, "ALT<6_and_MAF<=0.1(-3)", "FRQ")]
    if with_control:
        strict = Options(cutoff=o.cutoff, punish_control=True, new_pun=0, run_exome=o.run_exome)
        depth, _ = _control()
        rules += [r for r in control_rules(strict) if r.tag != "DPLOWC"] + [Rule(depth <= 5, 2, "Controlcoverage<=5(-2)", "DPLOWC")]
    return rules + [final_rules(o)[0]]


def reclassified(o: Options) -> Column:
    """The class after the evidence; later steps overwrite or extend earlier ones."""
    in_1kg, in_dbsnp, precious = _known()
    known = in_1kg | (in_dbsnp & ~precious)
    if o.no_control:
        found = reduce(lambda a, b: a | b, no_control_evidence().values())
        state = F.when(found, "SNP_support_germline").otherwise("somatic")
    else:
        annotation, tsr = F.col("annotation_control"), F.col("tsr")
        depth, own = _control()
        low_quality = (own > 0) | F.coalesce(F.try_divide(tsr.cast("double"), depth.cast("double")) > 1 / 30.0, F.lit(False))
        state = annotation
        somatic = F.when(known & (depth < 10), "lowCov_SNP_support_germline").when(known, "SNP_support_germline").when(low_quality, "LQVSIG").otherwise(state)
        state = F.when(annotation.contains("somatic"), somatic).otherwise(state)
        germline = F.concat(state, F.when(known, "_SNP_support").otherwise(""), F.when(depth <= 10, "_lowCov").otherwise(""))
        state = F.when(annotation.contains("germline"), germline).otherwise(state)
        state = F.when(annotation.contains("LQVSIG") & known, "SNP_support_germline").otherwise(state)
        unclear = F.when(known, "SNP_support_germline").when(tsr > 1, "LQVSIG").otherwise(state)
        state = F.when(annotation.contains("unclear"), unclear).otherwise(state)
    return F.concat(state, F.when(precious, "_precious").otherwise(""))


PARTS = ["_start", "_taken", "_said", "_tags"]


def _sums(rules: list[Rule]) -> tuple[Column, list[Column], list[Column]]:
    """Penalties, reasons and tags (in their order, null where they don't apply) of rules."""
    taken = reduce(add, [F.when(r.when, r.penalty).otherwise(0) for r in rules], F.lit(0))
    said = [F.when(r.when, r.reason if isinstance(r.reason, Column) else F.lit(r.reason)).otherwise("") for r in rules if isinstance(r.reason, Column) or r.reason]
    tags = [F.when(reduce(lambda a, b: a | b, [r.when for r in rules if r.tag == t]), F.lit(t)) for t in TAG_ORDER if any(r.tag == t for r in rules)]
    return taken, said, tags


def _raised(tags: list[Column]) -> Column:
    """The tags that apply.  Not by array_compact: a function with a lambda has all that goes into it, here every rule, interpreted."""
    return F.array_except(F.array(*tags).cast("array<string>"), F.array(F.lit(None).cast("string")))


def fixed_parts(df: DataFrame, options: Options | None = None, *, profile: str = "current") -> DataFrame:
    """``df`` with what all rules but those of bias say (``PARTS``), reclassification and id; `finished` makes scores of it, once or in several rounds."""
    o = options or Options()
    rules = rules_for(replace(o, round=0), profile)
    start = F.lit(10)
    if "confidence" in df.columns:
        start = F.when(F.col("confidence") > 10, F.col("confidence")).otherwise(start)
    taken, said, tags = _sums(rules)
    if o.no_control and profile == "current":
        said = [F.when(c, F.lit(f"{n}(NoControl)")).otherwise("") for n, c in no_control_evidence().items() if n != "kgenomes"] + said
    dbsnp_id = info_get(F.substring_index("dbsnp", "&", 1), "ID")
    kept_id = F.col("id") if "id" in df.columns else F.lit(".")
    return df.withColumns(
        {
            "_start": start, "_taken": taken, "_said": F.array(*said), "_tags": _raised(tags),
            "reclassification": reclassified(o if profile == "current" else Options(no_control=profile == "legacy_no_control")),
            "id": F.when(F.col("dbsnp").contains("MATCH=exact") & dbsnp_id.isNotNull(), dbsnp_id).otherwise(kept_id),
        }
    )


def finished(parts: DataFrame, options: Options | None = None, *, tags: str | None = None) -> DataFrame:
    """Rows of `fixed_parts` with confidence (bigint), penalties and filter, the round's bias flags added in; ``tags``: a column for all tags of the rules that apply."""
    o = options or Options()
    taken, said, own_tags = _sums(bias_rules(o))
    score = F.greatest(F.least(F.col("_start") - F.col("_taken") - taken, F.lit(10)), F.lit(1)).cast("bigint")
    # evidence without a control comes first, then bias, then all others
    n_first = len(no_control_evidence()) - 1 if o.no_control else 0
    reasons = F.concat(F.array_join(F.slice("_said", 1, n_first), ""), *said, F.array_join(F.slice("_said", n_first + 1, 1 << 20), ""))
    before = F.coalesce("filter", F.lit(".")) if "filter" in parts.columns else F.lit(".")
    own = F.when(before.startswith("."), F.array().cast("array<string>")).otherwise(F.split(before, ";"))
    scored = parts.withColumns({"confidence": score, "penalties": F.when(reasons == "", ".").otherwise(reasons)})
    raised = F.concat("_tags", _raised(own_tags))
    all_tags = F.concat(own, raised)
    scored = scored.withColumn(tags, raised) if tags else scored
    return scored.withColumn("filter", F.when(F.col("confidence") > 7, "PASS").otherwise(F.array_join(F.array_distinct(all_tags), ";")))


def confidence_score(df: DataFrame, options: Options | None = None, *, profile: str = "current", tags: str | None = None) -> DataFrame:
    """``df`` with confidence (bigint), penalties, reclassification, filter and id updated or added.

    ``tags``: a column more, with the tags of all rules that apply, whatever the filter cell said before.

    ``profile``: ``current``, ``legacy`` or ``legacy_no_control``.  A confidence above 10 that rows bring along is where
    the score starts.
    """
    o = options or Options()
    current = profile == "current"
    return finished(fixed_parts(df, o, profile=profile), o if current else replace(o, round=0, no_control=False), tags=tags).drop(*PARTS)


def high_confidence_somatic(df: DataFrame, *, no_control: bool = False) -> DataFrame:
    if no_control:
        return df.where((F.col("confidence") > 7) & F.col("reclassification").contains("somatic"))
    return df.where((F.col("confidence") > 7) & (F.col("annotation_control") == "somatic") & ~F.col("reclassification").contains("lowCov_SNP_support_germline"))


def genotype_status(df: DataFrame, *, mode: str = "ported") -> DataFrame:
    """Adds status (GERMLINE, UNCLEAR, SOMATIC) and control_genotype.

    ``ported``: calls whose annotation says somatic are UNCLEAR; ``original``: those whose annotation doesn't are.
    """
    annotation, state = F.col("annotation_control"), F.col("reclassification")
    low = state == "lowCov_SNP_support_germline"
    says = annotation.contains("somatic") if mode == "ported" else ~annotation.contains("somatic")
    status = F.when(annotation.contains("germline") & ~low, "GERMLINE").when(low | says, "UNCLEAR").otherwise("SOMATIC")
    share = _two(_control()[1])
    genotype = F.when(status == "GERMLINE", F.when(share >= 0.75, "1/1").otherwise("0/1")).when(
        status == "UNCLEAR", F.when(share >= 0.75, "1/1").when(share >= 0.3, "0/1").otherwise("0/0")
    ).otherwise("0/0")
    return df.withColumns({"status": status, "control_genotype": genotype})


__all__ = ["Options", "Rule", "confidence_score", "finished", "fixed_parts", "genotype_status", "has_flag", "high_confidence_somatic", "reclassified", "rules_for"]
