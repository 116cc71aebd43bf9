"""Row filters on variant tables.  All are single projections or filters; only de-duplication and medians shuffle."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.functions.fields import af_from_1kg, chrom_rank, info_get, is_valid, once, seq_context_disrupts, vaf


def split_snv_indel(df: DataFrame, *, info: str = "info") -> tuple[DataFrame, DataFrame]:
    """Rows whose INFO doesn't begin with INDEL, and those whose does."""
    indel = F.coalesce(F.col(info).startswith("INDEL"), F.lit(False))
    return df.where(~indel), df.where(indel)


def passes_raw_filter(*, min_vaf: float = 0.05, min_vac: int = 5, min_vac_ps: int = 3, indel: Column | None = None) -> Column:
    """Whether a raw call stays: support, quality and the strand-biased motifs around it.

    Reads trf, trr, tvf, tvr, qual, ref and sequence_context (``left,right``).
    """
    indel = F.lit(False) if indel is None else indel
    trf, trr, tvf, tvr, qual = (F.col(c) for c in ("trf", "trr", "tvf", "tvr", "qual"))
    alt = tvf + tvr
    zeros = reduce(lambda a, b: a + b, [(c == 0).cast("int") for c in (trf, trr, tvf, tvr)])
    weak = ((tvf == 0) & (tvr == 1)) | ((tvf == 1) & (tvr == 0)) | (zeros >= 3) | (trf + trr + alt < 4)
    one_strand = (tvf == 0) | (tvr == 0)
    low_snv = ((qual < 3) & ((F.round(vaf(trf, trr, tvf, tvr), 2) < min_vaf) | (alt < min_vac))) | ((qual < 20) & one_strand & (alt <= min_vac_ps))
    low_indel = (qual < 30) | ((qual < 70) & one_strand & (alt <= 3))
    sides = F.split("sequence_context", ",")
    left = F.when(indel, F.concat(F.get(sides, 0), F.col("ref"))).otherwise(F.get(sides, 0))
    right = F.when(indel, F.concat(F.col("ref"), F.get(sides, 1))).otherwise(F.get(sides, 1))
    forward = (tvr < 2) & left.rlike("GG..GG|GGC") & (tvr != 1) & (tvf != 2)
    reverse = (tvf < 2) & right.rlike("CC..CC|GCC") & (tvf != 1) & (tvr != 2)
    return ~(weak | F.when(indel, low_indel).otherwise(low_snv) | forward | reverse)


def raw_snv_filter(df: DataFrame, **limits) -> DataFrame:
    return df.where(passes_raw_filter(**limits))


def _number(value: str) -> float:
    return float(value) if "." in value else int(value)


def filter_by_criteria(df: DataFrame, triples: list[tuple[str, str, str]], *, faithful: bool = True) -> DataFrame:
    """Drop rows for which any triple (column, keys, criteria) holds in all of its parts.

    A criterion is ``x+`` (a value above x), ``x-`` (below), ``exist`` or ``nonexist`` of the key in the same place.
    A cell of ``.`` never counts.  ``faithful``: a numeric criterion looks at the values of all keys of its triple and
    never at a bare cell (key ``.``); otherwise at its own key, or the bare cell.
    """

    def named(cell: Column, key: str) -> Column:
        return F.exists(F.split(cell, ";"), lambda x: F.substring_index(x, "=", 1) == key)

    def beyond(criterion: str):
        limit = _number(criterion[:-1])
        if criterion[-1] == "+":
            return lambda v: F.coalesce(v.try_cast("double") > limit, F.lit(False))
        return lambda v: F.coalesce(v.try_cast("double") < limit, F.lit(False))

    def values(cell: Column, keys: list[str]) -> Column:
        pairs = F.filter(F.split(cell, ";"), lambda x: F.substring_index(x, "=", 1).isin(keys) & x.contains("="))
        return F.flatten(F.transform(pairs, lambda x: F.split(F.substring_index(x, "=", -1), ",")))

    def holds(column: str, keys: str, criteria: str) -> Column:
        cell, names, parts = F.col(column), keys.split(","), []
        for key, criterion in zip(names, criteria.split(",")):
            if criterion in ("exist", "nonexist"):
                there = cell != "." if key == "." else named(cell, key)
                parts.append(there if criterion == "exist" else ~there)
            elif key == "." and not faithful:
                parts.append(beyond(criterion)(cell))
            else:
                parts.append(F.exists(values(cell, names if faithful else [key]), beyond(criterion)))
        return (cell != ".") & reduce(and_, parts)

    return df.where(~F.coalesce(reduce(or_, [holds(*t) for t in triples]), F.lit(False)))


def condition(spec: tuple) -> Column:
    """One condition (column, operation, parameter) as a Column.

    Operations: ``=`` ``!=`` on text; ``==`` ``>`` ``<`` ``<>`` ``>=`` ``<=`` on numbers (other cells: false); ``in`` a
    list; ``ins``: any item of a list within the cell; ``split``: (separator, (index, operation, parameter)) on a part;
    ``af``: (population, operation, value) on a 1000-genomes cell; ``seqcontext`` on (base, context) columns.
    """
    name, operation, parameter = spec
    if operation == "seqcontext":
        return seq_context_disrupts(F.col(name[0]), F.col(name[1]), parameter)
    return _applied(F.col(name), operation, parameter)


def _applied(cell: Column, operation: str, parameter) -> Column:
    if operation == "split":
        separator, (index, inner, value) = parameter
        return _applied(F.get(F.split(cell, f"\\Q{separator}\\E"), index), inner, value)
    if operation == "af":
        population, inner, value = parameter
        return _applied(af_from_1kg(cell, population).cast("string"), inner, value)
    if operation in ("=", "!="):
        return cell.cast("string") == str(parameter) if operation == "=" else cell.cast("string") != str(parameter)
    if operation == "in":
        return cell.isin(list(parameter))
    if operation == "ins":
        return reduce(or_, [cell.contains(item) for item in parameter])
    number, value = cell.cast("string").try_cast("double"), float(parameter)
    compared = {"==": number == value, ">": number > value, "<": number < value, "<>": number != value, ">=": number >= value, "<=": number <= value}
    compared |= {"=>": compared[">="], "=<": compared["<="]}
    return F.coalesce(compared[operation], F.lit(False))


def dnf(conditions: list[list[tuple]]) -> Column:
    """Inner lists are ANDed, the outer list is ORed."""
    return reduce(or_, [reduce(and_, [condition(c) for c in group]) for group in conditions])


def table_extract(df: DataFrame, conditions: list[list[tuple]], *, dedupe: bool = True) -> DataFrame:
    kept = df.where(dnf(conditions))
    return kept.dropDuplicates() if dedupe else kept


def count_by_conditions(df: DataFrame, named: dict[str, list[list[tuple]]], *, by: str | None = None) -> DataFrame:
    """A count for each named condition, in one scan."""
    counts = [F.count_if(dnf(c)).alias(name) for name, c in named.items()]
    return (df.groupBy(by) if by else df.groupBy()).agg(*counts)


def condition_vector(df: DataFrame, key: str, conditions: list[list[tuple]], *, order: list[str]) -> DataFrame:
    """1 or 0 for each value of ``key``: what the row that is last in ``order`` says."""
    flag = F.coalesce(dnf(conditions), F.lit(False)).cast("bigint")
    return df.groupBy(key).agg(F.max_by(flag, F.struct(*order)).alias("holds"))


def extraction_flags(*, nc_rna: bool = True, synonymous: bool = False) -> dict[str, Column]:
    """Predicate of each extraction class (see `extract_classes`)."""
    annotation, reclassified = F.col("annotation_control"), F.coalesce("reclassification", F.lit(""))
    function, exonic = F.coalesce("annovar_function", F.lit("")), F.coalesce("exonic_classification", F.lit(""))
    somatic = F.when(annotation.isNotNull(), annotation == "somatic").otherwise(reclassified.contains("somatic"))
    somatic = somatic & ~reclassified.contains("lowCov_SNP_support_germline")
    coding = exonic.rlike("nonsynonymous|stopgain|stoploss") | function.contains("splicing")
    functional = ~function.contains("ncRNA") & coding
    germline = F.when(annotation.isNotNull(), annotation == "germline").otherwise(reclassified.contains("SNP_support_germline"))
    flags = {"somatic": somatic, "somatic_functional": somatic & functional, "germline_functional": germline & functional}
    if nc_rna:
        flags["somatic_ncrna"] = somatic & function.rlike("ncRNA_exonic|ncRNA_splicing")
    if synonymous:
        flags["somatic_synonymous"] = somatic & exonic.startswith("synonymous")
    return flags


def extract_classes(df: DataFrame, *, min_conf: int = 8, nc_rna: bool = True, synonymous: bool = False) -> DataFrame:
    """Each row once for each extraction class it belongs to (column ``class``), in one pass.

    Classes: somatic, somatic_functional, germline_functional, and where asked for somatic_ncrna, somatic_synonymous.
    """
    flags = extraction_flags(nc_rna=nc_rna, synonymous=synonymous)
    classes = F.array_compact(F.array(*[F.when(flag, F.lit(name)) for name, flag in flags.items()]))
    return df.where(F.col("confidence") >= min_conf).withColumn("class", F.explode(classes))


def extract_class(df: DataFrame, name: str, *, min_conf: int = 8, **asked: bool) -> DataFrame:
    """The rows of one class of `extract_classes`: a filter that Spark applies before what the rows carry along is made."""
    return df.where((F.col("confidence") >= min_conf) & extraction_flags(**asked)[name]).withColumn("class", F.lit(name))


#: Older presets as conditions on the same columns.
PRESETS = {
    "somatic": lambda conf: [[("confidence", ">=", conf), ("annotation_control", "=", "somatic")]],
    "coding": lambda conf: [
        [("confidence", ">=", conf), ("annotation_control", "=", "somatic"), ("exonic_classification", "ins", ["nonsynonymous", "stopgain", "stoploss"])],
        [("confidence", ">=", conf), ("annotation_control", "=", "somatic"), ("annovar_function", "ins", ["splicing"])],
    ],
    "germline": lambda conf: [[("confidence", ">=", conf), ("annotation_control", "=", "germline")]],
}


def extract_preset(df: DataFrame, preset: str, conf: int = 8) -> DataFrame:
    return table_extract(df, PRESETS[preset](conf), dedupe=False)


def median_of(values: Column) -> Column:
    """Median of an array of numbers, nulls left out; null for an empty one."""
    return _middle(F.sort_array(F.array_compact(values)))


def _middle(ordered: Column) -> Column:
    n = F.size(ordered)
    return F.when(n > 0, (F.get(ordered, ((n - 1) / 2).cast("int")) + F.get(ordered, (n / 2).cast("int"))) / 2.0)


def median_alt_bq_filter(df: DataFrame, threshold: float = 20, *, alt: str = "bq_alt") -> DataFrame:
    """Rows whose median base quality of the variant is at least ``threshold`` (negative: all)."""
    if threshold < 0:
        return df
    ordered = once(df, {"_ordered": F.sort_array(F.array_compact(alt))})  # sorted once a row, whatever is asked of it
    return ordered.where(_middle(F.col("_ordered")) >= threshold).drop("_ordered")


def exclude_chromosomes(df: DataFrame, clinical: DataFrame, *, excluded: dict[str, list[str]] | None = None) -> DataFrame:
    """Drop the chromosomes that a patient's sex excludes (female: Y).  ``clinical``: pid, gender; a row a patient.

    Patients without a clinical row keep everything.  Spark broadcasts the clinical side when it is small.
    """
    excluded = excluded or {"f": ["Y"], "female": ["Y"]}
    gone = reduce(or_, [(F.lower("gender") == sex) & F.regexp_replace("chrom", "^chr", "").isin(names) for sex, names in excluded.items()])
    joined = df.join(clinical.select("pid", "gender"), "pid", "left")
    return joined.where(~F.coalesce(gone, F.lit(False))).drop("gender")


def genome_sort(df: DataFrame) -> DataFrame:
    """Chromosomes 1 to 22, X, Y, then position.  For sinks: it deals the whole table anew by ranges."""
    return df.orderBy(chrom_rank(F.col("chrom")), "pos", "ref", "alt")


def known_germline(cell: str, key: str, limit: float) -> Column:
    """Whether any value of ``key`` in a valid cell is above ``limit``."""
    values = F.transform(F.split(info_get(F.col(cell), key), ","), lambda x: x.try_cast("double"))
    return is_valid(F.col(cell)) & F.coalesce(F.exists(values, lambda v: v > limit), F.lit(False))
