"""Readers of wide variant tables, tracks, base-quality lists and small dimensions; all lazy, all typed once on load."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.operators.intervals import Track

#: Column names by which headers are found: the table's name and a pattern for the header's (the last match wins).
ALIASES = {
    "chrom": r"^#?CHROM$", "pos": r"^POS$", "id": r"^ID$", "ref": r"^REF$", "alt": r"^ALT$", "qual": r"^QUAL$", "filter": r"^FILTER$", "info": r"^INFO$",
    "format": r"^FORMAT$", "info_control": r"^INFO_control", "annotation_control": r"^ANNOTATION_control", "sequence_context": r"^SEQUENCE_CONTEXT$",
    "confidence": r"^CONFIDENCE$", "reclassification": r"^RECLASSIFICATION$", "mapability": r"^MAPABILITY$", "repeat_masker": r"REPEAT_MASKER",
    "dbsnp": r"^DBSNP", "kgenomes": r"^1K_GENOMES", "annovar_function": r"^ANNOVAR_FUNCTION", "exonic_classification": r"^EXONIC_CLASSIFICATION", "gene": r"^GENE$",
}
#: Columns that are numbers.
TYPES = {"pos": "bigint", "qual": "double", "confidence": "bigint"}


def headers(lines: DataFrame, patterns: dict[str, str]) -> DataFrame:
    """A row for each file of ``lines`` (file, value): names of its ``#CHROM`` line, and place, a map from column to position.

    Of several names that a pattern fits the last counts.  The column behind FORMAT is the sample's; other names without a
    pattern are columns of their own, in lower case.
    """
    found = lines.where(F.col("value").startswith("#CHROM")).groupBy("file").agg(F.min("value").alias("header"))
    names = F.transform(F.split("header", "\t"), lambda n: F.trim(n))

    def places(names: Column) -> Column:
        formats = F.array_position(names, "FORMAT")
        known = [F.struct(F.lit(c).alias("column"), F.array_max(F.transform(names, lambda n, k: F.when(n.rlike(p), k))).alias("k")) for c, p in patterns.items()]  # noqa: B023
        any_pattern = "|".join(f"(?:{p})" for p in patterns.values())
        own = F.transform(names, lambda n, k: F.struct(F.when((formats > 0) & (k == formats), "sample").when(~n.rlike(any_pattern), F.lower(F.regexp_replace(F.ltrim(n, F.lit("#")), r"\W+", "_"))).alias("column"), k.alias("k")))
        pairs = F.filter(F.concat(F.array(*known), own), lambda x: x["column"].isNotNull() & x["k"].isNotNull())
        renamed = F.transform(pairs, lambda x: F.struct(F.when(x["column"] == "pid", "pid_1").otherwise(x["column"]).alias("column"), x["k"].alias("k")))
        # of one name the last
        return F.aggregate(renamed, F.create_map().cast("map<string,int>"), lambda m, x: F.map_concat(F.map_filter(m, lambda c, _: c != x["column"]), F.create_map(x["column"], x["k"])))

    return found.select("file", "header", F.element_at(F.transform(F.array(names), places), 1).alias("place"))


def read_variants(
    spark: SparkSession, paths: str | list[str], *, aliases: dict[str, str] | None = None, names: list[str] | None = None, pid: Column | None = None, columns: list[str] | None = None, rebalance: bool | None = None
) -> DataFrame:
    """Wide variant text files of many patients, plain or gzip, as one table; each file may have columns of its own.

    Lines of ``##`` and headers are skipped.  Columns are found by name in the header of the line's own file (``aliases``: more
    patterns, or others for the same names); a column that a file lacks is null in its rows.  The table has the columns
    that any file has (``columns``: just these, so that no header is looked at before); ``names``: a header for files that have
    none.  A column named PID becomes pid_1.  ``pid``: by default the file's name up to the first dot.  ``rebalance``: deal the
    lines out evenly; by default where a file is compressed as a whole (``.gz``), as one task reads each of these.
    """
    patterns = ALIASES | (aliases or {})
    text = spark.read.text(paths)
    if rebalance is None:
        rebalance = any(f.endswith(".gz") for f in text.inputFiles())
    lines = text.select("value", F.col("_metadata.file_path").alias("file"), "_metadata.file_name")
    if names:
        own = lines.select("file").distinct().select("file", F.lit("\t".join(names)).alias("value"))
        places = headers(own, patterns)
    else:
        places = headers(lines, patterns)
    if columns is None:  # a table's schema: a name for each column that any file has
        columns = sorted(r["column"] for r in places.select(F.explode(F.map_keys("place")).alias("column")).distinct().collect())
        if not columns:
            raise ValueError(f"no #CHROM line in {paths}")
        columns = [c for c in [*patterns, "sample"] if c in columns] + [c for c in columns if c not in patterns and c != "sample"]
    rows = lines.where(~F.col("value").startswith("#") & (F.col("value") != ""))
    rows = (rows.hint("rebalance") if rebalance else rows).join(places.select("file", "place"), "file")
    cells = F.split("value", "\t", -1)
    pid = F.substring_index("file_name", ".", 1) if pid is None else pid
    cell = lambda c: F.get(F.col("cells"), F.try_element_at("place", F.lit(c))).try_cast(TYPES.get(c, "string"))
    return rows.withColumn("cells", cells).select(pid.alias("pid"), *[(F.upper(cell(c)) if c in ("ref", "alt") else cell(c)).alias(c) for c in columns])


def read_intervals(spark: SparkSession, path: str, *, value_cols: dict[str, str] | None = None) -> DataFrame:
    """A tab-separated track: chrom, start0, end0 and further columns (``value_cols``: name and type; default name)."""
    more = value_cols or {"name": "string"}
    schema = ", ".join(["chrom string", "start0 bigint", "end0 bigint", *(f"`{c}` {t}" for c, t in more.items())])
    return spark.read.csv(path, sep="\t", schema=schema, comment="#")


@dataclass(frozen=True)
class TrackSpec:
    """``path:columns:level:options`` in parts; columns are names, or numbers counted from 0 as the file has them."""

    path: str
    columns: tuple[str, ...] = ()
    level: int = 2
    most: int | None = None
    end_offset: int = 0
    options: tuple[str, ...] = ()


#: Scheme and authority (with a port, it may be) belong to the path; so does all up to the next colon.
SPEC = re.compile(r"^(?P<path>(?:[A-Za-z][\w+.-]*:/{2,3}[^/:]*(?::\d+(?=/))?)?[^:]*)(?::(?P<columns>[^:]*))?(?::(?P<level>[^:]*))?(?::(?P<options>.*))?$")


def parse_track_spec(spec: str) -> TrackSpec:
    """A track's description; quotation marks around it are dropped.

    Options: ``--maxNrOfMatches=n`` bounds the hits, ``-aEndOffset=n`` moves intervals' ends; others are kept as they are.
    """
    found = SPEC.match(spec.strip().strip("\"'"))
    if not found or not found["path"]:
        raise ValueError(f"no track: {spec!r}")
    options = (found["options"] or "").split()
    values = {k: int(v) for k, _, v in (o.lstrip("-").partition("=") for o in options) if v.lstrip("-").isdigit()}
    columns = tuple(c for c in (found["columns"] or "").split(",") if c)
    return TrackSpec(found["path"], columns, int(found["level"] or 2), values.get("maxNrOfMatches"), values.get("aEndOffset", 0), tuple(options))


def read_track(spark: SparkSession, spec: str | TrackSpec) -> Track:
    """The track that a spec tells: its file, and what a hit reports.

    Names of columns are those of the file's header (a first line with ``#``), else chrom, start, end, name, score, then c5 and so on.
    """
    spec = parse_track_spec(spec) if isinstance(spec, str) else spec
    head = spark.read.text(spec.path).head(1)
    names = ["chrom", "start0", "end0", "name", "score"]
    if head and head[0]["value"].startswith("#"):
        own = head[0]["value"].lstrip("#").split("\t")
        names = names[:4] + [re.sub(r"\W+", "_", n) for n in own[4:]]
    numbers = [int(c) for c in spec.columns if c.isdigit()]
    names += [f"c{k}" for k in range(len(names), max([4, *numbers]) + 1)]
    columns = tuple(names[int(c)] if c.isdigit() else c for c in spec.columns)
    last = max([3, *[names.index(c) for c in columns]])
    rows = read_intervals(spark, spec.path, value_cols=dict.fromkeys(names[3 : last + 1], "string"))
    return Track(rows.withColumn("end0", F.col("end0") + spec.end_offset), columns, spec.level, spec.most)


def read_track_spec(spark: SparkSession, spec: str) -> DataFrame:
    """The intervals of `read_track`."""
    return read_track(spark, spec).rows


def read_base_quality_lists(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Lines ``chrom, position, q,q,q;VAF`` as pid, chrom, pos, values (array<bigint>), vaf."""
    lines = spark.read.text(paths).select("value", "_metadata.file_name").where(F.col("value") != "")
    cells = F.split("value", "\t")
    parts = F.split(F.get(cells, 2), ";")
    return lines.select(
        F.substring_index("file_name", ".", 1).alias("pid"), F.get(cells, 0).alias("chrom"), F.get(cells, 1).try_cast("bigint").alias("pos"),
        F.transform(F.split(F.get(parts, 0), ","), lambda q: q.try_cast("bigint")).alias("values"), F.get(parts, 1).try_cast("double").alias("vaf"),
    )


def read_chrom_lengths(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", schema="chrom string, length bigint", comment="#")


def read_clinical(spark: SparkSession, path: str) -> DataFrame:
    """pid, decoded, gender, age, subgroup; a header line is skipped."""
    schema = "pid string, decoded string, gender string, age string, subgroup string"
    return spark.read.csv(path, sep="\t", schema=schema, header=True, enforceSchema=True)
