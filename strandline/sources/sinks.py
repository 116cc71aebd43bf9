"""Writers: standard and consortium variant rows, quality rows, one output for each extraction class.

The functions that make lines return DataFrames, so that they can be checked and written anywhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.functions.fields import chrom_rank, vaf
from strandline.operators.confidence import TAG_ORDER, genotype_status
from strandline.operators.joins import union_variants


def _pairs(cell: Column, suffix: str = "") -> Column:
    """``k=v;flag`` as an array of (key, value); a flag has a null value; of repeated keys the last stays."""
    parts = F.filter(F.split(F.coalesce(cell, F.lit("")), ";"), lambda x: (x != "") & (x != "."))
    return F.transform(
        parts, lambda x: F.struct(F.concat(F.substring_index(x, "=", 1), F.lit(suffix)).alias("key"), F.when(x.contains("="), F.substring(x, F.instr(x, "=") + 1, 1 << 30)).alias("value"))
    )


def standard_info(*, free: dict[str, str], keys: list[str] | None = None, empty: bool = False) -> Column:
    """New INFO: keys of info, those of info_control with ``_ctrl``, and columns (``free``: column and its key), sorted by key.

    ``keys``: only these (None: all).  Of columns, ``.`` or null gives nothing, or (``empty``) ``KEY=.``.
    """
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("."))
    own = F.concat(
        _pairs(F.col("info")), _pairs(F.col("info_control"), "_ctrl"),
        *[F.when(F.lit(empty) | (shown(c) != "."), F.array(F.struct(F.lit(k).alias("key"), shown(c).alias("value")))).otherwise(F.array().cast("array<struct<key:string,value:string>>")) for c, k in free.items()],
    )
    if keys is not None:
        own = F.filter(own, lambda x: x["key"].isin(keys))
    cells = F.transform(own, lambda x: F.concat(x["key"], F.coalesce(F.concat(F.lit("="), x["value"]), F.lit(""))))
    return F.coalesce(F.nullif(F.array_join(F.array_sort(F.array_distinct(cells)), ";"), F.lit("")), F.lit("."))


def standard_variants(df: DataFrame, *, free: dict[str, str], keys: list[str] | None = None) -> DataFrame:
    """pid and line: the tab-separated standard row of each variant."""
    columns = ["chrom", "pos", "id", "ref", "alt", "qual", "filter"]
    cells = [F.coalesce(F.col(c).cast("string"), F.lit(".")) for c in columns]
    return df.select("pid", F.concat_ws("\t", *cells, standard_info(free=free, keys=keys)).alias("line"))


def used_metadata_keys(df: DataFrame, *by: str) -> DataFrame:
    """Distinct (kind, key) of INFO, INFO_control (``_ctrl``), FORMAT and FILTER over all rows, or over those of each ``by``."""
    keys = lambda c, s="": F.transform(_pairs(F.col(c), s), lambda x: x["key"])
    split = lambda c, by: F.filter(F.split(F.coalesce(F.col(c), F.lit("")), by), lambda x: (x != "") & (x != "."))
    kinds = {"INFO": F.concat(keys("info"), keys("info_control", "_ctrl")), "FORMAT": split("format", ":"), "FILTER": split("filter", ";")}

    def of(kind: str, found: Column) -> Column:
        return F.transform(F.array_distinct(found), lambda x: F.struct(F.lit(kind).alias("kind"), x.alias("key")))

    each = F.concat(*[of(kind, found) for kind, found in kinds.items()])
    return df.select(*by, F.explode(each).alias("x")).select(*by, "x.*").distinct()


#: What a file's first lines are about, in the order in which they stand there.
SECTIONS = ("##fileformat", "INFO", "FILTER", "FORMAT", "copied", "#CHROM", "rows")
STANDARD = ["CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT"]


def configured_keys(meta: dict) -> list[tuple]:
    """(kind, key, name in the file, definition) of a configuration: for INFO, FILTER and FORMAT a dict of keys with number, type, description and maybe new_info_id.

    Keys that begin with ``__`` are left out.
    """
    found = []
    for kind in ("INFO", "FILTER", "FORMAT"):
        for key, of in meta.get(kind, {}).items():
            if not key.startswith("__"):
                name = of.get("new_info_id", key)
                values = "" if kind == "FILTER" else f"Number={of['number']},Type={of['type']},"
                found.append((kind, key, name, f'##{kind}=<ID={name},{values}Description="{of["description"]}">'))
    return found


def standard_file(df: DataFrame, meta: dict, *, sample: str = "sample", copied: tuple[str, ...] = ()) -> DataFrame:
    """The lines of a standard file for each patient: pid, section, chrom_rank, at (what orders a section) and line.

    ``df``: pid, chrom, pos, id, ref, alt, qual, filter, info, info_control, format, and ``sample`` with the cell of the one
    sample; of ``meta`` (see `configured_keys`) the keys that a patient's rows use are defined and kept, and columns that it
    renames (new_info_id) go to INFO, with ``.`` as it is.  ``copied``: lines for references and contigs.  The sample's column is named
    as the patient.
    """
    keys = configured_keys(meta)
    free = {key: name for kind, key, name, _ in keys if kind == "INFO" and "new_info_id" in meta["INFO"][key]}
    columns = {c.lower(): c for c in df.columns}
    if missing := [c for c in free if c.lower() not in columns]:
        raise ValueError(f"no column for {missing}")
    config = F.broadcast(df.sparkSession.createDataFrame(keys, "kind string, key string, name string, line string"))  # as many rows as were written by hand
    used = used_metadata_keys(df, "pid")
    patients = df.select("pid").distinct()
    always = patients.select("pid", F.explode(F.array(*[F.struct(F.lit("INFO").alias("kind"), F.lit(c).alias("key")) for c in free])).alias("x")).select("pid", "x.*") if free else used.limit(0)
    place = lambda name: F.lit(SECTIONS.index(name))
    none = F.lit(0).cast("int").alias("chrom_rank")
    section = F.element_at(F.create_map(*[x for k in ("INFO", "FILTER", "FORMAT") for x in (F.lit(k), place(k))]), F.col("kind"))
    defined = used.union(always).distinct().join(config, ["kind", "key"]).select("pid", section.alias("section"), none, F.col("key").alias("at"), "line")
    fixed = [("##fileformat", "0", F.lit("##fileformat=VCFv4.2")), *[("copied", f"{k:06d}", F.lit(line)) for k, line in enumerate(copied)], ("#CHROM", "0", F.concat(F.lit("#" + "\t".join([*STANDARD, ""])), F.col("pid")))]
    each = F.array(*[F.struct(place(n).alias("section"), F.lit(0).alias("chrom_rank"), F.lit(at).alias("at"), line.alias("line")) for n, at, line in fixed])
    head = patients.select("pid", F.explode(each).alias("x")).select("pid", "x.*").union(defined)
    cells = [F.coalesce(F.col(c).cast("string"), F.lit(".")) for c in ("chrom", "pos", "id", "ref", "alt", "qual", "filter")]
    info = standard_info(free={columns[c.lower()]: k for c, k in free.items()}, keys=[name for kind, _, name, _ in keys if kind == "INFO"], empty=True)
    line = F.concat_ws("\t", *cells, info, *[F.coalesce(F.col(c).cast("string"), F.lit(".")) for c in ("format", sample)])
    body = df.select("pid", place("rows").alias("section"), chrom_rank(F.col("chrom")).alias("chrom_rank"), F.lpad(F.col("pos").cast("string"), 12, "0").alias("at"), line.alias("line"))
    return head.unionByName(body)


def write_standard_files(df: DataFrame, path: str, meta: dict, **options) -> None:
    """A folder for each patient whose parts, one after the other, are its standard file: header lines, then rows by place.

    One range sort over all patients: a large patient is written by many tasks, and no task waits for a whole one.
    """
    order = ["pid", "section", "chrom_rank", "at", "line"]
    ordered = standard_file(df, meta, **options).repartitionByRange(*order).sortWithinPartitions(*order)
    ordered.select("pid", "line").write.partitionBy("pid").text(path)


def pancan_variants(df: DataFrame) -> DataFrame:
    """pid and line: the consortium row of each scored variant (of `confidence_score`), with both genotypes.

    Tags are those of the rules that apply: of the column ``tags``, or where there is none, those in the filter cell.
    """
    status = genotype_status(df)
    own = F.col("tags") if "tags" in df.columns else F.filter(F.split("filter", ";"), lambda x: x.isin(TAG_ORDER))
    shown = F.when(F.col("filter") == "PASS", "PASS").otherwise(F.array_join(own, ";"))
    in_dbsnp = F.col("dbsnp").contains("MATCH=exact")
    names = F.array_compact(
        F.array(
            *[F.when(F.col("status") == s, s) for s in ("SOMATIC", "GERMLINE", "UNCLEAR")], F.lit("VT"), F.lit("AF"), F.lit("MQ"),
            F.when(in_dbsnp, "DB"), F.when(F.col("kgenomes").contains("MATCH=exact"), "1000G"),
        )
    )
    control, tumour = (F.array(*[F.col(c) for c in k]) for k in (("crf", "crr", "cvf", "cvr"), ("trf", "trr", "tvf", "tvr")))
    cell = lambda genotype, counts: F.concat_ws(":", genotype, F.aggregate(counts, F.lit(0).cast("bigint"), lambda a, x: a + x).cast("string"), F.array_join(counts.cast("array<string>"), ","))
    share = vaf(*[F.col(c) for c in ("trf", "trr", "tvf", "tvr")])
    line = F.concat_ws(
        "\t", "chrom", F.col("pos").cast("string"), F.when(in_dbsnp, F.concat_ws("_", "id", F.col("pos").cast("string"))).otherwise(F.lit(".")), "ref", "alt", F.lit("."),
        shown, F.array_join(names, ";"), F.lit("GT:DP:DP4"), cell(F.col("control_genotype"), control), cell(F.when(share >= 0.75, "1/1").otherwise("0/1"), tumour),
    )
    return status.select("pid", line.alias("line"))


def write_lines(lines: DataFrame, path: str) -> None:
    """Lines of every patient in a folder of its own."""
    lines.write.partitionBy("pid").text(path)


def write_standard_variants(df: DataFrame, path: str, *, free: dict[str, str], keys: list[str] | None = None) -> None:
    write_lines(standard_variants(df, free=free, keys=keys), path)


def write_pancan_variants(df: DataFrame, path: str) -> None:
    write_lines(pancan_variants(df), path)


def write_qc_json(qc: DataFrame, path: str) -> None:
    """A row a patient, as JSON."""
    qc.write.json(path)


def write_by_class(extracted: DataFrame, path: str) -> None:
    """One output for each patient and extraction class."""
    extracted.write.partitionBy("pid", "class").parquet(path)


__all__ = ["pancan_variants", "configured_keys", "standard_file", "standard_info", "standard_variants", "union_variants", "used_metadata_keys", "write_by_class", "write_lines", "write_pancan_variants", "write_qc_json", "write_standard_files", "write_standard_variants"]
