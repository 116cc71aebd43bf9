"""Variant operators on hand-made rows: both sides of thresholds, golden figures, properties."""

import itertools
import math
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandline import queries
from strandline.functions import fields
from strandline.operators import base_quality, bias, confidence, control, filters, joins, qc, reads, windows
from strandline.plans import fixtures, pipelines
from strandline.sources import sinks, variants
from strandline.storage import stored


def column(spark, expression, **values):
    row = spark.createDataFrame([tuple(values.values())], list(values)) if values else spark.range(1)
    return row.select(expression.alias("x")).first()["x"]


# --- fields -----------------------------------------------------------------------------------------------------


def test_info_cells(spark):
    cell = F.lit("DP=3;SOMATIC;AF=None;DP=7")
    assert column(spark, fields.info_get(cell, "DP")) == "7"
    assert column(spark, fields.info_get(cell, "AF")) == "0"
    assert column(spark, fields.info_get(cell, "SOMATIC")) is None and column(spark, fields.info_get(cell, "X")) is None
    assert column(spark, fields.has_flag(cell, "SOMATIC")) and not column(spark, fields.has_flag(cell, "SOM"))
    assert column(spark, fields.parse_counts(F.lit("DP4=1,2,x,4"), "DP4")) == [1, 2, None, 4]


@pytest.mark.parametrize(("k", "n"), [(0, 1), (0, 0), (3, 10), (40, 100), (5, 5), (700, 1500), (2, 256), (0, 3000), (64, 140), (65, 140), (66, 131), (200, 390), (1300, 2000), (65, 900)])
def test_binomial(spark, k, n):
    want = sum(math.comb(n, i) for i in range(k + 1)) / 2**n if n < 1000 else float(sum(math.comb(n, i) for i in range(k + 1)) * 10**30 // 2**n) / 1e30
    got = column(spark, fields.binom_cdf_half(F.col("k"), F.col("n")), k=k, n=n)
    assert math.isclose(got, want, rel_tol=1e-9, abs_tol=1e-25)


def test_binomial_of_billions(spark):
    p = fields.binom_cdf_half(F.col("k"), F.col("n"))
    assert math.isclose(column(spark, p, k=3_000_000_000, n=6_000_000_000), 0.5, rel_tol=1e-4)
    sd = math.sqrt(6e9) / 2
    assert math.isclose(column(spark, p, k=int(3e9 - 2 * sd), n=6_000_000_000), 0.5 * math.erfc(math.sqrt(2)), rel_tol=1e-3)


def test_very_small_probability(spark):
    got = column(spark, fields.binom_cdf_half(F.col("k"), F.col("n")), k=2, n=272)
    assert math.isclose(got, 4.89276584292767e-78, rel_tol=1e-9)


def test_alleles_and_context(spark):
    trimmed = column(spark, fields.right_trim_alleles(F.lit("TCAG"), F.array(F.lit("TTCAG"), F.lit("GCAG"))))
    assert tuple(trimmed) == ("T", ["TT", "G"], 3, "CAG")
    assert tuple(column(spark, fields.right_trim_alleles(F.lit("A"), F.array(F.lit("C"))))) == ("A", ["C"], 0, None)
    assert column(spark, fields.mutation_class(F.lit("A"), F.lit("G"))) == "TC" and column(spark, fields.mutation_class(F.lit("C"), F.lit("G"))) == "CG"
    assert column(spark, fields.exact_match_value(F.lit("MATCH=position;x&MATCH=exact;ID=1;rs5"))) == "rs5" and column(spark, fields.exact_match_value(F.lit("."))) == "."
    assert column(spark, fields.seq_context_disrupts(F.lit("G"), F.lit("AAC,TTT"), "CG")) and not column(spark, fields.seq_context_disrupts(F.lit("G"), F.lit("AAA,TTT"), "CG"))
    assert column(spark, fields.af_from_1kg(F.lit("EUR_AF=0.12;AF=0.3"))) == 0.12 and column(spark, fields.af_from_1kg(F.lit("AF=0.3"))) == 0.3
    assert column(spark, fields.vaf(*[F.lit(0)] * 4)) == 0.0
    twice = fields.reverse_complement_triplet(*[F.lit(x) for x in "ACGT"])
    assert tuple(column(spark, twice)) == ("A", "G", "C", "T")


# --- filters ----------------------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    ("counts", "qual", "context", "stays"),
    [
        ((10, 10, 5, 5), 50, "AAAAAAAAAA,AAAAAAAAAA", True),
        ((10, 10, 0, 1), 50, "AAAAAAAAAA,AAAAAAAAAA", False),
        ((0, 0, 0, 9), 50, "AAAAAAAAAA,AAAAAAAAAA", False),
        ((1, 1, 0, 2), 50, "AAAAAAAAAA,AAAAAAAAAA", True),
        ((1, 0, 0, 2), 50, "AAAAAAAAAA,AAAAAAAAAA", False),
        ((10, 10, 2, 2), 2, "AAAAAAAAAA,AAAAAAAAAA", False),
        ((10, 10, 2, 2), 3, "AAAAAAAAAA,AAAAAAAAAA", True),
        ((10, 10, 3, 0), 19, "AAAAAAAAAA,AAAAAAAAAA", False),
        ((10, 10, 3, 0), 20, "AAAAAAAAAA,AAAAAAAAAA", True),
        ((10, 10, 3, 0), 50, "AAAAAGGTTGG,AAAAAAAAAA", False),
        ((10, 10, 3, 0), 50, "AAAAAGGTTGA,AAAAAAAAAA", True),
        ((10, 10, 3, 0), 50, "AAAAAAAGGC,AAAAAAAAAA", False),
        ((10, 10, 2, 0), 50, "AAAAAAAGGC,AAAAAAAAAA", True),
        ((10, 10, 3, 1), 50, "AAAAAAAGGC,AAAAAAAAAA", True),
        ((10, 10, 0, 3), 50, "AAAAAAAAAA,AGCCAAAAAA", False),
        ((10, 10, 0, 2), 50, "AAAAAAAAAA,AGCCAAAAAA", True),
    ],
)
def test_raw_filter(spark, counts, qual, context, stays):
    df = spark.createDataFrame([(*counts, float(qual), context, "A")], "trf int, trr int, tvf int, tvr int, qual double, sequence_context string, ref string")
    assert filters.raw_snv_filter(df).count() == stays


def test_criteria(spark):
    df = spark.createDataFrame([("AF=0.5,0.01;X=1",), ("AF=0.001",), (".",), ("0.5",), ("COMMON=1",)], "cell string")
    left = lambda *t, **k: [r["cell"] for r in filters.filter_by_criteria(df, [("cell", *t)], **k).collect()]
    assert left("AF", "0.1+") == ["AF=0.001", ".", "0.5", "COMMON=1"]
    assert left("AF", "0.01-") == ["AF=0.5,0.01;X=1", ".", "0.5", "COMMON=1"]
    assert left("COMMON", "exist") == ["AF=0.5,0.01;X=1", "AF=0.001", ".", "0.5"]
    assert left("COMMON,AF", "nonexist,0.1+") == ["AF=0.001", ".", "0.5", "COMMON=1"]
    assert left(".", "0.1+") == ["AF=0.5,0.01;X=1", "AF=0.001", ".", "0.5", "COMMON=1"]  # a bare cell is never compared
    assert left(".", "0.1+", faithful=False) == ["AF=0.5,0.01;X=1", "AF=0.001", ".", "COMMON=1"]


def test_conditions(spark):
    df = spark.createDataFrame([(1, "5", "a;b"), (2, ".", "b"), (3, "7.5", "c;a"), (3, "7.5", "c;a")], "k int, n string, s string")
    kept = lambda c, **o: sorted(r["k"] for r in filters.table_extract(df, c, **o).collect())
    assert kept([[("n", ">", 5)]]) == [3] and kept([[("n", ">", 5)]], dedupe=False) == [3, 3]
    assert kept([[("n", ">=", 5)], [("s", "=", "b")]]) == [1, 2, 3]
    assert kept([[("s", "split", (";", (1, "=", "a")))]]) == [3] and kept([[("s", "ins", ["c", "x"])]]) == [3]
    assert kept([[("n", "=", "."), ("s", "!=", "x")]]) == [2] and kept([[("k", "in", [1, 2])]]) == [1, 2]


def test_extraction_classes(spark):
    schema = "confidence int, annotation_control string, reclassification string, annovar_function string, exonic_classification string, name string"
    rows = [
        (8, "somatic", "somatic", "exonic", "nonsynonymous SNV", "functional"), (7, "somatic", "somatic", "exonic", "nonsynonymous SNV", "low"),
        (9, "somatic", "lowCov_SNP_support_germline", "exonic", "stopgain", "germline after all"), (9, "multi_somatic", "x", "exonic", "stopgain", "several"),
        (9, None, "somatic", "ncRNA_exonic", ".", "without control"), (9, "germline", "germline", "splicing", ".", "germline"), (9, "somatic", "somatic", "exonic", "synonymous SNV", "silent"),
    ]
    out = filters.extract_classes(spark.createDataFrame(rows, schema), synonymous=True)
    assert {(r["name"], r["class"]) for r in out.collect()} == {
        ("functional", "somatic"), ("functional", "somatic_functional"), ("without control", "somatic"), ("without control", "somatic_ncrna"),
        ("germline", "germline_functional"), ("silent", "somatic"), ("silent", "somatic_synonymous"),
    }


def test_median_filter_and_chromosomes(spark):
    df = spark.createDataFrame([(1, [30, 10, 20]), (2, [10, 30]), (3, [19]), (4, [])], "k int, bq_alt array<int>")
    assert [r["k"] for r in filters.median_alt_bq_filter(df, 20).collect()] == [1, 2] and filters.median_alt_bq_filter(df, -1).count() == 4
    sites = spark.createDataFrame([("a", "Y"), ("a", "X"), ("b", "Y"), ("c", "Y")], "pid string, chrom string")
    clinical = spark.createDataFrame([("a", "F"), ("b", "m")], "pid string, gender string")
    assert sorted(map(tuple, filters.exclude_chromosomes(sites, clinical).select("pid", "chrom").collect())) == [("a", "X"), ("b", "Y"), ("c", "Y")]


# --- control ----------------------------------------------------------------------------------------------------


def test_pileup_strings(spark):
    rows = [("p", "1", 5, "A", "^~.,+2AGc-1T$G*", "IIII!I"), ("p", "1", 6, "C", ".+12ACGTACGTACGTt", "5#")]
    out = control.explode_pileup(spark.createDataFrame(rows, "pid string, chrom string, pos int, ref string, bases string, quals string"))
    assert [(r["pos"], r["base"], r["bq"]) for r in out.orderBy("pos", "idx").collect()] == [(5, "A", 40), (5, "a", 40), (5, "c", 40), (5, "G", 40), (5, "*", 0), (6, "C", 20), (6, "t", 2)]


@pytest.mark.parametrize(
    ("counts", "tumour", "qual", "want"),
    [
        ((30, 30, 3, 0, 0), (5, 5), 50, "germline"), ((30, 30, 2, 0, 0), (5, 5), 50, "somatic"), ((30, 30, 0, 0, 2), (5, 5), 50, "unclear"), ((30, 30, 0, 0, 1), (5, 5), 50, "somatic"),
        ((60, 60, 2, 2, 0), (5, 5), 19, "LQVCIG"), ((60, 60, 2, 2, 0), (5, 5), 20, "somatic"), ((60, 60, 0, 2, 0), (0, 5), 50, "LQVCIG"), ((60, 60, 2, 0, 0), (5, 1), 2, "LQVCIG"),
    ],
)
def test_control_classes(spark, counts, tumour, qual, want):
    names = ("rf", "rr", "vf", "vr", "other")
    values = dict(zip(names, map(F.lit, counts)))
    got = control.classify_control(**values, vf_all=F.lit(counts[2]), vr_all=F.lit(counts[3]), tvf=F.lit(tumour[0]), tvr=F.lit(tumour[1]), qual=F.lit(qual))
    assert column(spark, got) == want


def test_uncovered_and_multiallelic_candidates(spark):
    tumour = spark.createDataFrame([("p", "1", 5, "A", "G,T", 3, 3, 50.0), ("p", "1", 6, "A", "G", 3, 3, 50.0)], "pid string, chrom string, pos int, ref string, alt string, tvf int, tvr int, qual double")
    bases = spark.createDataFrame([("p", "1", 5, b, 30) for b in "AAAaG"], "pid string, chrom string, pos int, base string, bq int")
    got = {r["pos"]: r for r in control.compare_control(tumour, control.read_counts(bases)).collect()}
    assert got[5]["annotation_control"] == "multi_germline" and got[5]["dp5"] == [3, 1, 1, 0, 0] and got[5]["vaf_control"] == 0.2
    assert got[6]["annotation_control"] == "not_covered" and got[6]["dp5"] == [0] * 5


# --- joins ------------------------------------------------------------------------------------------------------


def test_genes_by_start_and_end(spark):
    df = spark.createDataFrame([("p", "1", 5, "A", "old"), ("p", "1", 5, "ACG", "old"), ("p", "1", 9, "A", "old"), ("p", "2", 5, None, "old")], "pid string, chrom string, pos bigint, ref string, gene string")
    genes = [("1", 5, 5, "exonic", "one"), ("1", 5, 7, "exonic", "long"), ("1", 5, 5, "intronic", "two"), ("2", 5, 5, "exonic", "three")]
    table = spark.createDataFrame([(*g, ".", "T") for g in genes], "chrom string, start bigint, end bigint, annovar_function string, gene string, exonic_classification string, annovar_transcripts string")
    found = {(r["chrom"], r["pos"], r["ref"]): r["gene"] for r in joins.annotate_genes(df, table).collect()}
    assert found == {("1", 5, "A"): "one", ("1", 5, "ACG"): "long", ("1", 9, "A"): None, ("2", 5, None): "three"}
    assert joins.annotate_genes(df, table).count() == 4


def test_interval_join_equals_a_plain_one(spark):
    rnd = random.Random(4)
    track = [(rnd.choice("12"), s := rnd.randrange(5000), s + rnd.choice([0, 1, 3, 900, 2500]), f"n{k}") for k in range(60)]
    spots = [("p", rnd.choice("123"), rnd.randrange(1, 6000)) for _ in range(300)]
    out = joins.annotate_intervals(spark.createDataFrame(spots, "pid string, chrom string, pos int"), spark.createDataFrame(track, "chrom string, start0 int, end0 int, name string"), "t")
    for r in out.collect():
        names = sorted(n for c, s, e, n in track if c == r["chrom"] and s < r["pos"] <= e)
        assert r["t"] == ("&".join(names) or ".")
    assert out.count() == 300


# --- reads ------------------------------------------------------------------------------------------------------

READ = "pid string, chrom string, pos int, pileup_idx int, qname string, base string, bq int, mq int, is_reverse boolean, is_read1 boolean, is_proper_pair boolean, nm int, query_pos int, read_len int, ref_id int, ref_start int, ref_end int, next_ref_id int, next_start int"


def read(k, name, base, bq=30, mq=40, reverse=False, first=True, paired=True, nm=0, place=None):
    return ("p", "1", 5, k, name, base, bq, mq, reverse, first, paired, nm, 10, 100, 1, place if place is not None else k * 10, 0, 1, 0)


CALL = "pid string, chrom string, pos int, ref string, alt string, trf bigint, trr bigint, tvf bigint, tvr bigint, annotation_control string, confidence bigint, reclassification string"


def corrected(spark, rows, counts=(5, 5, 5, 5), alt="G", evidence=("somatic", 1, "."), **limits):
    sites = spark.createDataFrame([("p", "1", 5, "A", alt, *counts, *evidence)], CALL)
    return reads.overlap_corrected_counts(sites, spark.createDataFrame(rows, READ), **limits).first()


def test_mates(spark):
    same = corrected(spark, [read(0, "a", "G"), read(1, "a", "G", reverse=True)], counts=(5, 5, 1, 1))
    assert (same["tvf"], same["tvr"], same["pair_alt"]) == (1, 0, 1)
    better = corrected(spark, [read(0, "a", "G", bq=20), read(1, "a", "A", bq=30)], counts=(5, 5, 1, 0))
    assert (better["trf"], better["tvf"]) == (5, 0)
    worse = corrected(spark, [read(0, "a", "G", bq=30), read(1, "a", "A", bq=20)], counts=(5, 5, 1, 0))
    assert (worse["trf"], worse["tvf"]) == (4, 1)
    unpaired = corrected(spark, [read(0, "a", "G", paired=False), read(1, "a", "G", paired=False)], counts=(5, 5, 2, 0))
    assert unpaired["tvf"] == 2 and unpaired["plus"] == [0] * 10


def test_calls_that_are_not_corrected(spark):
    mates = [read(0, "a", "G"), read(1, "a", "G", reverse=True), read(2, "b", "T")]
    for more in ({"evidence": ("germline", 9, "somatic")}, {"alt": "G,T"}, {"evidence": (None, 9, None)}, {"evidence": ("somatic", 7, "somatic"), "no_control": True}, {"evidence": ("somatic", 9, "germline"), "no_control": True}):
        same = corrected(spark, mates, counts=(5, 5, 2, 2), **more)
        assert (same["tvf"], same["tvr"], same["pair_alt"], same["stray"], same["plus"]) == (2, 2, 0, 0, None)
    for more in ({"evidence": ("multi_somatic", 1, ".")}, {"evidence": (None, 8, "somatic"), "no_control": True}):
        assert corrected(spark, mates, counts=(5, 5, 2, 2), **more)["pair_alt"] == 1


def test_a_long_insertion_moves_nothing(spark):
    rows = [("p", "1", 5, "A", f".+{n}{'ACGT' * 40}"[: 2 + len(str(n)) + n] + ",-2gt.^+.$", "IIII") for n in (1, 60, 61, 150)]
    out = control.explode_pileup(spark.createDataFrame(rows, "pid string, chrom string, pos int, ref string, bases string, quals string"))
    assert [(r["idx"], r["base"]) for r in out.orderBy("idx").collect()] == [(k, b) for k, b in enumerate("AaAA") for _ in rows]


def test_duplicates_and_gates(spark):
    dups = corrected(spark, [read(0, "a", "G", bq=20, place=7), read(1, "b", "G", bq=40, place=7), read(2, "c", "A", bq=40, place=7)], counts=(5, 5, 2, 0))
    assert (dups["tvf"], dups["trf"], dups["dup_alt"]) == (0, 5, 2)  # of equal qualities the last stays
    low = corrected(spark, [read(0, "a", "G", bq=12, place=7), read(1, "b", "G", mq=29, place=7), read(2, "c", "G", place=7)], counts=(5, 5, 1, 0))
    assert low["tvf"] == 1
    worn = corrected(spark, [read(0, "a", "G", nm=5), read(1, "b", "G")], counts=(5, 5, 2, 0), max_mismatches=4)
    assert (worn["tvf"], worn["mis_alt"]) == (1, 1)
    floor = corrected(spark, [read(k, "a", "A", reverse=True) for k in range(2)], counts=(5, 0, 0, 0))
    assert floor["trr"] == 0
    stray = corrected(spark, [read(0, "a", "T"), read(1, "b", "G")], counts=(5, 5, 4, 0))
    assert (stray["tvf"], stray["stray"]) == (3, 1)


def test_reads_without_rows(spark):
    sites = spark.createDataFrame([("p", "1", 5, "A", "G", 1, 1, 1, 1, "multi_somatic", 1, ".")], CALL)
    row = reads.overlap_corrected_counts(sites, spark.createDataFrame([], READ)).first()
    assert (row["trf"], row["trr"], row["tvf"], row["tvr"], row["plus"]) == (1, 1, 1, 1, [0] * 10)


# --- scores -----------------------------------------------------------------------------------------------------

CLEAN = dict(
    chrom="1", pos=5, ref="A", alt="G", qual=200.0, trf=30, trr=30, tvf=20, tvr=20, crf=50, crr=50, cvf=0, cvr=0, tsr=0, repeat_masker=".", simple_tandemrepeats=".", segdup=".", duke_excluded=".",
    dac_blacklist=".", hiseqdepth=".", mapability="1", kgenomes=".", dbsnp=".", exac=".", evs=".", gnomad_exomes=".", gnomad_genomes=".", local_control_wgs=".", local_control_wes=".",
    annotation_control="somatic", seq_bias=".", seqing_bias=".", seq_bias_1=".", seqing_bias_1=".", filter=".",
)


def scored(spark, options=None, **changes):
    row = CLEAN | changes
    return confidence.confidence_score(spark.createDataFrame([tuple(row.values())], list(row)), options).first()


@pytest.mark.parametrize(
    ("changes", "score", "tags"),
    [
        ({}, 10, "PASS"),
        ({"repeat_masker": "Simple_repeat"}, 8, "PASS"),
        ({"repeat_masker": "L1"}, 9, "PASS"),
        ({"repeat_masker": "Satellite", "simple_tandemrepeats": "t", "segdup": "s"}, 8, "PASS"),
        ({"hiseqdepth": "x"}, 7, "HSDEPTH"),
        ({"mapability": "."}, 5, "MAP"),
        ({"mapability": "0.5"}, 10, "PASS"),
        ({"mapability": "1&0.3"}, 8, "PASS"),
        ({"mapability": "0.04"}, 2, "MAP"),
        ({"tvr": 0}, 8, "PASS"),
        ({"tvf": 6, "tvr": 0}, 5, "SBAF"),
        ({"tvf": 3, "tvr": 2}, 8, "PASS"),
        ({"tvf": 1, "tvr": 1, "trf": 3, "trr": 3}, 5, "TAC;1PS"),
        ({"tvf": 0, "tvr": 1}, 1, "TAC;SBAF;FRQ;TAR"),
        ({"crf": 3, "crr": 2}, 7, "DPLOWC"),
        ({"crf": 100, "crr": 51}, 8, "PASS"),
        ({"crf": 200, "crr": 101}, 6, "DPHIGH"),
        ({"cvf": 1}, 8, "PASS"),
        ({"tsr": 4}, 7, "ALTC"),
        ({"tsr": 3}, 10, "PASS"),
        ({"chrom": "Y", "qual": 99.0}, 7, "YALT"),
        ({"annotation_control": "unclear"}, 8, "PASS"),
        ({"annotation_control": "LQVSIG", "hiseqdepth": "x"}, 5, "HSDEPTH;ALTC"),
        ({"hiseqdepth": "x", "filter": "q10;HSDEPTH"}, 7, "q10;HSDEPTH"),
    ],
)
def test_rules(spark, changes, score, tags):
    row = scored(spark, **changes)
    assert (row["confidence"], row["filter"]) == (score, tags), row["penalties"]


def test_golden_call(spark):
    row = scored(
        spark, confidence.Options(cutoff=500, punish_control=False), trf=72, trr=5, tvf=1, tvr=2, crf=239, crr=15, cvf=2, cvr=0, tsr=5, mapability="0.333333",
        repeat_masker="Simple_repeat", hiseqdepth="x", annotation_control="unclear",
    )
    assert (row["confidence"], row["reclassification"], row["filter"]) == (1, "LQVSIG", "RE;TAC;HSDEPTH;MAP;FRQ")


@pytest.mark.parametrize(
    ("changes", "state"),
    [
        ({"cvf": 1}, "LQVSIG"), ({"tsr": 4}, "LQVSIG"), ({"kgenomes": "MATCH=exact;x"}, "SNP_support_germline"), ({"kgenomes": "MATCH=exact;x", "crf": 4, "crr": 5}, "lowCov_SNP_support_germline"),
        ({"dbsnp": "MATCH=exact;ID=rs1;CLN;x"}, "somatic_precious"), ({"annotation_control": "germline", "dbsnp": "MATCH=exact;ID=rs1", "crf": 5, "crr": 5}, "germline_SNP_support_lowCov"),
        ({"annotation_control": "unclear", "tsr": 2}, "LQVSIG"), ({"annotation_control": "unclear", "tsr": 1}, "unclear"), ({"annotation_control": "LQVSIG", "kgenomes": "MATCH=exact"}, "SNP_support_germline"),
    ],
)
def test_reclassification(spark, changes, state):
    row = scored(spark, **changes)
    assert row["reclassification"] == state
    assert row["id"] == ("rs1" if "dbsnp" in changes else ".")


def test_options(spark):
    assert scored(spark, confidence.Options(no_control=True), gnomad_exomes="AF=0.0001,0.002")["reclassification"] == "SNP_support_germline"
    assert scored(spark, confidence.Options(no_control=True), gnomad_exomes="AF=0.001")["reclassification"] == "somatic"
    assert scored(spark, confidence.Options(round=1), seq_bias="PCR_plus=9")["confidence"] == 7
    assert scored(spark, confidence.Options(round=2), seq_bias="PCR_plus=9", seqing_bias_1="x")["confidence"] == 4
    assert scored(spark, confidence.Options(round=1, run_exome=True), seq_bias="PCR_plus=9")["confidence"] == 10
    assert scored(spark, confidence.Options(run_low_maf=True), tvf=1, tvr=1)["confidence"] == 8
    assert scored(spark, confidence=999, hiseqdepth="x")["confidence"] == 10


# --- bias and quality -------------------------------------------------------------------------------------------


def test_catalogue_and_matrix(spark):
    assert bias.catalogue(spark).distinct().count() == 96
    ten = lambda **k: [k.get(b, 0) for b in fields.TEN_BASES]
    rows = [("p", "C", "T", "A", "G", ten(T=30), ten(t=1)), ("p", "G", "A", "C", "T", ten(A=2), ten(a=3)), ("p", "C", "T", "N", "G", ten(T=9), ten())]
    df = bias.strand_counts(spark.createDataFrame(rows, "pid string, ref string, alt string, base_before string, base_after string, plus array<bigint>, minus array<bigint>"))
    matrix = bias.strand_error_matrix(df, "pcr")
    assert matrix.count() == 96
    cell = matrix.where("mutation = 'CT' AND before = 'A' AND after = 'G'").first()
    # the second row is the first's reverse complement: its strands are swapped
    assert (cell["plus"], cell["minus"], cell["n_muts"]) == (30 + 3, 1 + 2, 2)
    judged = bias.bias_matrix(matrix)
    assert judged.where("bias <> 0").count() == 1 and judged.where("bias = 2").count() == 1
    assert bias.bias_matrix(matrix, enforce_n_muts=True).where("bias <> 0").count() == 0
    flagged = bias.flag_bias(df, judged, bias.bias_matrix(bias.strand_error_matrix(df, "seq")))
    assert [r["seq_bias"] for r in flagged.orderBy("ref", "base_before").collect()] == ["PCR_plus=30;PCR_minus=1", ".", "0"]


def test_purity_and_outliers(spark):
    rows = [("p", c, 0.5 + 0.001 * k) for k, c in enumerate(qc.CHROMS)]
    rows[3] = ("p", "4", 5.0)
    row = qc.purity_esd(spark.createDataFrame(rows, "pid string, chrom string, purity double")).first()
    assert row["outliers"] == "4" and 0.5 < row["purity"] < 0.53


def test_t_distribution():
    assert math.isclose(base_quality.t_two_sided(2.0, 10), 0.0733880, abs_tol=1e-6)
    assert math.isclose(base_quality.t_two_sided(0.5, 1), 2 * (0.5 - math.atan(0.5) / math.pi), abs_tol=1e-6)
    assert math.isclose(base_quality.t_two_sided(3.0, 2.5), 0.0745, abs_tol=2e-3) and base_quality.t_two_sided(None, None) == 1.0


def test_incomplete_beta_of_arrays():
    x = np.linspace(0, 1, 21)
    assert np.allclose(base_quality.incomplete_beta(2, 3, x), 6 * x**2 - 8 * x**3 + 3 * x**4, atol=1e-12)
    assert np.allclose(base_quality.incomplete_beta(1, 1, x), x, atol=1e-12) and np.allclose(base_quality.incomplete_beta(0.5, 0.5, x), 2 / np.pi * np.arcsin(np.sqrt(x)), atol=1e-12)
    # many degrees of freedom: the normal distribution
    assert np.allclose(base_quality.two_sided(np.array([0.5, 1.96, 5.0]), np.full(3, 1e7)), [math.erfc(z / math.sqrt(2)) for z in (0.5, 1.96, 5.0)], rtol=1e-5)
    assert base_quality.two_sided(np.array([np.nan, 0.0, np.inf]), np.array([3.0, 3.0, 3.0])).tolist() == [1.0, 1.0, 1.0]


def test_adjusted_p_values(spark):
    values = [0.01, 0.02, 0.03, 0.5]
    ts = spark.createDataFrame([("p", "CA", "A", b, t, 30.0) for b, t in zip("ACGT", (2.7, 2.4, 2.2, 0.1))], "pid string, mutation string, before string, after string, t double, freedom double")
    rows = base_quality.shift_p_values(ts).orderBy("p").collect()
    p = [r["p"] for r in rows]
    for k, r in enumerate(rows):
        assert math.isclose(r["p_adjusted"], min(min(1, p[j] * 4 / (j + 1)) for j in range(k, 4)), abs_tol=1e-4)
    assert len(values) == len(rows)


def test_distances(spark):
    rows = [("p", "1", 10), ("p", "1", 10), ("p", "1", 25), ("p", "2", 30), ("q", "1", 7)]
    df = spark.createDataFrame([(*r, "C", "T", 1, 1, 1, 1, "UTR3") for r in rows], "pid string, chrom string, pos bigint, ref string, alt string, trf int, trr int, tvf int, tvr int, annovar_function string")
    got = lambda **k: sorted((r["pid"], r["chrom"], r["pos"], r["distance"]) for r in windows.intermutation_distance(df, **k).collect())
    assert got() == [("p", "1", 10, 1), ("p", "1", 10, 10), ("p", "1", 25, 15), ("p", "2", 30, 30), ("q", "1", 7, 7)]
    assert ("p", "2", 30, 5) in got(per_chrom=False)
    lengths = spark.createDataFrame([("1", 1000), ("2", 500)], "chrom string, length bigint")
    assert [(r["place"], r["log_distance"]) for r in windows.rainfall(df, lengths).collect()] == [(25, round(math.log10(15), 6))]


# --- sources and sinks ------------------------------------------------------------------------------------------


def test_variant_files(spark, tmp_path):
    header = "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tINFO_control(x)\tANNOTATION_control\tEXTRA col"
    for name, pos in (("p1", 5), ("p2", 6)):
        (tmp_path / f"{name}.vcf").write_text(f"##meta\n{header}\n1\t{pos}\t.\ta\tG\t3.5\t.\tDP=1\tDP=2\tsomatic\tx\n1\tbad\t.\ta\tG\t.\t.\tDP=1\tDP=2\tsomatic\n")
    rows = variants.read_variants(spark, str(tmp_path)).orderBy("pid", "pos").collect()
    assert [(r["pid"], r["pos"], r["ref"], r["qual"], r["info_control"], r["extra_col"]) for r in rows] == [
        ("p1", None, "A", None, "DP=2", None), ("p1", 5, "A", 3.5, "DP=2", "x"), ("p2", None, "A", None, "DP=2", None), ("p2", 6, "A", 3.5, "DP=2", "x"),
    ]


def test_small_files(spark, tmp_path):
    (tmp_path / "t.bed").write_text("#c\n1\t0\t10\ta\n")
    assert [tuple(r) for r in variants.read_track_spec(spark, f"{tmp_path}/t.bed:name:1:x").collect()] == [("1", 0, 10, "a")]
    (tmp_path / "q.txt").write_text("1\t5\t3,4;0.25\n")
    assert [tuple(r) for r in variants.read_base_quality_lists(spark, f"{tmp_path}/q.txt").collect()] == [("q", "1", 5, [3, 4], 0.25)]
    (tmp_path / "c.tsv").write_text("pid\tdecoded\tgender\tage\tsubgroup\np\td\tf\t3\ts\n")
    assert variants.read_clinical(spark, f"{tmp_path}/c.tsv").first()["gender"] == "f"


def test_standard_info(spark):
    row = spark.createDataFrame([("DP=3;SOMATIC;Y=1", "DP=9;VAF=.", ".", "L1")], "info string, info_control string, empty string, repeats string")
    info = row.select(sinks.standard_info(free={"repeats": "RM", "empty": "E"}).alias("x")).first()["x"]
    assert info == "DP=3;DP_ctrl=9;RM=L1;SOMATIC;VAF_ctrl=.;Y=1"
    assert row.select(sinks.standard_info(free={}, keys=["DP", "SOMATIC"]).alias("x")).first()["x"] == "DP=3;SOMATIC"
    assert row.select(sinks.standard_info(free={}, keys=[]).alias("x")).first()["x"] == "."


def test_classes_are_written_apart(spark, tmp_path):
    df = spark.createDataFrame([("p", "somatic", 1), ("p", "germline_functional", 2), ("q", "somatic", 3)], "pid string, class string, pos int")
    sinks.write_by_class(df, f"{tmp_path}/out")
    assert sorted(f"{a.name}/{b.name}" for a, b in ((p.parent, p) for p in (tmp_path / "out").glob("pid=*/class=*"))) == ["pid=p/class=germline_functional", "pid=p/class=somatic", "pid=q/class=somatic"]


def test_catalogue_folding_is_idempotent(spark):
    cells = [(r, a, b, c) for r, a in itertools.permutations("ACGT", 2) for b in "AG" for c in "CT"]
    df = base_quality.with_triplet(spark.createDataFrame(cells, "ref string, alt string, base_before string, base_after string"))
    again = base_quality.with_triplet(df.select(F.left("mutation", F.lit(1)).alias("ref"), F.right("mutation", F.lit(1)).alias("alt"), F.col("before").alias("base_before"), F.col("after").alias("base_after")))
    assert df.select("mutation", "before", "after").exceptAll(again.select("mutation", "before", "after")).count() == 0
    assert df.select("mutation").distinct().count() == 6


def test_curves_of_a_variant(spark):
    df = spark.createDataFrame([(1, [3, 3, 55, 60], []), (2, None, [0])], "k int, bq_ref array<bigint>, bq_alt array<bigint>")
    out = base_quality.bq_curves(df)
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    one, two = out.orderBy("k").collect()
    assert len(one["hist_ref"]) == len(one["curve_ref"]) == 56 and one["hist_ref"][3] == 2 and sum(one["hist_ref"]) == 3  # 60 is beyond
    assert one["curve_ref"][2:5] == [0.0, 0.666667, 0.666667] and one["curve_ref"][55] == 1.0 and one["curve_alt"] is None
    assert two["curve_ref"] is None and set(two["curve_alt"]) == {1.0}


def test_shares_of_the_grid_are_of_all_bases(spark):
    schema = "pid string, chrom string, pos int, ref string, alt string, base_before string, base_after string, bq_ref array<bigint>, bq_alt array<bigint>"
    rows = [("p", "1", k, "C", "T", "A", "G", [4, 10, 22, 40], [2, 40]) for k in range(3)] + [("p", "1", 9, "G", "A", "C", "T", [], [13, 20, 28, 50])]
    row = base_quality.bq_artifact_grid(spark.createDataFrame(rows, schema)).first()
    assert (row["n"], row["share"], row["auc_30_0_ref"], row["auc_30_5_ref"], row["auc_20_13_ref"]) == (4, 1.0, 0.75, 0.5, None)
    assert (row["auc_30_0_alt"], row["auc_30_5_alt"], row["auc_20_13_alt"], row["z_5"]) == (0.6, 0.3, 0.2, None)


def test_lists_of_rows_equal_lists_of_reads_and_shuffle_nothing(spark):
    read = "array<struct<base:string,bq:bigint,is_reverse:boolean,query_pos:bigint,read_len:int>>"
    rows = [("p", "1", 1, "A", "c", [("a", 30, True, 10, 101), ("C", 20, False, 5, 101), ("c", 10, True, 7, 101), ("N", 1, False, 1, 101)]), ("p", "1", 2, "A", "A", [("A", 7, False, 3, 101)]), ("p", "1", 3, "A", "G", [("T", 7, False, 3, 101)])]
    variants_ = spark.createDataFrame(rows, f"pid string, chrom string, pos bigint, ref string, alt string, reads {read}")
    got = reads.base_quality_lists_of_rows(variants_)
    want = reads.base_quality_lists(variants_.drop("reads"), variants_.selectExpr("pid", "chrom", "pos", "posexplode(reads) AS (pileup_idx, x)").select("pid", "chrom", "pos", "pileup_idx", "x.*"))
    columns = ["pid", "chrom", "pos", "bq_alt", "rp_alt", "bq_ref", "rp_ref", "vaf"]
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(map(tuple, want.select(columns).collect()))
    for made in (got, base_quality.bq_row_stats(got), base_quality.bq_curves(got)):
        assert "Exchange" not in made._jdf.queryExecution().executedPlan().toString()


def test_shift_is_made_from_counts(spark):
    df = spark.range(40).selectExpr("'p' AS pid", "'1' AS chrom", "id AS pos", "'C' AS ref", "'A' AS alt", "'A' AS base_before", "'G' AS base_after", "array(30L, id % 7) AS bq_ref", "array(id % 5) AS bq_alt")
    shift = base_quality.triplet_bq_shift(df)
    plan = shift._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile(" in plan and ", k#" in plan  # of counts, not of rows
    row = shift.first()
    ref, alt = [30] * 40 + [i % 7 for i in range(40)], [i % 5 for i in range(40)]
    assert (row["n_ref"], row["n_alt"], row["median_ref"], row["median_alt"]) == (80, 40, statistics.median(ref), statistics.median(alt))
    welch = statistics.variance(ref) / 80 + statistics.variance(alt) / 40
    assert row["t"] == pytest.approx((statistics.mean(alt) - statistics.mean(ref)) / welch**0.5, abs=1e-6)


def test_rounds_carry_asked_columns_and_read_rows_once_each(spark):
    name = "spark.sql.codegen.hugeMethodLimit"
    rows = fixtures.strands(spark, "/root/testdata/sf0.001")
    columns, options, widths, settings = ["pid", "chrom", "pos", "confidence", "penalties", "filter", "seq_bias", "seqing_bias_1"], confidence.Options(cutoff=500), [], []

    def cut(df):
        widths.append(set(df.columns))
        settings.append(spark.conf.get(name))
        return stored(df)

    before = spark.conf.get(name)
    some = bias.two_round_bias_filter(rows, options, cut=cut, keep=columns)
    assert spark.conf.get(name) == before and set(settings) == {"8000"}
    assert some.columns == columns and "sequence_context" not in widths[0] and "repeat_masker" not in widths[0]
    # the rows once, and for each round its sums and its cells
    assert len(widths) == 5 and all("pos" not in w for w in widths[1:])
    whole = bias.two_round_bias_filter(rows, options)
    assert set(rows.columns) <= set(whole.columns) and sorted(map(repr, whole.select(*columns).collect())) == sorted(map(repr, some.collect()))


def test_strand_counts_of_alleles_that_are_no_single_base(spark):
    rows = [(alt, "C", "A", "G", list(range(10)), list(range(10, 20))) for alt in ("T", "t", "A,T", "", None)]
    df = spark.createDataFrame(rows, "alt string, ref string, base_before string, base_after string, plus array<bigint>, minus array<bigint>")
    found = [tuple(r) for r in bias.strand_counts(df).select("pcr_plus", "pcr_minus", "seq_plus", "seq_minus").collect()]
    assert found == [(3 + 8, 13 + 18, 3 + 13, 8 + 18)] * 2 + [(None,) * 4] * 3


def test_rerun_reads_its_rows_once_and_only_makes_lists_of_functional_ones(spark):
    rows = [("p", "1", pos, "A", "C", 1, 1, 1, 1, conf, "somatic", None, "exonic", effect, "0", bq) for pos, conf, effect, bq in (
        (1, 9, "nonsynonymous SNV", [10, 30, None]), (2, 9, "stopgain SNV", [9, 19]), (2, 9, "stopgain SNV", [30]), (3, 9, "stopgain SNV", []), (4, 9, "synonymous SNV", [1]), (5, 3, "stopgain SNV", [1]), (6, 9, "stopgain SNV", [12, 13])
    )]
    schema = "pid string, chrom string, pos bigint, ref string, alt string, trf bigint, trr bigint, tvf bigint, tvr bigint, confidence bigint, annotation_control string, reclassification string, annovar_function string, exonic_classification string, dbsnp string, bq_alt array<bigint>"
    made, cuts = spark.createDataFrame(rows, schema).withColumns({"kgenomes": F.lit("."), "pv4_tail": F.lit(1.0)}), []

    def cut(df):
        cuts.append(stored(df))
        return cuts[-1]

    columns = ["pid", "pos", "maf", "class"]
    lost = pipelines.pipeline_filter_rerun(made, threshold=20, min_conf=5, cut=cut, keep=columns)[1]
    # the second row of position 2 is kept, and so none of its span is lost
    assert lost.columns == columns and sorted(r["pos"] for r in lost.collect()) == [3, 6]
    plan = lost._jdf.queryExecution().optimizedPlan().toString()
    assert len(cuts) == 1 and "LocalRelation" not in plan and "LogicalRDD" not in plan and plan.count("Relation [") > 1
    whole = pipelines.pipeline_filter_rerun(made, threshold=20, min_conf=5)[1]
    assert sorted(map(repr, whole.select(*columns).collect())) == sorted(map(repr, lost.collect())) and "bq_alt" in whole.columns


def test_quantile_makes_positions_once_a_row(spark):
    lists = reads.base_quality_lists_of_rows(fixtures.with_reads(fixtures.snv(spark, "/root/testdata/sf0.001")))
    plan = base_quality.read_position_quantile(lists, 0.7).where("quantile IS NOT NULL")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("arrays_zip(") == 1 and plan.count("sort_array(") == 1
    df = spark.createDataFrame([(1, [3, None, 1]), (2, []), (3, None), (4, [5])], "k int, rp_alt array<bigint>").selectExpr("'p' AS pid", "'1' AS chrom", "k AS pos", "rp_alt")
    assert [tuple(r)[2:] for r in base_quality.read_position_quantile(df, 0.7).orderBy("pos").collect()] == [(1, 2), (2, None), (3, None), (4, 5)]


def test_median_filter_makes_lists_once_a_row(spark):
    lists = reads.base_quality_lists_of_rows(fixtures.with_reads(fixtures.snv(spark, "/root/testdata/sf0.001")))
    plan = filters.median_alt_bq_filter(lists, 21).select("pid", "pos")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("arrays_zip(") == 1 and plan.count("sort_array(") == 1
    df = spark.createDataFrame([(1, [3, None, 1]), (2, []), (3, None), (4, [5, 2])], "k int, bq_alt array<bigint>")
    kept = filters.median_alt_bq_filter(df, 2.5)
    assert kept.columns == df.columns and [r["k"] for r in kept.collect()] == [4]


def test_correction_of_rows_equals_that_of_reads_and_shuffles_nothing(spark):
    rng = random.Random(5)
    some = lambda *values: rng.choice([*values, None] if rng.random() < 0.1 else values)
    rows = []
    for pos in range(60):
        call = ("p", "1", pos, "A", rng.choice(["G", "g", "G,T", "A"]), 9, 9, 9, 9, rng.choice(["somatic", "multi_somatic", "germline", None]), 9, "somatic")
        many = [
            (k, some("a", "b", "c", "d", "e"), some("A", "a", "G", "g", "T", "N"), some(12, 13, 20, 30), some(29, 30, 60), some(True, False), some(True, False), some(True, True, True, False), some(0, 1, 5), 10, 100, some(1, 2), some(1, 2, 3), 0, some(1, 2), 0)
            for k in range(rng.choice([0, 1, 3, 12, 25]))
        ]
        rows.append((*call, many))
    item = READ.split(", ", 3)[3]
    held = spark.createDataFrame(rows, f"{CALL}, reads array<struct<{', '.join(x.replace(' ', ':') for x in item.split(', '))}>>")
    one = held.selectExpr("pid", "chrom", "pos", "explode(reads) AS x").select("pid", "chrom", "pos", "x.*")
    for limits in ({}, {"max_mismatches": 3}, {"no_control": True, "min_mapq": 0}):
        want = reads.overlap_corrected_counts(held.drop("reads"), one, **limits)
        got = reads.overlap_corrected_counts_of_rows(held, **limits)
        assert sorted(got.columns) == sorted(want.columns)
        assert sorted(map(repr, got.select(want.columns).collect())) == sorted(map(repr, want.collect()))
        assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    assert reads.overlap_corrected_counts_of_rows(held.withColumn("reads", F.lit(None).cast(held.schema["reads"].dataType))).where("pos = 0 OR tvf <> 9").count() == 1


def test_query_of_corrected_counts_only_deals_its_base_table(spark):
    plan = queries.QUERIES["overlap_corrected_counts"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Sort" not in plan and "Join" not in plan


def test_annotation_deals_no_row_that_holds_reads(spark):
    small, plans = "/root/testdata/sf0.001", []

    def cut(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stored(df)

    rows = fixtures.annotated(spark, small).drop("gene", "segdup")
    held = fixtures.with_reads(fixtures.annotated(spark, small, dealt=True).drop("gene", "segdup"), mates=True)
    with_tables = dict(known={"extra_sites": fixtures.known(spark, small)}, tracks={"segdup": fixtures.track(spark, small)})
    columns = ["pid", "chrom", "pos", "trf", "tvr", "extra_sites", "segdup", "confidence", "filter"]
    some = pipelines.pipeline_annotate(rows, held=held, cut=cut, keep=columns, **with_tables)
    lines = plans[0].splitlines()
    made = next(k for k, line in enumerate(lines) if "arrays_zip" in line)
    indent = lambda line: len(line) - len(line.lstrip(" :+-*"))
    above, limit = [], indent(lines[made])
    for line in lines[made::-1]:
        if indent(line) < limit:
            above, limit = [*above, line], indent(line)
    assert any("ShuffledHashJoin" in line for line in above) and not any("Exchange" in line or "SortMergeJoin" in line for line in above)
    whole = pipelines.pipeline_annotate(rows, fixtures.reads(spark, small), **with_tables)
    assert some.columns == columns and sorted(map(repr, whole.select(*columns).collect())) == sorted(map(repr, some.collect()))
    assert some.where("extra_sites <> '.'").count() and some.where("segdup <> '.'").count() and not some.where("extra_sites IS NULL OR segdup IS NULL").count()


def test_curves_are_made_a_batch_at_a_time(spark):
    df = spark.createDataFrame([(1, [0] + [5] * 127, [None, 56, -1]), (2, [1, 1, 1], [55])], "k int, bq_ref array<bigint>, bq_alt array<bigint>")
    out = base_quality.bq_curves(df)
    assert "lambda" not in out._jdf.queryExecution().optimizedPlan().toString()
    one, two = out.orderBy("k").collect()
    assert one["curve_ref"][:5] == [0.007813] * 5 and one["hist_ref"][0] == 1 and one["area_ref"] == pytest.approx(5 * 0.007813 + 51)  # halves up
    assert (one["hist_alt"], one["curve_alt"], one["area_alt"]) == ([0] * 56, None, None)
    assert two["curve_ref"] == [0.0] + [1.0] * 55 and two["area_alt"] == 1.0
