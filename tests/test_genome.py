"""Indels in pileups, joins of positions and spans with intervals, headers of each file, track specs, standard files."""

import gzip
import random

import pytest

from strandline.operators import control, intervals, joins
from strandline.sources import sinks, variants

PILEUP = "pid string, chrom string, pos int, ref string, bases string, quals string"
CALL = "pid string, chrom string, pos int, ref string, alt string, tvf int, tvr int, qual double"


def compared(spark, pileup, call):
    counts = control.control_counts(spark.createDataFrame([("p", "1", 5, *pileup)], PILEUP))
    return control.compare_control(spark.createDataFrame([("p", "1", 5, *call, 5, 5, 50.0)], CALL), counts).first()


@pytest.mark.parametrize(
    ("pileup", "call", "dp5_all", "annotation"),
    [
        # a substitution, with reads that begin; four of the reads with the base are of good quality
        (("A", ",.,,.,..,,,,,.,,,,,,,,,,,c,,,,.,c,,cc,^1,^!,^!,^!,", "IIII6I-)CFIII+9I,IIIFII)IHB/IGIII9IIIBI52;"), ("A", "C"), [6, 32, 0, 4, 0], "germline"),
        # one base inserted, by nearly all reads
        (("c", ",,,...+1A,+1a,+1a.+1A,+1a,+1a,+1a.+1A.+1A,+1a,+1a,+1a,+1a.+1A,+1a,+1a,+1a,+1a,+1a,+1a.+1A,+1a.+1A.+1A.+1A.+1A.+1A,+1a.+1A,+1aa", "EIII#F<6GA9FIG80'#II:4#-#IGEIIGIAH##"), ("caaaaaaaaaaa", "cAaaaaaaaaaaa"), [2, 3, 12, 18, 1], "germline"),
        # four bases inserted twice; three are another insertion
        (("a", ",,,..,,.,..,.,.,....+4AAAC,+4aaac.+3AACC", "DIGGDEIGH=5IGFDGEEGH2GI"), ("aaaacaaacaaacaaac", "aAAACaaacaaacaaacaaac"), [10, 9, 1, 1, 2], "germline"),
        # one base deleted; a star is no deletion of it
        (("T", "*,-1g.-1G,-1g.-1G,-1g.-1G,-1g,-1g.-1G", "#A1>8I&6(D"), ("TGGGGGGGG", "TGGGGGGG"), [0, 0, 4, 5, 1], "germline"),
        # five bases deleted, between reads that end; of several alternatives the first
        (("a", ".$,,.,,,,,,,.,,,-5tatat,,-5tatat,-5tatat.", "#@DDIGIGIIG2IIIHI7D"), ("atatattatat", "atatat,a"), [4, 12, 0, 3, 0], "germline"),
        # nothing of the kind
        (("A", ".....,,.,,.g", "C=CD@E#G##E#"), ("ACTGTCT", "ACT"), [7, 4, 0, 0, 1], "somatic"),
        # ten bases: both digits are the length
        (("t", "..,$.,.,,,,,.+10GTCCGTAATG.+10GTCCGTAATG.,", "```````````Q```"), ("tgt", "tGTCCGTAATGgt"), [5, 8, 2, 0, 0], "germline"),
        # a read with an insertion speaks for no base
        (("A", ".+1C,+1cCC^+C$", "IIIII"), ("A", "C,T"), [0, 0, 3, 0, 2], "multi_germline"),
    ],
)
def test_indels_in_pileups(spark, pileup, call, dp5_all, annotation):
    row = compared(spark, pileup, call)
    assert (row["dp5_all"], row["annotation_control"], row["dp"]) == (dp5_all, annotation, len(pileup[2]))


def test_counts_of_good_quality(spark):
    counts = control.control_counts(spark.createDataFrame([("p", "1", 5, "A", ".,+2ACg*N", "I.-I!")], PILEUP)).first()
    assert counts["nq"] == [1, 0, 0, 0, 1, 0, 0, 1, 0, 0] and counts["hq"] == [1, 0, 0, 0, 0, 0, 0, 0, 0, 0]
    assert (counts["hq_reads"], counts["dp"], counts["hq_indels"], counts["nq_indels"]) == (3, 5, ["+2AC"], ["+2AC"])
    empty = control.control_counts(spark.createDataFrame([("p", "1", 5, "A", "", "")], PILEUP)).first()
    assert (empty["dp"], empty["hq_reads"], empty["hq"]) == (0, 0, [0] * 10)


def test_counting_shuffles_nothing(spark):
    plan = control.control_counts(spark.createDataFrame([("p", "1", 5, "A", ".", "I")], PILEUP))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Exchange", "Generate", "Python"))


# --- intervals --------------------------------------------------------------------------------------------------


def mixed_track(rng: random.Random, n: int) -> list[tuple]:
    """Intervals of no base to whole chromosomes."""
    lengths = [0, 1, 3, 10, 1023, 1024, 1025, 8191, 8193, 70_000, 3_000_000, 250_000_000]
    return [(rng.choice("12"), s := rng.randrange(200_000), s + rng.choice(lengths), f"n{k}") for k in range(n)]


def test_tracks_equal_a_naive_join(spark):
    rng = random.Random(8)
    tracks = {f"t{k}": mixed_track(rng, 40) for k in range(4)}
    spots = [(f"p{k % 3}", rng.choice("12"), rng.randrange(1, 210_000)) for k in range(300)] + [("p", "1", 249_000_000), ("p", "3", 5)]
    frames = {n: intervals.Track(spark.createDataFrame(t, "chrom string, start0 bigint, end0 bigint, name string"), most=3 if n == "t1" else None) for n, t in tracks.items()}
    got = intervals.annotate_tracks(spark.createDataFrame(spots, "pid string, chrom string, pos bigint"), frames).collect()
    cell = lambda t, c, p, most: "&".join(sorted(n for x, s, e, n in t if x == c and s < p <= e)[:most]) or "."
    assert sorted((r["pid"], r["chrom"], r["pos"], *[r[n] for n in tracks]) for r in got) == sorted((i, c, p, *[cell(t, c, p, 3 if n == "t1" else None) for n, t in tracks.items()]) for i, c, p in spots)


def test_an_interval_is_stored_twice_at_most(spark):
    lengths = [1, 1024, 1025, 10**6, 250_000_000, 2**31]
    track = spark.createDataFrame([("1", 777, 777 + n, f"n{n}") for n in lengths], "chrom string, start0 bigint, end0 bigint, name string")
    assert {r["name"]: r["count"] for r in intervals._stored(track).groupBy("name").count().collect()}.keys() == {f"n{n}" for n in lengths}
    assert max(r["count"] for r in intervals._stored(track).groupBy("name").count().collect()) <= 2


def test_exchanges_do_not_grow_with_tracks(spark):
    spots = spark.range(10).selectExpr("'p' AS pid", "'1' AS chrom", "id AS pos")
    one = spark.range(5).selectExpr("'1' AS chrom", "id AS start0", "id + 3 AS end0", "'x' AS name")

    def exchanges(n: int) -> int:
        return intervals.annotate_tracks(spots, {f"t{k}": intervals.Track(one) for k in range(n)})._jdf.queryExecution().executedPlan().toString().count("Exchange ")

    assert exchanges(1) == exchanges(11)


def test_overlapping_spans_and_what_is_left(spark):
    rng = random.Random(3)
    side = lambda n: [(rng.choice("pq"), "1", rng.randrange(1, 60_000), "A" * rng.choice([1, 1, 2, 40, 1500, 9000]), k) for k in range(n)]
    a, b = side(120), side(80)
    schema = "pid string, chrom string, pos bigint, ref string, k int"
    fa, fb = spark.createDataFrame(a, schema), spark.createDataFrame(b, schema)
    meets = lambda x, y: x[0] == y[0] and x[2] < y[2] + len(y[3]) and y[2] < x[2] + len(x[3])
    pairs = intervals.overlapping_spans(intervals.with_span(fa), intervals.with_span(fb), on=["pid", "chrom"]).collect()
    assert sorted(map(tuple, pairs)) == sorted({(x[0], "1", x[2], x[2] + len(x[3]) - 1, y[2], y[2] + len(y[3]) - 1) for x in a for y in b if meets(x, y)})
    assert sorted(r["k"] for r in joins.subtract_variants(fa, fb).collect()) == [x[4] for x in a if not any(meets(x, y) for y in b)]
    assert joins.subtract_variants(fa, fb.limit(0)).count() == len(a)


def test_alleles_in_minimal_form(spark):
    database = spark.createDataFrame([("1", 5, "ACAG", "GCAG", "padded"), ("1", 5, "A", "C,G", "second"), ("1", 5, "A", "T", "other"), ("1", 9, "TAA", "TA", "deletion")], "chrom string, pos int, ref string, alt string, id string")
    df = spark.createDataFrame([("1", 5, "a", "T,G"), ("1", 5, "A", "C"), ("1", 9, "TA", "T"), ("2", 5, "A", "G")], "chrom string, pos int, ref string, alt string")
    found = {(r["chrom"], r["pos"], r["alt"]): {h["id"] for h in r["k"] if h["match"] == "exact"} for r in joins.annotate_known(df, database, "k").collect()}
    assert found == {("1", 5, "T,G"): {"padded", "second", "other"}, ("1", 5, "C"): {"second"}, ("1", 9, "T"): {"deletion"}, ("2", 5, "G"): set()}


# --- files ------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("/data/x.bed.gz", ("/data/x.bed.gz", (), 2, None, 0)), ("/data/x.bed.gz:4", ("/data/x.bed.gz", ("4",), 2, None, 0)), ("/data/x.bed.gz:7,8,9:1", ("/data/x.bed.gz", ("7", "8", "9"), 1, None, 0)),
        ("/data/x.bed.gz:4::--maxNrOfMatches=5", ("/data/x.bed.gz", ("4",), 2, 5, 0)), ('"/data/x.bedGraph.gz:::-breakPointMode -aEndOffset=1"', ("/data/x.bedGraph.gz", (), 2, None, 1)),
        ("hdfs://name:8020/a/x.bed:name,score:3", ("hdfs://name:8020/a/x.bed", ("name", "score"), 3, None, 0)), ("s3a://bucket/x.bed:4", ("s3a://bucket/x.bed", ("4",), 2, None, 0)), ("file:///a/x.bed", ("file:///a/x.bed", (), 2, None, 0)),
    ],
)
def test_track_specs(text, want):
    spec = variants.parse_track_spec(text)
    assert (spec.path, spec.columns, spec.level, spec.most, spec.end_offset) == want


def test_tracks_from_files(spark, tmp_path):
    (tmp_path / "r.bed").write_text("#chrom\tchromStart\tchromEnd\tname\tnormScore\tkind\n1\t0\t10\ta\t9.5\tx\n1\t5\t8\tb\t7\ty\n")
    spots = spark.createDataFrame([("p", "1", 6), ("p", "1", 11)], "pid string, chrom string, pos int")
    cells = lambda spec: [r["t"] for r in intervals.annotate_tracks(spots, {"t": variants.read_track(spark, f"{tmp_path}/{spec}")}).orderBy("pos").collect()]
    assert cells("r.bed") == ["a&b", "."] and cells("r.bed:4") == ["a;normScore=9.5&b;normScore=7", "."]
    assert cells("r.bed:4,5:1") == ["normScore=7;kind=y&normScore=9.5;kind=x", "."] and cells("r.bed::0") == ["1", "."]
    assert cells("r.bed:::--maxNrOfMatches=1") == ["a", "."] and cells("r.bed:::-aEndOffset=1") == ["a&b", "a"] and cells("r.bed::3") == ["1-10;a&6-8;b", "."]


def test_headers_of_each_file(spark, tmp_path):
    (tmp_path / "p1.vcf").write_text("##x\n#CHROM\tPOS\tREF\tALT\tQUAL\tFORMAT\tpatient1\tNote\n1\t5\ta\tG\t3.5\tGT\t0/1\tn\n")
    with gzip.open(tmp_path / "p2.vcf.gz", "wt") as f:
        f.write("#CHROM\tPOS\tGENE\tREF\tALT\tFORMAT\tother\tPID\n1\t6\tg\tA\tT\tGT\t1/1\tx\n1\t7\tg2\tA\tT\n")
    rows = variants.read_variants(spark, str(tmp_path)).orderBy("pos").collect()
    shown = [(r["pid"], r["pos"], r["ref"], r["qual"], r["gene"], r["sample"], r["note"], r["pid_1"]) for r in rows]
    assert shown == [("p1", 5, "A", 3.5, None, "0/1", "n", None), ("p2", 6, "A", None, "g", "1/1", None, "x"), ("p2", 7, "A", None, "g2", None, None, None)]
    few = variants.read_variants(spark, str(tmp_path), columns=["pos", "gene"])
    assert few.columns == ["pid", "pos", "gene"] and few.count() == 3
    with pytest.raises(ValueError, match="no #CHROM line"):
        (tmp_path / "none").mkdir()
        (tmp_path / "none" / "a.vcf").write_text("1\t2\n")
        variants.read_variants(spark, str(tmp_path / "none"))


GOLDEN = {
    "chrom": "1", "pos": 10051, "id": ".", "ref": "A", "alt": "C", "qual": "-0", "filter": "RE;TAC;HSDEPTH;MAP;FRQ",
    "info": "DP=121;VDB=3.572478e-02;RPB=-7.344126e-01;AF1=0;AC1=0;DP4=72,5,1,2;MQ=41;FQ=-218;PV4=0.019,0.00027,1,0.11", "format": "GT:PL:GQ", "sample": "1/1:0,191,255:99",
    "info_control": "DP=387;DP5=239,15,2,0,16;DP5all=269,75,2,3,38;ACGTNacgtnHQ=239,5,2,0,0,15,0,0,0,0;ACGTNacgtn=269,5,2,1,0,75,18,3,2,0;VAF=0.01;TSR=5;PBINOM=4.89276584292767e-78",
    "gene": "NONE(dist=NONE),DDX11L1(dist=1818)", "exonic_classification": ".", "annovar_transcripts": ".", "confidence": "1", "reclassification": "LQVSIG",
}
#: Info of the expected row, as a set of cells.
WANTED = "DP4=72,5,1,2;ACGTNacgtnHQ_ctrl=239,5,2,0,0,15,0,0,0,0;RECL=LQVSIG;DP_ctrl=387;DP5_ctrl=239,15,2,0,16;ANNOVARTR=.;MQ=41;EXONICCL=.;CONF=1;GENE=NONE(dist=NONE),DDX11L1(dist=1818);ACGTNacgtn_ctrl=269,5,2,1,0,75,18,3,2,0;DP=121"


def golden_meta() -> dict:
    of = lambda **k: {"number": "1", "type": "String", "description": "d", **k}
    plain = ("DP", "DP4", "MQ", "DP_ctrl", "DP5_ctrl", "ACGTNacgtnHQ_ctrl", "ACGTNacgtn_ctrl", "NEVER")
    free = {"GENE": "GENE", "EXONIC_CLASSIFICATION": "EXONICCL", "ANNOVAR_TRANSCRIPTS": "ANNOVARTR", "CONFIDENCE": "CONF", "RECLASSIFICATION": "RECL"}
    return {"__comment": "x", "INFO": {k: of() for k in plain} | {k: of(new_info_id=v) for k, v in free.items()} | {"__VDB": of()}, "FORMAT": {k: of() for k in ("GQ", "GT", "PL", "HQ")}, "FILTER": {"PASS": of(), "RE": of()}}


def test_a_whole_standard_file(spark, tmp_path):
    rows = [GOLDEN | {"pid": "patient007"}, GOLDEN | {"pid": "patient007", "chrom": "X", "pos": 3}, GOLDEN | {"pid": "patient007", "chrom": "10", "pos": 9}, GOLDEN | {"pid": "other", "filter": "PASS", "pos": 2}]
    df = spark.createDataFrame(rows).repartition(4)
    sinks.write_standard_files(df, f"{tmp_path}/out", golden_meta(), copied=("##reference=x", "##contig=<ID=1,length=249250621>"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "out" / "pid=patient007").glob("part-*")))
    lines = text.splitlines()
    ids = [x.split("ID=")[1].split(",")[0] for x in lines if x.startswith("##INFO")]
    assert ids == ["ACGTNacgtnHQ_ctrl", "ACGTNacgtn_ctrl", "ANNOVARTR", "CONF", "DP", "DP4", "DP5_ctrl", "DP_ctrl", "EXONICCL", "GENE", "MQ", "RECL"]
    assert lines[0] == "##fileformat=VCFv4.2" and [x.split("=")[0] for x in lines[13:]][:6] == ["##FILTER", "##FORMAT", "##FORMAT", "##FORMAT", "##reference", "##contig"]
    assert lines[19] == "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tpatient007"
    body = [x.split("\t") for x in lines[20:]]
    assert [(x[0], x[1]) for x in body] == [("1", "10051"), ("10", "9"), ("X", "3")]
    assert body[0][:7] == ["1", "10051", ".", "A", "C", "-0", "RE;TAC;HSDEPTH;MAP;FRQ"] and body[0][8:] == ["GT:PL:GQ", "1/1:0,191,255:99"]
    assert sorted(body[0][7].split(";")) == sorted(WANTED.split(";"))
    with pytest.raises(ValueError, match="no column"):
        sinks.standard_file(df.drop("gene"), golden_meta())


def test_short_spans_of_one_long_bin_are_not_compared(spark):
    spans = spark.range(300).selectExpr("'p' AS pid", "'1' AS chrom", "id * 5000 AS first", "id * 5000 + 3 AS last")
    one = spark.createDataFrame([("p", "1", 100, 10**6)], "pid string, chrom string, first bigint, last bigint")
    left, right = intervals._met(spans, spans, longer=0), intervals._met(spans, spans, longer=1)
    assert left.count() == right.count() == 300 + sum(x * 5000 >> 10 != x * 5000 + 3 >> 10 for x in range(300))
    met = left.join(right.withColumnsRenamed({c: f"{c}_b" for c in ("first", "last", "low")}), ["pid", "chrom", "bits", "longer", "bin"])
    assert met.count() < 320
    assert intervals.overlapping_spans(spans, one, on=["pid", "chrom"]).count() == intervals.overlapping_spans(one, spans, on=["pid", "chrom"]).count() == 200


def test_hits_that_no_track_reports_are_not_made(spark):
    whole = spark.range(3000).selectExpr("'1' AS chrom", "id % 3 AS start0", "240000000 - id AS end0", "concat('n', id) AS name")
    far = spark.createDataFrame([("1", 10, 2**60, "endless"), ("1", -5, 2, "early")], "chrom string, start0 bigint, end0 bigint, name string")
    spots = spark.range(2000).selectExpr("'1' AS chrom", "1 + id * 100000 AS pos")
    track = intervals.Track(whole, most=2)
    pieces = intervals._first_of_crowds(intervals._pieces(whole.selectExpr("chrom", "start0", "end0", "0 AS track", "name AS cell")), [2])
    assert pieces.where("bits >= 16").groupBy("bits", "bin").count().agg({"count": "max"}).first()[0] == 2
    got = intervals.annotate_tracks(spots, {"t": track, "f": intervals.Track(far), "seen": intervals.Track(whole, level=0)})
    assert {(r["t"], r["f"], r["seen"]) for r in got.where("pos > 3").collect()} == {("n0&n1", "endless", "1")}
    assert got.where("pos = 1").first()["f"] == "early" and got.count() == 2000


def test_no_read_is_paired_with_its_quality_as_a_row(spark):
    pileup = spark.createDataFrame([("p", "1", 5, "A", "+1A.,+2acG$^++N", "I!.II")], PILEUP)
    counts = control.control_counts(pileup)
    assert "arrays_zip" not in counts._jdf.queryExecution().optimizedPlan().toString()
    row = counts.first()
    assert (row["nq"], row["hq_indels"], row["nq_indels"]) == ([1, 0, 1, 0, 1, 0, 0, 0, 0, 0], [], ["+2ac"])
    assert (row["dp"], row["hq_reads"], row["hq"]) == (5, 4, [1, 0, 1, 0, 1, 0, 0, 0, 0, 0])


def test_pileup_strings_are_cut_once_a_row(spark):
    counts = control.control_counts(spark.createDataFrame([("p", "1", 5, "A", ".,+2ACg*N", "I.-I!"), ("p", "1", 6, "A", ".c", "II")], PILEUP))
    assert counts._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract(") == 1
    assert [(r["nq_indels"], r["nq"][0]) for r in counts.orderBy("pos").collect()] == [(["+2AC"], 1), ([], 1)]
