"""Queries over whole tables against plain loops over the fixtures."""

from collections import Counter

import __spark_entry__
from strandline.plans import fixtures
from tests.test_queries import SF_DIR, pytestmark  # noqa: F401


def test_explode_pileup_of_every_variant(spark):
    want = Counter()
    for v in fixtures.snv(spark, SF_DIR).collect():
        for i in range(v["crf"] + 1):
            want[v["pid"], v["chrom"], v["pos"], v["ref"] if i % 2 == 0 else v["ref"].lower(), (i * 7 + v["pos"]) % 40, i] += 1
    assert Counter(tuple(r) for r in __spark_entry__.queries()["explode_pileup_all"](spark, SF_DIR).collect()) == want


def test_compare_control_reads_every_position(spark):
    depth = Counter((r["pid"], r["chrom"], r["pos"]) for r in fixtures.reads(spark, SF_DIR).select("pid", "chrom", "pos").collect())
    got = __spark_entry__.queries()["compare_control_all"](spark, SF_DIR).collect()
    assert len(got) == fixtures.snv(spark, SF_DIR).count()
    assert all(r["dp"] == depth[r["pid"], r["chrom"], r["pos"]] for r in got)


def test_union_of_every_chromosome(spark):
    rows = fixtures.snv(spark, SF_DIR).select("pid", "chrom", "pos", "qual").collect()
    want = Counter((r["pid"], r["chrom"], r["pos"], None if r["chrom"] in ("2", "Y") else r["qual"]) for r in rows)
    got = __spark_entry__.queries()["union_all_chromosomes"](spark, SF_DIR).select("pid", "chrom", "pos", "qual").collect()
    assert Counter(map(tuple, got)) == want and len({r["chrom"] for r in got}) == 24
