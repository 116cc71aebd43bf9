"""Every registered query with SQL gives the same rows as a relational database on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no tables here")


@pytest.fixture(scope="module")
def database():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def shown(value):
    if value is None or value != value:
        return "NULL"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float)) or hasattr(value, "as_integer_ratio"):
        return repr(round(float(value), 6) + 0.0)
    return str(value)


@pytest.mark.parametrize("name", sorted(__spark_entry__.oracle_sql()))
def test_same_rows(spark, database, name):
    frame = __spark_entry__.queries()[name](spark, SF_DIR)
    columns = sorted(frame.columns)
    result = database.execute(__spark_entry__.oracle_sql()[name])
    names = [d[0] for d in result.description]
    want = sorted(tuple(shown(row[names.index(c)]) for c in columns) for row in result.fetchall())
    assert sorted(names) == columns
    assert sorted(tuple(shown(row[c]) for c in columns) for row in frame.collect()) == want
    assert want


def test_queries_without_sql_run(spark):
    for name in ("two_round_bias_filter", "purity_esd", "triplet_bq_shift_p", "write_pancan_variants", "pipeline_annotate", "pipeline_filter_rerun", "pipeline_call", "pipeline_deep_annotate", "write_by_class"):
        assert __spark_entry__.queries()[name](spark, SF_DIR).limit(1).count() == 1, name


def test_entry(spark):
    assert __spark_entry__.entry(spark).limit(1).count() == 1


def test_every_sql_has_a_query():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
