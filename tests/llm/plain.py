"""Rows of the given tables for plain versions."""

import os

import pyarrow.parquet as pq


def plain_rows(name: str) -> list[dict]:
    return pq.read_table(f"{plain_rows.folder}/{name}.parquet").to_pylist()


plain_rows.folder = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
