"""Small helpers that the corpus operators share: shared storage, free column names, table access."""

from __future__ import annotations

import ctypes

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.storage import shared_dir, ship_package, stored

__all__ = ["WORD_BREAKS", "dealt_join", "free_name", "give_back", "let", "shared_dir", "ship_package", "stored", "table"]

#: Bytes at \x20 and \x09-\x0D separate words; everything else belongs to a word.
WORD_BREAKS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` doesn't have (compared as Spark does, without case)."""
    taken = {c.lower() for c in df.columns}
    name, k = base, 0
    while name.lower() in taken:
        k += 1
        name = f"{base}_{k}"
    return name


def let(value, body):
    """``body(value)`` with ``value`` evaluated once per row (a bound lambda variable, not a repeated subtree)."""
    return F.element_at(F.transform(F.array(value), body), 1)


#: Names with the most rows that are joined by a broadcast, and the rows from which a name is one of them.
HOT_NAMES = 1_000
HOT_ROWS = 1_000


def dealt_join(rows: DataFrame, named: DataFrame, on: list[str]) -> DataFrame:
    """``rows`` with what ``named`` (one row for each value of ``on``; n: how many rows it has) says of them.

    A name that many rows share would send them all to one task.  So the ``HOT_NAMES`` names with the most rows are broadcast, and
    their rows stay where they are; each of the others has less than one in ``HOT_NAMES`` of all rows, or few.
    """
    hot = F.broadcast(named.where(F.col("n") > HOT_ROWS).orderBy(F.desc("n"), *on).limit(HOT_NAMES))
    others = rows.join(hot.select(*on), on, "left_anti").join(named.drop("n"), on)
    return rows.join(hot.drop("n"), on).unionByName(others)


_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """Gives memory that a task has freed back to the machine: its worker lives on, beside those of stages to come."""
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)
