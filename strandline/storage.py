"""Shared storage between stages, and sending this package to Python workers."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    ``spark.checkpoint.dir`` as the session has it.  Only where it is unset: a temporary folder in local mode
    (one machine), and a folder under the warehouse elsewhere.
    """
    context = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not path:
        if context.master.startswith("local[") or context.master == "local":
            path = tempfile.mkdtemp(prefix="spark-checkpoints-")
        else:
            path = f"{spark.conf.get('spark.sql.warehouse.dir')}/_checkpoints"
        context.setCheckpointDir(path)
    return path.rstrip("/")


def stored(df: DataFrame, partition_hint: int | None = None) -> DataFrame:
    """``df`` written once to the shared folder as Parquet and read back.

    Cuts the lineage so that a lost executor costs a re-read, not a re-computation.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/stored-{uuid.uuid4().hex}"
    (df.coalesce(partition_hint) if partition_hint else df).write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def short_methods(spark: SparkSession) -> Iterator[None]:
    """Inside, stages that Spark would make one Java method of more than 8,000 bytes of run as methods of their own for each expression.

    HotSpot compiles no longer method: rows of many columns made in one stage would be interpreted, some ten times slower.
    The session's own setting, if there is one below that, is left, and what was there comes back.
    """
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(min(8000, int(before or 8000))))
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers that have no installed copy; once for each application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    _shipped.add(context.applicationId)
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="package-")) / f"{package.name}.zip"  # Spark sends it from here
    with zipfile.ZipFile(archive, "w") as z:
        for source in sorted(package.rglob("*.py")):
            z.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
