"""Token counts of documents in flat, unindexed token files.

A file is a line of token ids of fixed width; documents follow one another, each closed by an end-of-document id.  A
file of any size is cut in byte ranges, which tasks read on their own and which know nothing of document borders.  Each
block is searched for separators at once (numpy over the whole block) and gives its number of tokens and the
separators' places.  Running sums and maxima over a file's blocks (one short row a block) then tell where each block
begins, how many documents are closed before it, and where the last separator before it stands; so counts of documents
that span blocks are stitched together without reading tokens again.

`write_token_files` makes such files from texts, each task one of its own in the shared folder, and says which key each
document in a file has.  A task that is run again writes a file of a new name; the manifest, which Spark commits, names
only those of tasks that ended well, and only these files are scanned, so that what a lost executor left behind is neither read nor counted.

Rows: a null or empty text is a document without tokens and counts 0; a document of any length may span any number of
blocks; repeated rows are documents each; null and repeated keys are carried along (ties: nothing is ordered by key);
tokens behind a file's last separator are a last document that is not closed; an empty file or table gives no rows; a file
whose size is no multiple of the width is an error, and so is an id that the width can't hold; extra columns, also of the names used here, are not looked at.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from strandline.llm._tables import shared_dir, ship_package, stored
from strandline.llm.bpe import read_vocabulary, slices, worker_coder

#: Tokens in a block.
BLOCK_TOKENS = 1 << 18
#: Bytes that a task reads, on average.
TASK_BYTES = 16 << 20
WIDTHS = {2: np.dtype("<u2"), 4: np.dtype("<u4")}


def opened(uri: str) -> tuple[pa.fs.FileSystem, str]:
    """The store and the path in it of a URI as Spark writes it (local or mounted, HDFS, S3, GCS)."""
    uri = re.sub("^s3[an]:", "s3:", re.sub("^file:/+", "/", uri))
    return pa.fs.FileSystem.from_uri(uri)


def closed_line(ids: np.ndarray, counts: np.ndarray, end: int, dtype: np.dtype) -> np.ndarray:
    """Ids of documents of ``counts`` ids each, one after the other, each closed by ``end``."""
    if len(ids) and int(ids.max()) > np.iinfo(dtype).max:
        raise ValueError(f"id {int(ids.max())} needs more than {dtype.itemsize} bytes")
    line = np.full(len(ids) + len(counts), end, dtype)
    line[np.arange(len(ids)) + np.repeat(np.arange(len(counts)), counts)] = ids
    return line


def write_token_files(
    df: DataFrame, folder: str, path: str, pattern: str, *, end: int, space_led: bool = False, key: str = "doc_id", text: str = "text", width: int = 2
) -> DataFrame:
    """Lazily writes the ids of the texts of ``df``, each text closed by ``end``, as flat files in ``folder``.

    Gives the manifest, a row for each document: file (its name in the folder), number (in the file, from 0) and key.
    """
    kind = df.schema[key].dataType.simpleString()
    vocabulary = read_vocabulary(df, path)
    dtype = WIDTHS[width]
    if not 0 <= end <= np.iinfo(dtype).max:
        raise ValueError(f"id {end} needs more than {width} bytes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = worker_coder(vocabulary, pattern, space_led)
        store, place = opened(folder)
        store.create_dir(place, recursive=True)
        name, number, out = f"{uuid.uuid4().hex}.bin", 0, None
        for batch in batches:
            for begin, stop in slices(batch.column(1)):
                ids, edges = coder.encode_all(batch.column(1).slice(begin, stop - begin))
                n = stop - begin
                line = closed_line(ids, np.diff(edges), end, dtype)
                out = out or store.open_output_stream(f"{place}/{name}")
                out.write(line.tobytes())
                numbers = pa.array(np.arange(number, number + n))
                yield pa.RecordBatch.from_arrays([pa.array([name] * n), numbers, batch.column(0).slice(begin, n)], ["file", "number", "key"])
                number += n
            pa.default_memory_pool().release_unused()  # the worker lives on
        if out:
            out.close()

    return df.select(df[key].alias("key"), df[text].alias("text")).mapInArrow(run, f"file string, number bigint, key {kind}")


def scanned_files(
    spark: SparkSession, path: str, *, end: int, width: int = 2, block_tokens: int = BLOCK_TOKENS, task_bytes: int = TASK_BYTES, named: DataFrame | None = None
) -> DataFrame:
    """file, block, n (tokens) and ends (places of separators inside the block) of the flat files at ``path``.

    Spark lists the files and their sizes; tasks read byte ranges.  ``named``: only files whose names its column file has.
    """
    ship_package(spark)
    dtype, size = WIDTHS[width], block_tokens * width
    files = spark.read.format("binaryFile").load(path).select("path", "length")  # does not read contents
    if named is not None:
        files = files.join(named.select("file").distinct(), F.element_at(F.split("path", "/"), -1) == F.col("file"), "left_semi")
    total = files.agg(F.sum("length").alias("n")).first()["n"] or 0
    starts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("length") - 1, F.lit(size).cast("bigint")))
    ranges = files.where("length > 0").select("path", "length", starts.alias("start"))
    ranges = ranges.repartition(max(spark.sparkContext.defaultParallelism, -(-total // task_bytes)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, length, start in zip(*(c.to_pylist() for c in batch.columns)):
                if length % width:
                    raise ValueError(f"{file} has {length} bytes, which is no multiple of {width}")
                store, place = opened(file)
                with store.open_input_file(place) as f:
                    tokens = np.frombuffer(f.read_at(min(size, length - start), start), dtype)
                ends = pa.array([np.flatnonzero(tokens == end)], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array([file]), pa.array([start // size]), pa.array([len(tokens)]), ends], ["file", "block", "n", "ends"])

    return ranges.mapInArrow(run, "file string, block bigint, n bigint, ends array<bigint>")


def document_lengths(scanned: DataFrame) -> DataFrame:
    """file, number (of the document in its file, from 0), n_tokens and closed of every document in scanned blocks."""
    scanned = stored(scanned)
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    short = scanned.select("file", "block", "n", F.size("ends").cast("bigint").alias("n_ends"), F.try_element_at("ends", F.lit(-1)).alias("last_end"))
    placed = short.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0)))
    placed = placed.withColumn("last", F.col("start") + F.col("last_end"))
    placed = placed.withColumns({"closed_before": F.coalesce(F.sum("n_ends").over(before), F.lit(0)), "end_before": F.coalesce(F.max("last").over(before), F.lit(-1))})
    placed = stored(placed)
    each = scanned.where(F.size("ends") > 0).select("file", "block", "ends").join(placed.select("file", "block", "start", "closed_before", "end_before"), ["file", "block"])
    # each separator with the one before it; in front of a block's first stands the last of the blocks before
    ends = F.transform("ends", lambda e: e + F.col("start"))
    borders = F.zip_with(ends, F.concat(F.array("end_before"), ends), lambda e, p: F.when(e.isNotNull(), e - p - 1))
    counted = each.select("file", "closed_before", F.posexplode(borders).alias("k", "n_tokens")).where("n_tokens IS NOT NULL")
    closed = counted.select("file", (F.col("closed_before") + F.col("k")).alias("number"), "n_tokens", F.lit(True).alias("closed"))
    rest = placed.groupBy("file").agg(F.sum("n").alias("n"), F.max("last").alias("last"), F.sum("n_ends").alias("number"))
    rest = rest.withColumn("n_tokens", F.col("n") - F.coalesce("last", F.lit(-1)) - 1).where("n_tokens > 0")
    return closed.unionByName(rest.select("file", "number", "n_tokens", F.lit(False).alias("closed")))


def count_documents(df: DataFrame, path: str, pattern: str, *, end: int, space_led: bool = False, key: str = "doc_id", text: str = "text", width: int = 2, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """``key`` and n_tokens of every row of ``df``: written to flat files, and counted by scanning these."""
    spark = df.sparkSession
    folder = f"{shared_dir(spark)}/tokens-{uuid.uuid4().hex}"
    manifest = stored(write_token_files(df, folder, path, pattern, end=end, space_led=space_led, key=key, text=text, width=width))
    if manifest.isEmpty():
        return manifest.select(F.col("key").alias(key), F.lit(0).cast("bigint").alias("n_tokens"))
    lengths = document_lengths(scanned_files(spark, folder, end=end, width=width, block_tokens=block_tokens, named=manifest))
    lengths = lengths.select(F.element_at(F.split("file", "/"), -1).alias("file"), "number", "n_tokens")
    return manifest.join(lengths, ["file", "number"]).select(F.col("key").alias(key), "n_tokens")
