"""From raw documents to token ids: language ID, quality rules, near-duplicates, mixing, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and works on every row that the stage before kept; all but the last return the
columns of ``docs``.  Between stages the rows are written as Parquet to the shared folder and read again, so that a
lost executor costs no earlier stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from strandline.llm import bpe, langid, mixing, near_copies, quality
from strandline.llm._tables import stored, table

#: No SQL: XXH64, byte-pair merges and fitted centroids can't be expressed; tests/llm holds a brute-force version.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents near enough to a language of the labelled ones; others (no letters, no text, no known language) go."""
    return langid.reject_unknown(docs, langid.fit(docs))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule rejects."""
    return quality.quality_filter(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, a similarity of 0.8 or more."""
    return near_copies.drop_near_copies(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many tokens as before, shared out anew: documents of large sources go, those of small ones repeat."""
    return mixing.mix(docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source and the ids of every row, with digests of the ids and of the bytes decoded from them."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.encode_documents(docs, path, public_tokenizers.PATTERN, space_led=True, keep=["doc_id", "lang", "source"])


STAGES = [
    ("language_id", language_id),
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("source_mixing", source_mixing),
    ("byte_bpe", byte_bpe),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = stored(docs)
    return docs
