"""Language identification by nearest centroids of TF-IDF character n-grams.

Texts become vectors of hashed n-grams (one to three characters, lower case, anything but letters as a single break),
log counts times inverse document frequencies, of length one.  Spherical k-means gives several centroids for each
language; a text gets the language of the centroid with the largest cosine.  A text whose cosine with that centroid is
below the limit of its language (half of the least cosine that the language's training texts have with their nearest
centroid) is rejected as too far from all languages.

The model is fitted on a bounded sample of labelled rows: about ``PER_LANGUAGE`` for each language, and about ``SAMPLE_ROWS``
in all where there are many languages.  Every row is classified, by its text alone.

Rows: a null text, or one without a letter, is ``und`` with score 0 and rejected.  Rows with a null or blank language
teach nothing; with no labelled row at all every text is ``und``.  A very long text is hashed in stretches.  Of equal cosines
the first centroid wins, in the order of languages (ties).  Repeated rows get equal results; an empty table gives no
rows.  Extra columns, also of the names used here, stay (`reject_unknown`) or are not looked at (`predict`).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.llm._tables import give_back, ship_package

UNKNOWN = "und"
#: Hash buckets of n-grams.
BUCKETS = 4096
#: Labelled texts that are used of each language, on average.
PER_LANGUAGE = 300
#: Labelled texts that are used in all, on average (at most 16 kB each on the driver).
SAMPLE_ROWS = 20_000
#: Centroids for each language, at most.
CENTROIDS = 4
ROUNDS = 12
#: Characters that are hashed at once.
STRETCH = 1 << 18
LETTER = regex.compile(r"\p{L}")

_letters: np.ndarray | None = None


def _letter_table() -> np.ndarray:
    """1 for code points that are letters."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(k).isalpha() for k in range(0x110000)), np.bool_, 0x110000)
    return _letters


def counts(text: str) -> np.ndarray:
    """Counts of hashed n-grams of a whole text."""
    total = np.zeros(BUCKETS, np.int64)
    text = f" {text.lower()} "
    for start in range(0, len(text), STRETCH):
        # two characters of the stretch before complete the n-grams that end in this one
        points = np.frombuffer(text[max(0, start - 2) : start + STRETCH].encode("utf-32-le", "surrogatepass"), np.uint32)
        points = np.where(_letter_table()[points], points, 32).astype(np.uint64)
        skip = min(start, 2)
        one = points * np.uint64(0x9E3779B97F4A7C15)
        two = (points[:-1] * np.uint64(0xC2B2AE3D27D4EB4F)) ^ (points[1:] * np.uint64(0x165667B19E3779F9))
        three = (points[:-2] * np.uint64(0x85EBCA77C2B2AE63)) ^ (two[1:] * np.uint64(0x27D4EB2F165667C5))
        for grams, size in ((one, 1), (two, 2), (three, 3)):
            fresh = grams[max(0, skip - size + 1) :]
            total += np.bincount((fresh >> np.uint64(52)).astype(np.int64), minlength=BUCKETS)
    return total


@dataclass
class Model:
    languages: list[str]  # of each centroid
    centroids: np.ndarray
    limits: np.ndarray
    idf: np.ndarray

    def vector(self, text: str) -> np.ndarray:
        return weighted(counts(text)[None, :], self.idf)[0]

    def classify(self, text: str | None) -> tuple[str, float, bool]:
        """Language, cosine in 0..1, rejected."""
        if not text or not self.languages or not LETTER.search(text):
            return UNKNOWN, 0.0, True
        cosines = self.centroids @ self.vector(text)
        best = int(np.argmax(cosines))
        return self.languages[best], float(min(1.0, max(0.0, cosines[best]))), bool(cosines[best] < self.limits[best])


def weighted(raw: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF rows of length one (zero rows stay)."""
    x = np.log1p(raw).astype(np.float32) * idf
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def _clusters(x: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means; begins with rows far from one another, so that it needs no chance."""
    centres = [x.mean(axis=0)]
    nearest = np.full(len(x), -np.inf)
    for _ in range(k):
        centres.append(x[int(np.argmin(np.maximum(nearest, x @ centres[-1])))])
        nearest = np.maximum(nearest, x @ centres[-1])
    c = np.array(centres[1:])
    for _ in range(ROUNDS):
        which = np.argmax(x @ c.T, axis=1)
        c = np.array([x[which == j].mean(axis=0) if (which == j).any() else c[j] for j in range(len(c))])
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-9)
    return c


def fit_vectors(raw: np.ndarray, languages: list[str]) -> Model:
    """A model from n-gram counts of labelled texts."""
    if not len(raw):
        return Model([], np.zeros((0, BUCKETS), np.float32), np.zeros(0), np.zeros(BUCKETS, np.float32))
    idf = np.log((1 + len(raw)) / (1 + (raw > 0).sum(axis=0))).astype(np.float32) + 1
    x, names = weighted(raw, idf), np.array(languages)
    labels, centres, limits = [], [], []
    for language in sorted(set(languages)):
        own = x[names == language]
        c = _clusters(own, min(CENTROIDS, len(own)))
        labels += [language] * len(c)
        centres += list(c)
        limits += [0.5 * float((own @ c.T).max(axis=1).min())] * len(c)
    return Model(labels, np.array(centres, np.float32), np.array(limits), idf)


def held_out(key: Column) -> Column:
    """Rows that are never learned from: crc32 of the key as text divisible by 5."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def fit(df: DataFrame, *, key: str = "doc_id", text: str = "text", lang: str = "lang", per_language: int = PER_LANGUAGE) -> Model:
    """A model from a sample of the rows of ``df`` that are not held out and have a language.

    Rows are chosen by a hash of the key, at a rate for each language that expects ``per_language`` rows (fewer where
    that is more than ``SAMPLE_ROWS`` in all).  Only the n-gram counts of the chosen rows come to the driver.
    """
    ship_package(df.sparkSession)
    labelled = df.select(df[key].alias("key"), df[text].alias("text"), df[lang].alias("lang")).where((F.trim("lang") != "") & ~held_out(F.col("key")))
    sizes = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}  # a row for each language
    if not sizes:
        return fit_vectors(np.zeros((0, BUCKETS), np.int64), [])
    per_language = min(per_language, max(1, SAMPLE_ROWS // len(sizes)))
    rate = F.lit(0.0)
    for language, n in sizes.items():
        rate = F.when(F.col("lang") == language, F.lit(min(1.0, per_language / n))).otherwise(rate)
    unit = F.pmod(F.xxhash64("key", F.lit("language sample")), F.lit(1 << 30)) / (1 << 30)
    chosen = labelled.where((unit < rate) & F.col("text").isNotNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [counts(x.as_py()).astype(np.int32).tobytes() for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(rows, pa.binary())], ["key", "lang", "counts"])

    kind = df.schema[key].dataType.simpleString()
    few = chosen.mapInArrow(run, f"key {kind}, lang string, counts binary").collect()
    few.sort(key=lambda r: (r["lang"], r["key"], bytes(r["counts"])))
    raw = np.array([np.frombuffer(r["counts"], np.int32) for r in few]).reshape(len(few), BUCKETS)
    return fit_vectors(raw, [r["lang"] for r in few])


def classifier(df: DataFrame, model: Model, text: str = "text") -> Column:
    """A struct column of ``df``: lang_pred, score, rejected.  Only the text goes to Python workers."""
    spark = df.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(model)  # a few centroids for each language
    kind = pa.struct([("lang_pred", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_())])

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = shared.value
        for batch in batches:
            found = [model.classify(x.as_py()) for x in batch]
            names, scores, rejected = zip(*found) if found else ((), (), ())
            columns = [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())]
            yield pa.StructArray.from_arrays(columns, fields=list(kind))
        give_back()

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "lang_pred string, score double, rejected boolean")(df[text])


def predict(df: DataFrame, model: Model, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, held_out, lang_pred, score, rejected of every row.  One pass, no shuffle."""
    found = df.select(df[key].alias("key"), classifier(df, model, text).alias("found"))
    return found.select(F.col("key").alias(key), held_out(F.col("key")).alias("held_out"), "found.lang_pred", F.round("found.score", 6).alias("score"), "found.rejected")


def reject_unknown(df: DataFrame, model: Model, *, text: str = "text") -> DataFrame:
    """The rows of ``df`` that are near enough to a known language, columns unchanged."""
    return df.where(~classifier(df, model, text)["rejected"])
