"""Language identification: held-out accuracy, rejection, independence of other columns."""

import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandline.llm import langid

SYLLABLES = {"aa": ["ka", "ro", "mi", "ten", "lu"], "bb": ["sch", "ein", "ung", "ver", "keit"], "cc": ["ción", "que", "ado", "ll", "ez"]}


def made(seed=1, n=240):
    rnd = random.Random(seed)
    rows = []
    for k in range(n):
        lang = rnd.choice(list(SYLLABLES))
        words = ["".join(rnd.choice(SYLLABLES[lang]) for _ in range(rnd.randint(1, 4))) for _ in range(rnd.randint(5, 60))]
        rows.append((k, " ".join(words), lang))
    return rows


@pytest.fixture(scope="module")
def labelled(spark):
    return spark.createDataFrame(made(), "doc_id bigint, text string, lang string").repartition(3).cache()


@pytest.fixture(scope="module")
def model(labelled):
    return langid.fit(labelled)


def test_held_out_accuracy(labelled, model):
    rows = langid.predict(labelled, model).join(labelled, "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == 240 and {r["doc_id"] for r in held} == {k for k in range(240) if zlib.crc32(str(k).encode()) % 5 == 0}
    assert sum(r["lang"] == r["lang_pred"] for r in held) / len(held) > 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)


def plain_counts(text):
    """Hashed n-grams of one to three characters, one after the other."""
    points = [ord(c) if c.isalpha() else 32 for c in f" {text.lower()} "]
    mask, total = 2**64 - 1, [0] * langid.BUCKETS
    two_of = lambda a, b: ((a * 0xC2B2AE3D27D4EB4F) ^ (b * 0x165667B19E3779F9)) & mask
    for k, p in enumerate(points):
        grams = [p * 0x9E3779B97F4A7C15 & mask]
        if k >= 1:
            grams.append(two_of(points[k - 1], p))
        if k >= 2:
            grams.append(((points[k - 2] * 0x85EBCA77C2B2AE63) ^ (two_of(points[k - 1], p) * 0x27D4EB2F165667C5)) & mask)
        for g in grams:
            total[g >> 52] += 1
    return total


def test_predictions_against_loops(labelled, model):
    texts = {r["doc_id"]: r["text"] for r in labelled.collect()}
    for r in langid.predict(labelled, model).collect():
        x = [math.log1p(n) * float(i) for n, i in zip(plain_counts(texts[r["doc_id"]]), model.idf)]
        length = math.sqrt(sum(v * v for v in x))
        cosines = [sum(a * float(b) for a, b in zip(x, c)) / length for c in model.centroids]
        best = max(range(len(cosines)), key=lambda k: cosines[k])
        assert abs(r["score"] - cosines[best]) < 1e-4
        assert r["lang_pred"] == model.languages[best] or sorted(cosines)[-2] > cosines[best] - 1e-5


def test_ties_go_to_the_first_language():
    raw = np.array([plain_counts("ka ro mi"), plain_counts("ka ro mi")])
    assert langid.fit_vectors(raw, ["yy", "xx"]).classify("ka ro")[0] == "xx"


def test_learns_nothing_from_held_out_rows(spark, labelled):
    relabelled = labelled.withColumn("lang", F.when(langid.held_out(F.col("doc_id")), "zz").otherwise(F.col("lang")))
    assert "zz" not in langid.fit(relabelled).languages


def test_a_prediction_depends_on_the_text_alone(spark, labelled, model):
    moved = labelled.select((F.col("doc_id") + 1000).alias("doc_id"), "text", F.lit("zz").alias("lang"))
    one = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.predict(labelled, model).collect()}
    other = {r["doc_id"] - 1000: (r["lang_pred"], r["score"]) for r in langid.predict(moved, model).collect()}
    assert one == other


def test_odd_texts(spark, model):
    texts = [None, "", "123 ... !!", "ka", "x" * 300_000, "漢字かな", "ka ro mi ka ro mi ten lu"]
    df = spark.createDataFrame([(k, t, "clash") for k, t in enumerate(texts)], "doc_id bigint, text string, score string")
    got = {r["doc_id"]: r for r in langid.predict(df, model).collect()}
    assert [got[k]["lang_pred"] for k in range(3)] == ["und"] * 3 and all(got[k]["rejected"] for k in range(3))
    assert got[5]["lang_pred"] in SYLLABLES and got[5]["rejected"]
    assert got[6]["lang_pred"] == "aa" and not got[6]["rejected"]
    kept = langid.reject_unknown(df, model)
    assert kept.columns == df.columns and 6 in {r["doc_id"] for r in kept.collect()} and not {0, 1, 2, 5} & {r["doc_id"] for r in kept.collect()}


def test_counts_do_not_depend_on_stretches(monkeypatch):
    text = " ".join(t for _, t, _ in made(3, 40))
    whole = langid.counts(text)
    monkeypatch.setattr(langid, "STRETCH", 97)
    assert np.array_equal(langid.counts(text), whole)


def test_without_labels_and_rows(spark):
    df = spark.createDataFrame([(1, "some text", None), (2, "more", " ")], "doc_id bigint, text string, lang string")
    model = langid.fit(df)
    assert {r["lang_pred"] for r in langid.predict(df, model).collect()} == {"und"}
    empty = df.where("doc_id > 5")
    assert langid.predict(empty, langid.fit(empty)).count() == 0
