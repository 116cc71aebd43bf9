"""Separator scans against plain counts, for every way that blocks can cut documents."""

import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from strandline.llm import bpe, token_files

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
END = 50256


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as f:
        return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.parse_ranks(f.read()), special_tokens={})


@pytest.mark.parametrize(("block", "width"), [(1, 2), (3, 4), (8, 2), (1000, 4)])
def test_flat_files(spark, tmp_path, block, width):
    rnd = random.Random(block)
    want = set()
    for f in range(4):
        tokens, number = [], 0
        for number in range(rnd.randint(0, 25)):
            n = rnd.choice([0, 0, 1, 2, 7, 40])
            tokens += [rnd.randrange(9) for _ in range(n)] + [9]
            want.add((f, number, n, True))
        if f % 2:
            last = sum(1 for w in want if w[0] == f)
            tokens += [1] * 5
            want.add((f, last, 5, False))
        np.array(tokens, token_files.WIDTHS[width]).tofile(tmp_path / f"{f}.bin")
    (tmp_path / "empty.bin").touch()
    scanned = token_files.scanned_files(spark, str(tmp_path), end=9, width=width, block_tokens=block, task_bytes=40)
    got = token_files.document_lengths(scanned).collect()
    assert {(int(r["file"][-5]), r["number"], r["n_tokens"], r["closed"]) for r in got} == want and len(got) == len(want)


def test_a_size_that_is_no_multiple_of_the_width(spark, tmp_path):
    (tmp_path / "odd.bin").write_bytes(b"abc")
    with pytest.raises(Exception, match="no multiple of 2"):
        token_files.scanned_files(spark, str(tmp_path), end=9).collect()


@pytest.mark.parametrize("block", [3, 700, 1 << 18])
def test_documents_against_the_library(spark, library, block):
    texts = [None, "", "one", "some words " * 300, "", "x", None, "漢字 🙂", "some words " * 300, "very long text, " * 20_000]
    keys = [0, 1, 1, None, 4, None, 6, 7, 8, 9]  # null and repeated ones
    df = spark.createDataFrame([(k, t, 1, "a", 2) for k, t in zip(keys, texts)], "doc_id bigint, text string, n_tokens int, file string, number int").repartition(3)
    found = token_files.count_documents(df, PATH, public_tokenizers.PATTERN, end=END, space_led=True, block_tokens=block)
    assert found.columns == ["doc_id", "n_tokens"]
    got = sorted((str(r["doc_id"]), r["n_tokens"]) for r in found.collect())
    assert got == sorted((str(k), len(library.encode_ordinary(t or ""))) for k, t in zip(keys, texts))


def test_no_rows(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert token_files.count_documents(df, PATH, public_tokenizers.PATTERN, end=END).count() == 0


def test_what_a_lost_task_left_is_not_read(spark, tmp_path):
    """A file of odd size that the manifest doesn't name stays where it is, unread."""
    np.array([5, 5, 9, 9], "<u2").tofile(tmp_path / "good.bin")
    (tmp_path / "orphan.bin").write_bytes(b"abc")
    named = spark.createDataFrame([("good.bin",)], "file string")
    rows = token_files.document_lengths(token_files.scanned_files(spark, str(tmp_path), end=9, named=named)).collect()
    assert sorted((r["file"].split("/")[-1], r["number"], r["n_tokens"]) for r in rows) == [("good.bin", 0, 2), ("good.bin", 1, 0)]
    with pytest.raises(Exception, match="no multiple of 2"):
        token_files.scanned_files(spark, str(tmp_path), end=9).collect()


def test_ids_beyond_the_width(spark):
    counts = np.array([2, 0, 1])
    assert token_files.closed_line(np.array([65_535, 7, 8]), counts, 9, token_files.WIDTHS[2]).tolist() == [65_535, 7, 9, 9, 8, 9]
    with pytest.raises(ValueError, match="65536 needs more than 2 bytes"):
        token_files.closed_line(np.array([65_536, 7, 8]), counts, 9, token_files.WIDTHS[2])
    assert token_files.closed_line(np.array([65_536, 7, 8]), counts, 9, token_files.WIDTHS[4])[0] == 65_536
    df = spark.createDataFrame([(1, "x")], "doc_id bigint, text string")
    with pytest.raises(ValueError, match="70000 needs more than 2 bytes"):
        token_files.count_documents(df, PATH, public_tokenizers.PATTERN, end=70_000)
