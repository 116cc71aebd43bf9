"""Byte-level BPE: against the public library, and by an exact round trip."""

import hashlib
import random
import weakref

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from strandline.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
TEXTS = [None, "", " ", "  \n\n x", "Hello world, it's 3 o'clock!", "<|endoftext|>", "ünïcödé 漢字 🙂🙂", "a" * 5000, " \t" * 400 + "x", "Hello world, it's 3 o'clock!", "\x1c\x1d² Ⅷ"]


@pytest.fixture(scope="module")
def ranks():
    with open(PATH, "rb") as f:
        return bpe.parse_ranks(f.read())


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def coder(ranks):
    return bpe.TextCoder(ranks, public_tokenizers.PATTERN, space_led=True)


def test_random_texts(coder, library):
    rnd = random.Random(3)
    for _ in range(2000):
        text = "".join(rnd.choice("abcdefgh  \n\t019'ßé漢🙂.,!-st") for _ in range(rnd.randint(0, 50)))
        assert coder.encode(text) == library.encode_ordinary(text)


def test_many_texts_at_once(coder, library):
    rnd = random.Random(4)
    texts = ["".join(rnd.choice(["word", "Words", "x", " ", " ", " ", ".", ",\n", "'s", "12", "é", "z" * 60, "!?"]) for _ in range(rnd.randint(0, 40))) for _ in range(500)]
    ids, edges = coder.encode_all(pa.array([*texts, None], pa.string()))
    assert [ids[a:b].tolist() for a, b in zip(edges, edges[1:])] == [library.encode_ordinary(t) for t in [*texts, ""]]


def test_digests_in_parts(coder, library, monkeypatch):
    monkeypatch.setattr(bpe, "IDS_AT_ONCE", 7)
    texts = ["", "some words, and more of them", "", "x", "another text that has more than a few ids in it", ""]
    found = coder.encode_all(pa.array(texts))
    ids = [library.encode_ordinary(t) for t in texts]
    assert coder.digests(*found) == [hashlib.sha256(" ".join(map(str, x)).encode()).hexdigest() for x in ids]
    assert coder.decoded_digests(*found) == [hashlib.sha256(t.encode()).hexdigest() for t in texts]


def test_word_by_word_equals_by_pieces(ranks, coder):
    plain = bpe.TextCoder(ranks, public_tokenizers.PATTERN)
    for text in filter(None, TEXTS):
        assert coder.encode(text) == plain.encode(text)


def test_every_token_is_its_own_encoding(coder, ranks):
    for raw, rank in list(ranks.items())[::97]:
        assert coder.encoder.encode_piece(raw) == [rank]
        assert coder.encoder.walk(coder.encoder.extend(raw, [-1])) == [rank]


def test_tables_are_small_beside_what_else_a_worker_holds(coder):
    held = sum(x.nbytes for x in vars(coder.tables).values() if isinstance(x, np.ndarray))
    assert held < 10_000_000  # 67 MB more with a row of 256 for each inner node


def test_the_tree_leads_to_every_token_and_nowhere_else(coder, ranks):
    tables, rnd = coder.tables, random.Random(6)
    beginnings = {raw[:k] for raw in ranks for k in range(1, len(raw) + 1)}
    chosen = rnd.sample(sorted(beginnings), 300) + [bytes([k]) for k in range(256)]
    for raw in chosen:
        node = np.zeros(1, np.int32)
        for k, letter in enumerate(raw, 1):
            there, node = tables.led_on(node, np.array([letter], np.uint8))
            assert there.tolist() == [0]
            assert tables.whole[node[0]] == ranks.get(raw[:k], -1)
        on = np.arange(256, dtype=np.uint8)
        led = tables.led_on(np.full(256, node[0]), on)[0].tolist() if node[0] < tables.inner else []
        assert led == [k for k in range(256) if raw + bytes([k]) in beginnings]


def test_a_worker_keeps_a_coder_as_long_as_its_broadcast():
    class Sent:  # as Spark's broadcast in a worker
        value = b"".join(b"%s %d\n" % (bpe.base64.b64encode(bytes([k])), k) for k in range(256))

    sent = Sent()
    coder = weakref.ref(bpe.worker_coder(sent, public_tokenizers.PATTERN))
    assert bpe.worker_coder(sent, public_tokenizers.PATTERN) is coder()
    assert coder().encode("ab") == [97, 98]
    del sent
    assert coder() is None


def test_appends_and_edits(coder, library):
    rnd = random.Random(5)
    for _ in range(150):
        text = "".join(rnd.choice("aab  \n'st1") for _ in range(rnd.randint(0, 80)))
        live = bpe.EncodedText(coder.encoder, public_tokenizers.PATTERN, text)
        for _ in range(4):
            a = rnd.randint(0, len(live.text))
            b = rnd.randint(a, min(len(live.text), a + 4))
            new = "".join(rnd.choice("ab \n's") for _ in range(rnd.randint(0, 4)))
            want = live.text[:a] + new + live.text[b:]
            live.replace(a, b, new)
            assert live.text == want and live.ids == library.encode_ordinary(want)
        live.append("tail's end")
        assert live.ids == library.encode_ordinary(live.text)


def test_an_edit_encodes_only_what_is_near(coder):
    live = bpe.EncodedText(coder.encoder, public_tokenizers.PATTERN, "some words in a row " * 500)
    live.replace(5000, 5001, "x")
    assert live.re_encoded < 100


def test_a_prefix_table_keeps_its_beginning(coder):
    whole = coder.encoder.extend(b"internationalisation", [-1])
    assert coder.encoder.extend(b"international", [-1]) == whole[:14]


def test_documents(spark, library):
    rows = [(k, text, "x", 7) for k, text in enumerate(TEXTS)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, n_tokens string, ids int").repartition(3)
    got = {r["doc_id"]: r for r in bpe.encode_documents(df, PATH, public_tokenizers.PATTERN, space_led=True, keep=["doc_id", "n_tokens"]).collect()}
    assert len(got) == len(TEXTS)
    for k, text in enumerate(TEXTS):
        ids = library.encode_ordinary(text or "")
        assert got[k]["ids"] == ids and got[k]["n_tokens"] == len(ids)
        assert got[k]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[k]["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()


def test_decoding(spark):
    df = spark.createDataFrame([(k, t) for k, t in enumerate(TEXTS)], "doc_id bigint, text string")
    ids = bpe.encode_documents(df, PATH, public_tokenizers.PATTERN, keep=["doc_id", "text"]).select("doc_id", "text", "ids")
    for r in bpe.decode_documents(ids, PATH).collect():
        assert bytes(r["decoded"]) == (r["text"] or "").encode()


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert bpe.encode_documents(df, PATH, public_tokenizers.PATTERN, keep=["doc_id"]).count() == 0
