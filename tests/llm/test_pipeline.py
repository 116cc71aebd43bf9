"""The whole pipeline against a plain version, on a small table with copies, junk and odd rows."""

import random

import public_tokenizers
import pytest
import tiktoken

from strandline.llm import bpe, langid, mixing
from tests.llm.test_mixing import plain as plain_mix
from tests.llm.test_quality import expected as plain_quality
from tests.llm.test_simhash import fingerprint, grouped

corpus_pipeline = pytest.importorskip("corpus_pipeline")


def rows():
    rnd = random.Random(9)
    syllables = {"aa": ["ka", "ro", "mi", "ten", "lu"], "bb": ["sch", "ein", "ung", "ver", "keit"]}
    out = []
    for k in range(120):
        lang = rnd.choice(list(syllables))
        text = " ".join("".join(rnd.choice(syllables[lang]) for _ in range(rnd.randint(1, 4))) for _ in range(rnd.randint(25, 90)))
        out.append([k, text, lang, f"s{k % 2 if k % 3 else 7}", len(text)])
    for k in range(8):
        out.append([200 + k, out[k][1], out[k][2], "s7", 1])
    out += [[300, None, "aa", "s0", 0], [301, "", None, None, 0], [302, "12 34 " * 30, "aa", "s1", 0], [303, "ka ro " * 200, "aa", "s1", 0], [304, out[5][1].upper(), "bb", None, 0], [305, "ka " * 3, "aa", "s1", 0]]
    return [tuple(r) for r in out]


def test_stages_and_run(spark, tmp_path):
    data = rows()
    spark.createDataFrame(data, "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    documents = spark.read.parquet(f"{tmp_path}/documents.parquet")
    model = langid.fit(documents)
    left = [r for r in data if not model.classify(r[1])[2]]
    left = [r for r in left if plain_quality(r[1])[-1]]
    first = {}
    for r, root in sorted(zip(left, grouped([fingerprint(r[1]) for r in left]))):
        first.setdefault(root, r)
    left = sorted(first.values())
    assert 0 < len(left) < len(data) - 10
    taken, _ = plain_mix([(r[0], r[1], r[3], None) for r in left], mixing.ENTROPY_SHARE, mixing.MOST_REPEATS, mixing.BLOCK_ROWS)
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.parse_ranks(f.read()), special_tokens={})
    texts = {r[0]: r[1] for r in left}
    want = sorted((d, library.encode_ordinary(texts[d])) for d, _, _ in taken)
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted((r["doc_id"], list(r["ids"])) for r in got.collect()) == want
    docs = documents
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == documents.columns, name


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
