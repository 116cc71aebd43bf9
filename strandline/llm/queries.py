"""The queries of this subpackage, with production parameters, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm import bpe, langid, licenses, merkle, mixing, ngram_join, pseudo_likelihood, quality, quotations, runs, simhash, token_files, vectors
from strandline.llm._tables import stored, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(table(spark, sf_dir, "documents"))


def op2_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudo_likelihood.score_documents(table(spark, sf_dir, "documents"))


def op3_quotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The turns of ``conversations`` quote nothing; so each is first sent as a reply that quotes the two before it."""
    return quotations.link_quotations(stored(quotations.quoting_replies(table(spark, sf_dir, "conversations"))))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_report(table(spark, sf_dir, "documents"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return langid.predict(documents, langid.fit(documents))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixing_plan(table(spark, sf_dir, "documents"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents as flat token files (id 50256 ends a document), and the counts that a scan of them finds."""
    documents = table(spark, sf_dir, "documents")
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return token_files.count_documents(documents, path, public_tokenizers.PATTERN, end=50256, space_led=True)


def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = table(spark, sf_dir, "embeddings")
    return vectors.top_k(embeddings, embeddings["vec_id"] % 50 == 0)


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.encode_documents(documents, path, public_tokenizers.PATTERN, space_led=True, keep=["doc_id"], with_ids=False)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every text, after repetition was put into one document in ten."""
    planted = runs.planted_runs(table(spark, sf_dir, "documents"))
    return runs.run_digests(runs.periodic_runs(planted))


def tampered_manifest(documents: DataFrame) -> DataFrame:
    """The manifest of documents, checked against a copy in which A-Z of one text in five are lower-cased."""
    lowered = F.translate(documents["text"], "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    altered = F.crc32(documents["doc_id"].cast("string").cast("binary")) % 5 == 0
    return merkle.verified_manifest(documents, cells=["doc_id", "source", "lang", "n_chars", "text"], copies={"text": lowered}, altered=altered)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tampered_manifest(table(spark, sf_dir, "documents"))


def op13_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_documents(table(spark, sf_dir, "documents"))


OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), windows AS (
  SELECT doc_id, i, w[i:i+7] AS x FROM d, unnest(range(1, len(w) - 6)) AS r(i)
), twice AS (
  SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, x) > 1
), covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, unnest(range(0, 8)) AS r(k) GROUP BY doc_id
), figures AS (
  SELECT d.doc_id, t, w, lines, len(w)::BIGINT AS n_words, length(list_aggregate(w, 'string_agg', ''))::BIGINT AS chars,
         len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN covered USING (doc_id)
), judged AS (
  SELECT *, coalesce(chars, 0)::BIGINT AS word_chars, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed
  FROM figures
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 4 * n_symbols > n_words OR 5 * len(regexp_extract_all(t, '[A-Z]')) > 2 * word_chars
            OR word_chars < 2 * n_words OR word_chars > 14 * n_words OR 10 * n_dup_lines > 5 * len(lines)
            OR 20 * coalesce(list_sum(list_transform(range(1, len(w) + 1, 1000), lambda i: len(list_distinct(w[i:i+999])))), 0) < n_words) AS kept
FROM judged
"""

OP3_SQL = r"""
WITH RECURSIVE heads AS (
  SELECT conv_id, turn, min(text) AS own, min(role) AS role FROM conversations GROUP BY ALL
), sent AS (
  SELECT c.conv_id, c.turn, c.role, CASE WHEN a.own IS NULL THEN c.text ELSE coalesce(a.role, 'someone') || ' wrote:' || chr(10)
    || coalesce('>> ' || replace(replace(trim(regexp_replace(b.own, '[ \t\n\x0B\f\r]+', ' ', 'g')), '. ', '.' || chr(10)), chr(10), chr(10) || '>> ') || chr(10), '')
    || '> ' || replace(replace(trim(regexp_replace(a.own, '[ \t\n\x0B\f\r]+', ' ', 'g')), '. ', '.' || chr(10)), chr(10), chr(10) || '> ') || chr(10) || chr(10) || coalesce(c.text, '') END AS text
  FROM conversations c LEFT JOIN heads a ON a.conv_id = c.conv_id AND a.turn = c.turn - 1 LEFT JOIN heads b ON b.conv_id = c.conv_id AND b.turn = c.turn - 2
), messages AS (
  SELECT row_number() OVER () AS m, conv_id, turn, role, string_split(regexp_replace(coalesce(text, ''), '\r\n?', chr(10), 'g'), chr(10)) AS raw
  FROM sent
), split AS (
  SELECT m, conv_id, turn, i, raw[i] AS l, regexp_extract(raw[i], '^[ \t]*(?:>[ \t]*)+') AS marks FROM messages, unnest(range(1, len(raw) + 1)) AS r(i)
), lines AS (
  SELECT *, level = 0 AND coalesce(lead(level) OVER (PARTITION BY m ORDER BY i) > 0, false) AND regexp_matches(said, '^.*\bwrote:[ \t]*$') AS says
  FROM (SELECT m, conv_id, turn, i, length(regexp_replace(marks, '[^>]', '', 'g')) AS level, substr(l, length(marks) + 1) AS said FROM split)
), bodies AS (
  SELECT m, coalesce(string_agg(said, chr(10) ORDER BY i) FILTER (level = 0 AND NOT says), '') AS body, count(*) FILTER (level > 0) AS n_quoted, max(level) AS quote_levels
  FROM lines GROUP BY m
), written AS (
  SELECT *, regexp_matches(said, '[^ \t\n\x0B\f\r]') AND NOT says AS counts FROM lines
), runs AS (
  SELECT *, sum(begins) OVER (PARTITION BY m ORDER BY i) AS run
  FROM (SELECT *, CASE WHEN counts AND NOT coalesce(lag(level) OVER w = level AND lag(counts) OVER w, false) THEN 1 ELSE 0 END AS begins FROM written WINDOW w AS (PARTITION BY m ORDER BY i))
), passages AS (
  SELECT conv_id, turn, any_value(level) AS level, true AS whole, lower(trim(regexp_replace(string_agg(said, ' ' ORDER BY i), '[ \t\n\x0B\f\r]+', ' ', 'g'))) AS norm FROM runs WHERE counts GROUP BY m, run, conv_id, turn
  UNION
  SELECT conv_id, turn, level, false, norm FROM (SELECT *, lower(trim(regexp_replace(said, '[ \t\n\x0B\f\r]+', ' ', 'g'))) AS norm FROM written WHERE NOT says) WHERE len(string_split(norm, ' ')) >= 5
), origins AS (
  SELECT conv_id, norm, min(turn) AS origin FROM passages WHERE level = 0 GROUP BY ALL
), parents AS (
  SELECT q.conv_id, q.turn, arg_max(origin, (-level, whole, origin)) AS parent
  FROM passages q JOIN origins o ON q.conv_id = o.conv_id AND q.norm = o.norm AND q.level > 0 AND origin < q.turn GROUP BY ALL
), up AS (
  SELECT conv_id, turn, parent AS root, 1 AS depth FROM parents
  UNION ALL
  SELECT up.conv_id, up.turn, p.parent, depth + 1 FROM up JOIN parents p ON p.conv_id = up.conv_id AND p.turn = up.root
), roots AS (
  SELECT conv_id, turn, min(root) AS root, max(depth) AS depth FROM up GROUP BY ALL
)
SELECT messages.conv_id, messages.turn, role, trim(body, ' ' || chr(9) || chr(10)) AS body,
       '<|' || coalesce(role, 'unknown') || '|>' || chr(10) || trim(body, ' ' || chr(9) || chr(10)) || chr(10) || '<|end|>' || chr(10) AS chat,
       n_quoted, quote_levels, parent AS parent_turn, coalesce(root, messages.turn) AS thread_root, coalesce(depth, 0)::BIGINT AS depth,
       CASE WHEN messages.conv_id IS NOT NULL AND messages.turn IS NOT NULL THEN rank() OVER (PARTITION BY messages.conv_id, coalesce(root, messages.turn) ORDER BY messages.turn) END AS position
FROM messages JOIN bodies USING (m) LEFT JOIN parents p ON p.conv_id = messages.conv_id AND p.turn = messages.turn
LEFT JOIN roots r ON r.conv_id = messages.conv_id AND r.turn = messages.turn
"""

OP7_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS n FROM documents
), s AS (
  SELECT source, sum(n)::BIGINT AS tokens, count(*) AS cnt FROM d GROUP BY source
), one AS (
  SELECT list(source ORDER BY source NULLS FIRST) AS names, list(tokens ORDER BY source NULLS FIRST) AS tok,
         list(cnt ORDER BY source NULLS FIRST) AS cnts, sum(tokens)::BIGINT AS total FROM s
), shares AS (
  SELECT *, list_transform(tok, lambda t: t::DOUBLE / total) AS sh FROM one
), target AS (
  SELECT *, own + 0.5 * greatest(ln(len(list_filter(sh, lambda x: x > 0))::DOUBLE) - own, 0) AS goal
  FROM (SELECT *, -list_sum(list_transform(list_filter(sh, lambda x: x > 0), lambda x: x * ln(x))) AS own FROM shares)
), bis AS (
  SELECT 0 AS i, 0.0::DOUBLE AS lo, 1.0::DOUBLE AS hi, 0.0::DOUBLE AS lo2, 1.0::DOUBLE AS hi2, sh, goal FROM target
  UNION ALL
  SELECT i + 1, CASE WHEN h >= goal - 1e-9 THEN mid ELSE lo END, CASE WHEN h >= goal - 1e-9 THEN hi ELSE mid END,
         CASE WHEN r <= 4 THEN mid2 ELSE lo2 END, CASE WHEN r <= 4 THEN hi2 ELSE mid2 END, sh, goal
  FROM (
    SELECT *, -list_sum(list_transform(w, lambda x: x / z * ln(x / z))) AS h,
           list_max(list_transform(list_filter(sh, lambda x: x > 0), lambda x: pow(x, 1.0 - mid2) / z2 / x)) AS r
    FROM (
      SELECT *, list_sum(w) AS z, list_sum(list_transform(list_filter(sh, lambda x: x > 0), lambda x: pow(x, 1.0 - mid2))) AS z2
      FROM (
        SELECT *, list_transform(list_filter(sh, lambda x: x > 0), lambda x: pow(x, mid)) AS w
        FROM (SELECT *, (lo + hi) / 2 AS mid, (lo2 + hi2) / 2 AS mid2 FROM bis WHERE i < 40)
      )
    )
  )
), found AS (
  SELECT round(greatest(CASE WHEN own >= t.goal - 1e-9 THEN 1.0 ELSE lo END,
                        1.0 - CASE WHEN list_max(list_transform(list_filter(t.sh, lambda x: x > 0), lambda x: 1.0 / len(list_filter(t.sh, lambda y: y > 0)) / x)) <= 4
                                   THEN 1.0 ELSE lo2 END), 6) AS exponent, t.*
  FROM bis, target t WHERE i = 40
), weighted AS (
  SELECT unnest(names) AS source, unnest(tok) AS tokens, unnest(cnts) AS cnt, exponent, total,
         unnest(list_transform(sh, lambda x: CASE WHEN x > 0 THEN pow(x, exponent) ELSE 0 END
           / list_sum(list_transform(list_filter(sh, lambda y: y > 0), lambda y: pow(y, exponent))))) AS whole
  FROM found
), quotas AS (
  SELECT * EXCLUDE (whole), round(whole, 6) AS weight, CASE WHEN tokens > 0 THEN floor(whole * total * (1 + 1e-12::DOUBLE))::BIGINT // tokens ELSE 1 END AS passes, floor(whole * total * (1 + 1e-12::DOUBLE))::BIGINT AS quota FROM weighted
), placed AS (
  SELECT d.*, tokens, exponent, weight, passes, greatest(quota - passes * tokens, 0) AS room, e AS epoch, md5(e || ':' || doc_id) AS m,
         greatest((cnt + 4095) // 4096, 1) AS blocks
  FROM d JOIN quotas q ON d.source IS NOT DISTINCT FROM q.source, unnest(range(0, passes + 1)) AS r(e)
), ordered AS (
  SELECT *, (('0x' || substr(m, 1, 8))::BIGINT * blocks) >> 32 AS block, ('0x' || substr(m, 9, 15))::BIGINT AS ord FROM placed
), summed AS (
  SELECT *, sum(n) OVER (PARTITION BY source, epoch ORDER BY block, ord, doc_id) AS so_far FROM ordered
)
SELECT doc_id, source, n AS n_tokens, exponent, weight, epoch::BIGINT AS epoch, block::BIGINT AS block
FROM summed WHERE epoch < passes OR (tokens > 0 AND so_far <= room)
"""

OP9_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
)
SELECT q.vec_id AS query_id, (row_number() OVER w)::INTEGER AS rank, c.vec_id, list_inner_product(q.x, c.x)::BIGINT AS score
FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.r <> c.r AND len(q.x) = len(c.x)
WINDOW w AS (PARTITION BY q.r ORDER BY list_inner_product(q.x, c.x) DESC, c.vec_id)
QUALIFY row_number() OVER w <= 5
"""

#: Trees are grown level by level, each row's siblings looked up at every level; CRC-32 by its bits.
OP12_SQL = r"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, source, hits, sha256(cells) AS leaf, CASE WHEN hits THEN sha256(lowered) ELSE sha256(cells) END AS start FROM (
    SELECT doc_id, source, coalesce(crc % 5 = 0, false) AS hits, head || coalesce(strlen(text) || ':' || text, '-') AS cells,
           head || coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-') AS lowered
    FROM (SELECT *, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
            xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)),
              lambda a, c: list_reduce(list_prepend(xor(a, c), range(8)), lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295) AS crc
          FROM documents)
  )
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, row_number() OVER () AS r FROM leaves
), low AS (
  SELECT source, 0 AS level, i, leaf AS node, count(*) OVER (PARTITION BY source) AS n FROM placed
  UNION ALL
  SELECT source, level + 1, i // 16, sha256(string_agg(node, '' ORDER BY i)), (n + 15) // 16 FROM low WHERE n > 1 GROUP BY source, level, i // 16, n
), subroots AS (
  SELECT source, node AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM low WHERE n = 1
), high AS (
  SELECT 0 AS level, i, subroot AS node, n FROM subroots
  UNION ALL
  SELECT level + 1, i // 16, sha256(string_agg(node, '' ORDER BY i)), (n + 15) // 16 FROM high WHERE n > 1 GROUP BY level, i // 16, n
), steps AS (
  SELECT r, b.level, coalesce(string_agg(b.node, '' ORDER BY b.i) FILTER (b.i < i_own), '') AS l, coalesce(string_agg(b.node, '' ORDER BY b.i) FILTER (b.i > i_own), '') AS g
  FROM (SELECT r, source, level, p.i // (16 ** level)::BIGINT AS i_own FROM placed p, unnest(range(0, 9)) AS x(level)) o
  JOIN low b ON b.source IS NOT DISTINCT FROM o.source AND b.level = o.level AND b.n > 1 AND b.i // 16 = i_own // 16 GROUP BY ALL
), tops AS (
  SELECT source, 100 + b.level AS level, coalesce(string_agg(b.node, '' ORDER BY b.i) FILTER (b.i < i_own), '') AS l, coalesce(string_agg(b.node, '' ORDER BY b.i) FILTER (b.i > i_own), '') AS g
  FROM (SELECT source, level, s.i // (16 ** level)::BIGINT AS i_own FROM subroots s, unnest(range(0, 9)) AS x(level)) o JOIN high b ON b.level = o.level AND b.n > 1 AND b.i // 16 = i_own // 16 GROUP BY ALL
), paths AS (
  SELECT p.r, list({'l': l, 'g': g} ORDER BY s.level) FILTER (l IS NOT NULL) AS path FROM placed p
  LEFT JOIN (SELECT r, level, l, g FROM steps UNION ALL SELECT r, level, l, g FROM placed JOIN tops ON placed.source IS NOT DISTINCT FROM tops.source) s ON s.r = p.r GROUP BY p.r
), done AS (
  SELECT doc_id, leaf, subroot, (SELECT node FROM high WHERE n = 1) AS root, sha256(coalesce(array_to_string(list_transform(path, lambda x: x.l || x.g), ''), '')) AS proof_sha256,
         list_reduce(list_prepend({'l': '', 'g': '', 'node': start}, list_transform(coalesce(path, []), lambda x: {'l': x.l, 'g': x.g, 'node': ''})), lambda a, x: {'l': '', 'g': '', 'node': sha256(x.l || a.node || x.g)}).node AS folded_root
  FROM placed p JOIN paths USING (r) JOIN subroots s ON s.source IS NOT DISTINCT FROM p.source
)
SELECT *, folded_root = root AS verified FROM done
"""

QUERIES: dict[str, Query] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_pseudo_likelihood": op2_pseudo_likelihood,
    "op3_quotations": op3_quotations,
    "op4_simhash": op4_simhash,
    "op5_license_scan": op5_license_scan,
    "op6_language_id": op6_language_id,
    "op7_mixing": op7_mixing,
    "op8_token_counts": op8_token_counts,
    "op9_exact_top_k": op9_exact_top_k,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_ngram_join": op13_ngram_join,
}
ORACLES: dict[str, str] = {"op1_quality_rules": OP1_SQL, "op3_quotations": OP3_SQL, "op7_mixing": OP7_SQL, "op9_exact_top_k": OP9_SQL, "op12_merkle_manifest": OP12_SQL}
