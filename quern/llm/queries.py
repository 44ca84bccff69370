"""One query per operator over the whole test tables, with its SQL where there is any."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from quern.llm import (bpe_files, common, imatch, language_id, line_dedup, lm_score, merkle, mixing, multi_index, ngram_join, passage_dedup, token_counts,
                       warc, whitening)

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN

PIECES = public_tokenizers.path("piece_bpe_32k.model")
MOST_TOKENS = 4_096

#: Part of the entropy of equal weights that the mixture is to reach.
ENTROPY = 0.995

#: White space of the contracts, for SQL.
SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
ABC = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def op1_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.scores(common.table(spark, sf_dir, "documents"))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.classes(common.table(spark, sf_dir, "documents"))


def op3_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.near_vectors(common.table(spark, sf_dir, "embeddings"))


def op4_passage_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passage_dedup.digests(common.table(spark, sf_dir, "documents"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.predictions(common.table(spark, sf_dir, "documents"))


def op6_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.digests(common.table(spark, sf_dir, "pages"))


def op7_temperature_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(common.table(spark, sf_dir, "documents"), budget_share=1.0, target_entropy=ENTROPY, max_epochs=4.0)


def op8_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.edits(common.table(spark, sf_dir, "documents"))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_files.digests(common.table(spark, sf_dir, "documents"), RANKS, PATTERN)


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digests(common.table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.tampered_proofs(common.table(spark, sf_dir, "documents"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.components_of_rows(common.table(spark, sf_dir, "embeddings"))


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.limits(common.table(spark, sf_dir, "documents"), PIECES, MOST_TOKENS)


SQL_LINES = f"""
WITH lines AS (
  SELECT doc_id, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos,
         unnest(string_split(coalesce(text, ''), chr(10))) AS line
  FROM documents),
keyed AS (SELECT *, translate(trim(line, {SPACES}), {ABC}) AS key FROM lines),
lost AS (SELECT key, max(doc_id) AS owner FROM keyed WHERE length(key) >= 40
         GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
judged AS (SELECT k.doc_id, k.pos, k.line, l.key IS NOT NULL AND l.owner <> k.doc_id AS gone
           FROM keyed k LEFT JOIN lost l ON k.key = l.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id"""

WORDS = "list_filter(string_split_regex(text, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"

SQL_PASSAGES = f"""
WITH docs AS (SELECT doc_id, coalesce({WORDS}, CAST([] AS VARCHAR[])) AS w FROM documents),
starts AS (SELECT doc_id, p, array_to_string(w[p:p + 34], ' ') AS seq FROM docs, unnest(range(1, len(w) - 33)) AS t(p) WHERE len(w) >= 35),
repeated AS (SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY seq) AS n FROM starts) WHERE n > 1),
covered AS (SELECT DISTINCT doc_id, place FROM repeated, unnest(range(p, p + 35)) AS t(place)),
lost AS (SELECT doc_id, list(place) AS gone FROM covered GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
       sha256(array_to_string(list_transform(list_filter(list_zip(w, range(1, len(w) + 1)), lambda x: NOT coalesce(list_contains(gone, x[2]), false)), lambda x: x[1]), ' ')) AS kept_sha256
FROM docs d LEFT JOIN lost l ON d.doc_id = l.doc_id"""

SQL_JACCARD = f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, {WORDS.replace("text", f"translate(text, {ABC})")} AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN w IS NULL OR len(w) = 0 THEN CAST([] AS VARCHAR[]) WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                 ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda p: array_to_string(w[p:p + 4], ' '))) END AS s FROM docs),
tokens AS (SELECT doc_id, len(s) AS n, unnest(s) AS t FROM sets),
counted AS (SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS shared
           FROM tokens a JOIN tokens b ON a.t = b.t AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM counted WHERE 100 * shared >= 75 * (na + nb - shared)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(doc_id, root) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT e.b, r.root FROM reach r JOIN edges e ON e.a = r.doc_id WHERE r.root < e.b)
SELECT doc_id, any_value(len(s))::BIGINT AS n_shingles, min(root) AS component_id FROM sets JOIN reach USING (doc_id) GROUP BY doc_id"""

SQL_VECTORS = """
WITH RECURSIVE valid AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM valid a JOIN valid b ON a.label = b.label AND a.vec_id <> b.vec_id
          WHERE list_cosine_similarity(a.v, b.v) >= 0.93),
reach(vec_id, root) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION SELECT l.b, r.root FROM reach r JOIN links l ON l.a = r.vec_id WHERE r.root < l.b)
SELECT e.vec_id, (SELECT count(*) FROM links l WHERE l.a = e.vec_id) AS n_links, min(root) AS component_id, min(root) = e.vec_id AS kept
FROM embeddings e JOIN reach r USING (vec_id) GROUP BY e.vec_id"""

SQL_MIX = f"""
WITH docs AS (
  SELECT doc_id, source, CASE WHEN source IS NULL THEN 'null' ELSE 's' || source END AS skey,
         coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS n FROM documents),
sources AS (SELECT skey, sum(n)::DOUBLE AS size, count(*) AS docs FROM docs GROUP BY skey HAVING sum(n) > 0),
shares AS (SELECT *, size / sum(size) OVER () AS share, sum(size) OVER () AS total FROM sources),
grid AS (SELECT k, ln(sum(pow(share, k / {mixing.GRID}))) - k / {mixing.GRID} * sum(pow(share, k / {mixing.GRID}) * ln(share))
                / sum(pow(share, k / {mixing.GRID})) AS entropy,
                max(pow(share, k / {mixing.GRID} - 1.0)) / sum(pow(share, k / {mixing.GRID})) AS epochs, count(*) AS sources
         FROM shares, range(0, {mixing.GRID} + 1) AS g(k) GROUP BY k),
step AS (SELECT CASE WHEN (SELECT epochs FROM grid WHERE k = a) > 4.0
                THEN least({mixing.GRID}, (SELECT coalesce(max(k), -1) + 1 FROM grid WHERE epochs > 4.0)) ELSE a END / {mixing.GRID} AS alpha
         FROM (SELECT coalesce(max(k), 0) AS a FROM grid WHERE entropy >= {ENTROPY} * ln(sources) - 1e-12)),
quotas AS (SELECT skey, size, docs, floor(round(pow(share, alpha) / sum(pow(share, alpha)) OVER (), 9) * total)::BIGINT AS quota
           FROM shares, step),
split AS (SELECT *, quota // size::BIGINT AS whole, quota % size::BIGINT AS rest FROM quotas),
drawn AS (SELECT d.*, s.size, s.docs, s.quota, s.whole, s.rest, epoch,
                 md5('7|' || epoch || '|' || coalesce(d.doc_id::VARCHAR, '')) AS key
          FROM docs d JOIN split s USING (skey), unnest(range(0, s.whole + 1)) AS e(epoch)),
placed AS (SELECT *, ('0x' || substr(key, 1, 12))::BIGINT::DOUBLE / pow(16, 12) AS unit FROM drawn),
ranked AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY skey, epoch ORDER BY key, doc_id, n
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM placed)
SELECT doc_id, source, n AS n_tokens, epoch, floor(unit * ceil(docs / {mixing.BLOCK_DOCS}.0))::BIGINT AS block,
       round((epoch + unit) * size / quota, 9) AS place
FROM ranked WHERE epoch < whole OR before < rest"""


def _sql_field(column: str) -> str:
    return f"CASE WHEN {column} IS NULL THEN '-' ELSE octet_length(encode({column}::VARCHAR))::VARCHAR || ':' || {column}::VARCHAR END"


def _sql_leaf(text: str) -> str:
    return "sha256(" + " || ".join(_sql_field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


#: CRC-32 of the decimal id, a bit at a time (the polynomial is a fixed value).
SQL_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT)),
  lambda c, d: list_reduce(list_prepend(xor(c, d), range(8)), lambda e, bit: xor(e >> 1, 3988292384 * (e & 1)))))"""

SQL_MERKLE = f"""
WITH RECURSIVE rows AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN '' ELSE 's' || source END AS g, {_sql_leaf("text")} AS leaf,
         CASE WHEN {SQL_CRC} % 2 = 0 THEN {_sql_leaf("replace(text, chr(10), '')")} ELSE {_sql_leaf("text")} END AS seen FROM documents),
leaves AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p FROM rows),
tree(g, level, p, node, n) AS (
  SELECT g, 0::BIGINT, p, leaf, count(*) OVER (PARTITION BY g) FROM leaves
  UNION ALL SELECT g, level + 1, p // 3, sha256(string_agg(node, '' ORDER BY p)), any_value((n + 2) // 3) FROM tree WHERE n > 1 GROUP BY g, level, p // 3),
subroots AS (SELECT g, node, row_number() OVER (ORDER BY g) - 1 AS p FROM tree WHERE n = 1),
top(level, p, node, n) AS (
  SELECT 0::BIGINT, p, node, count(*) OVER () FROM subroots
  UNION ALL SELECT level + 1, p // 3, sha256(string_agg(node, '' ORDER BY p)), any_value((n + 2) // 3) FROM top WHERE n > 1 GROUP BY level, p // 3),
forest AS (SELECT g, level, p, node FROM tree WHERE n > 1 UNION ALL SELECT NULL, level + 1000, p, node FROM top WHERE n > 1),
steps AS (SELECT g, level, p, coalesce((SELECT string_agg(o.node, '' ORDER BY o.p) FROM forest o WHERE o.g IS NOT DISTINCT FROM f.g AND o.level = f.level AND o.p // 3 = f.p // 3 AND o.p < f.p), '') AS l,
                 coalesce((SELECT string_agg(o.node, '' ORDER BY o.p) FROM forest o WHERE o.g IS NOT DISTINCT FROM f.g AND o.level = f.level AND o.p // 3 = f.p // 3 AND o.p > f.p), '') AS r
          FROM forest f),
near AS (SELECT d.g, d.p AS leaf_p, s.level, s.l, s.r FROM leaves d JOIN steps s ON s.g = d.g AND s.p = d.p // pow(3, s.level)::BIGINT
         UNION ALL SELECT d.g, d.p, s.level, s.l, s.r FROM leaves d JOIN subroots b ON b.g = d.g JOIN steps s ON s.g IS NULL AND s.p = b.p // pow(3, s.level - 1000)::BIGINT),
numbered AS (SELECT *, row_number() OVER (PARTITION BY g, leaf_p ORDER BY level) AS k FROM near),
folded(g, p, k, node) AS (
  SELECT g, p, 0::BIGINT, seen FROM leaves
  UNION ALL SELECT f.g, f.p, f.k + 1, sha256(n.l || f.node || n.r) FROM folded f JOIN numbered n ON n.g = f.g AND n.leaf_p = f.p AND n.k = f.k + 1),
ends AS (SELECT g, p, arg_max(node, k) AS folded_root FROM folded GROUP BY g, p),
proofs AS (SELECT g, leaf_p AS p, sha256(string_agg(l || r, '' ORDER BY level)) AS proof_sha256 FROM near GROUP BY g, leaf_p)
SELECT d.doc_id, d.leaf, b.node AS subroot, t.node AS root, coalesce(q.proof_sha256, sha256('')) AS proof_sha256, e.folded_root, e.folded_root = t.node AS verified
FROM leaves d JOIN subroots b USING (g) JOIN ends e ON e.g = d.g AND e.p = d.p LEFT JOIN proofs q ON q.g = d.g AND q.p = d.p, (SELECT node FROM top WHERE n = 1) t"""

QUERIES = {"op1_pitman_yor": op1_pitman_yor, "op2_ngram_join": op2_ngram_join, "op3_multi_index": op3_multi_index,
           "op4_passage_dedup": op4_passage_dedup, "op5_language_id": op5_language_id, "op6_warc_derivatives": op6_warc_derivatives,
           "op7_temperature_mix": op7_temperature_mix, "op8_imatch": op8_imatch, "op9_byte_bpe": op9_byte_bpe, "op10_line_dedup": op10_line_dedup,
           "op11_merkle_manifest": op11_merkle_manifest, "op12_whitening": op12_whitening, "op13_token_counts": op13_token_counts}
ORACLES = {"op2_ngram_join": SQL_JACCARD, "op3_multi_index": SQL_VECTORS, "op4_passage_dedup": SQL_PASSAGES, "op7_temperature_mix": SQL_MIX, "op10_line_dedup": SQL_LINES,
           "op11_merkle_manifest": SQL_MERKLE}
