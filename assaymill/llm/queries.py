"""The registered queries of this subpackage, with SQL where SQL can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from assaymill.llm import (
    bpe, chat, context_trees, decontaminate, fingerprints, html, languages, merkle, neardup, pseudonyms, secrets,
    variants, wavelet,
)
from assaymill.llm.common import fold

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
# A deployment passes its own secret; equal keys give equal pseudonyms.
PSEUDONYM_KEY = b"assaymill registered query"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = fold("doc_id", 5) == 0
    names, model = languages.learn(docs.where(~held_out))
    return languages.identify(docs, names, model, held_out)


def main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(_table(spark, sf_dir, "pages"))


def multiset_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(_table(spark, sf_dir, "documents"))


def weighted_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_table(spark, sf_dir, "documents"))


def byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    encoded = bpe.encode(docs, VOCABULARY, public_tokenizers.PATTERN)
    decoded = bpe.decode(encoded, VOCABULARY, public_tokenizers.PATTERN)
    hashed = decoded.select("doc_id", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))
    return bpe.digest_ids(hashed)


def contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonyms.pseudonymise(docs, PSEUDONYM_KEY).select(
        "doc_id", "text", *[F.coalesce(F.try_element_at("pii", F.lit(k)), F.lit(0)).alias(f"n_{k}")
                            for k in pseudonyms.KINDS])


def secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.scan(docs, ["doc_id"]).by_path
    counts = [F.size(F.try_element_at("results", F.lit(r.key))).cast("bigint").alias(f"n_{r.kind}") for r in secrets.BASE]
    base = secrets.written(secrets.spans_of(F.col("results"), secrets.BASE))
    every = secrets.written(secrets.spans_of(F.col("results"), secrets.RULES))
    return found.select("doc_id", *counts, F.sha2(base.cast("binary"), 256).alias("base_sha256"), every.alias("spans"))


def rotated_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rendered = chat.perspectives(_table(spark, sf_dir, "conversations"))
    return rendered.select(
        "conv_id", "perspective", "segment", F.col("n_turns").cast("bigint").alias("n_turns"), "text",
        F.array_join(F.transform("trained", lambda s: F.concat_ws(":", s["start"], s["end"])), ",").alias("trained"))


def context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_trees.scores(_table(spark, sf_dir, "documents"), fold("doc_id", 10) != 0)


def merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.report(_table(spark, sf_dir, "documents"))


def spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.grouped(_table(spark, sf_dir, "documents")).select("word", "form", "root", "n", "n_near", "form_n")


def wavelet_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wavelet.read(wavelet.write(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")))


_WORDS = ("regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

CONTAMINATION_SQL = f"""
WITH items AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS words FROM benchmark),
sized AS (SELECT item, words, LEAST(len(words), {decontaminate.WINDOW}) AS k FROM items WHERE len(words) > 0),
windows AS (
  SELECT DISTINCT item, k, array_to_string(words[i:i + k - 1], ' ') AS run
  FROM (SELECT item, words, k, unnest(range(1, len(words) - k + 2)) AS i FROM sized)),
docs AS (SELECT doc_id, {_WORDS} AS words FROM documents),
runs AS (
  SELECT doc_id, k, i, array_to_string(words[i:i + k - 1], ' ') AS run
  FROM (SELECT doc_id, words, k, unnest(range(1, len(words) - k + 2)) AS i
        FROM docs, (SELECT DISTINCT k FROM windows))),
met AS (SELECT doc_id, i, k, item FROM runs JOIN windows USING (k, run)),
hit AS (SELECT doc_id, COUNT(DISTINCT place) AS n
        FROM (SELECT doc_id, unnest(range(i, i + k)) AS place FROM met) GROUP BY doc_id),
named AS (SELECT doc_id, COUNT(*) AS n, string_agg(item, ',' ORDER BY item) AS list
          FROM (SELECT DISTINCT doc_id, item FROM met) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words, COALESCE(h.n, 0) AS n_hit, COALESCE(n.n, 0) AS n_items,
       sha256(COALESCE(n.list, '')) AS items_sha256, COALESCE(h.n, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hit h USING (doc_id) LEFT JOIN named n USING (doc_id)
"""


def _rule_sql(rank: int, rule: secrets.Rule) -> str:
    pattern = "'" + rule.pattern.replace("'", "''") + "'"
    return f"""
  SELECT doc_id, '{rule.kind}' AS kind, {rank} AS rank, starts AS s, starts + length(m[i]) AS e
  FROM (SELECT doc_id, m, g, i,
          CAST(list_sum(list_transform(gaps[1:i], lambda x: length(x))) + COALESCE(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0)
               AS BIGINT) AS starts
        FROM (SELECT doc_id, m, g, gaps, unnest(range(1, len(m) + 1)) AS i
              FROM (SELECT doc_id, regexp_extract_all(t, {pattern}) AS m,
                           regexp_extract_all(t, {pattern}, {rule.group}) AS g, string_split_regex(t, {pattern}) AS gaps
                    FROM (SELECT doc_id, COALESCE(text, '') AS t FROM documents))))
  WHERE length(g[i]) >= {rule.least}"""


SECRETS_SQL = f"""
WITH spans AS ({" UNION ALL ".join(_rule_sql(i, r) for i, r in enumerate(secrets.RULES))}),
told AS (SELECT doc_id, kind, rank, s, kind || ':' || s || ':' || e AS span FROM spans),
per_doc AS (
  SELECT doc_id, COUNT(*) FILTER (kind = 'assign') AS n_assign, COUNT(*) FILTER (kind = 'access') AS n_access,
         COUNT(*) FILTER (kind = 'hex') AS n_hex,
         string_agg(span, ',' ORDER BY s, rank) FILTER (rank < {len(secrets.BASE)}) AS base,
         string_agg(span, ',' ORDER BY s, rank) AS spans
  FROM told GROUP BY doc_id)
SELECT d.doc_id, COALESCE(n_assign, 0) AS n_assign, COALESCE(n_access, 0) AS n_access, COALESCE(n_hex, 0) AS n_hex,
       sha256(COALESCE(base, '')) AS base_sha256, COALESCE(spans, '') AS spans
FROM documents d LEFT JOIN per_doc USING (doc_id)
"""

CHAT_SQL = f"""
WITH plain AS (
  SELECT conv_id, turn, CASE WHEN trim(role) <> '' THEN trim(role) ELSE 'unknown' END AS speaker,
         regexp_replace(COALESCE(text, ''), '<\\|(im_start|im_end)\\|>', '< |\\1| >', 'g') AS text FROM conversations),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, speaker, text) - 1 AS pos FROM plain),
speakers AS (SELECT DISTINCT conv_id, speaker AS perspective FROM plain WHERE speaker <> 'system'),
parts AS (
  SELECT n.conv_id, perspective, pos // {chat.SEGMENT} AS segment, pos, speaker, text,
         '{chat.OPEN}' || CASE WHEN speaker = 'system' THEN speaker WHEN speaker = perspective THEN 'assistant'
                          ELSE 'user name=' || speaker END || chr(10) AS head
  FROM numbered n JOIN speakers s ON n.conv_id IS NOT DISTINCT FROM s.conv_id),
placed AS (
  SELECT *, head || text || '{chat.CLOSE}' || chr(10) AS part,
         SUM(length(head) + length(text) + {len(chat.CLOSE) + 1}) OVER (
           PARTITION BY conv_id, perspective, segment ORDER BY pos) AS after FROM parts)
SELECT conv_id, perspective, segment, COUNT(*) AS n_turns, string_agg(part, '' ORDER BY pos) AS text,
       COALESCE(string_agg((after - length(part) + length(head)) || ':' || (after - 1), ',' ORDER BY pos)
                FILTER (speaker = perspective), '') AS trained
FROM placed GROUP BY conv_id, perspective, segment
"""

# Unsigned crc32 of a list of bytes, from the table that the polynomial defines.
_CRC_TABLE = """(SELECT list(list_reduce(range(8), lambda v, k: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, i)
                        ORDER BY i) AS crc FROM range(256) AS r(i))"""


def _crc_sql(bytes_: str) -> str:
    return f"xor(list_reduce({bytes_}, lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1]), CAST(4294967295 AS BIGINT)), 4294967295)"


def _leaf_sql(*values: str) -> str:
    return "sha256(" + " || ".join(
        f"COALESCE(octet_length(encode(CAST({v} AS VARCHAR))) || ':' || CAST({v} AS VARCHAR), '-')" for v in values) + ")"


def _levels_sql(name: str, start: str) -> str:
    return f"""{name} AS (
  SELECT key, 0 AS h, i, d FROM ({start})
  UNION ALL
  SELECT key, h + 1, i // 2, sha256(string_agg(d, '' ORDER BY i))
  FROM (SELECT *, COUNT(*) OVER (PARTITION BY key) AS n FROM {name}) WHERE n > 1 GROUP BY key, h, i // 2)"""


def _walk_sql(name: str, start: str, nodes: str) -> str:
    return f"""{name} AS (
  SELECT doc_id, key, 0 AS h, i, d, proof FROM ({start})
  UNION ALL
  SELECT w.doc_id, w.key, w.h + 1, w.i // 2,
         sha256(CASE WHEN s.d IS NULL THEN w.d WHEN w.i % 2 = 0 THEN w.d || s.d ELSE s.d || w.d END), w.proof || COALESCE(s.d, '')
  FROM {name} w JOIN (SELECT key, MAX(h) AS top FROM {nodes} GROUP BY key) t ON w.key = t.key AND w.h < t.top
  LEFT JOIN {nodes} s ON s.key = w.key AND s.h = w.h AND s.i = xor(w.i, 1))"""


MERKLE_SQL = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, COALESCE('=' || lang, '') AS key, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS i,
         {_leaf_sql("doc_id", "source", "lang", "n_chars", "text")} AS leaf,
         CASE WHEN {_crc_sql("list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: ord(x))")} % {merkle.TAMPERED_EVERY} = 0
              THEN {_leaf_sql("doc_id", "source", "lang", "n_chars + 1", "text")} END AS tampered
  FROM documents, {_CRC_TABLE}),
{_levels_sql("nodes", "SELECT key, i, leaf AS d FROM leaves")},
subroots AS (SELECT key AS of, d AS subroot, row_number() OVER (ORDER BY key) - 1 AS i
             FROM (SELECT key, arg_max(d, h) AS d FROM nodes GROUP BY key)),
{_levels_sql("tops", "SELECT 0 AS key, i, subroot AS d FROM subroots")},
{_walk_sql("walk", "SELECT doc_id, key, i, COALESCE(tampered, leaf) AS d, '' AS proof FROM leaves", "nodes")},
{_walk_sql("upper_walk", "SELECT doc_id, 0 AS key, u.i, w.d, w.proof FROM (SELECT * FROM walk QUALIFY h = MAX(h) OVER (PARTITION BY key)) w JOIN subroots u ON w.key = u.of", "tops")},
ended AS (SELECT * FROM upper_walk QUALIFY h = MAX(h) OVER ()),
root AS (SELECT arg_max(d, h) AS root FROM tops)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, d AS folded_root, d = root AS verified
FROM leaves l JOIN subroots u ON l.key = u.of JOIN (SELECT doc_id, d, proof FROM ended) USING (doc_id), root
"""

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_BYTES = "list_transform(range(strlen(s)), lambda i: CAST('0x' || substr(hex(encode(s)), 2 * i + 1, 2) AS INTEGER))"

# Near words by shared deletions: equal after one letter of each (at the same place) or of the longer one goes.
VARIANTS_SQL = rf"""
WITH RECURSIVE runs AS (
  SELECT doc_id, run, COUNT(*) AS times
  FROM (SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '[a-z\x{{00C0}}-\x{{00FF}}]+')) AS run FROM documents) GROUP BY doc_id, run),
hashed AS (
  SELECT run, times, {_crc_sql(_BYTES)} AS h
  FROM (SELECT run, times, COALESCE(CAST(doc_id AS VARCHAR), '') || ':' || run AS s FROM runs), {_CRC_TABLE}),
words AS (
  SELECT word, CAST(SUM(times) AS BIGINT) AS n
  FROM (SELECT times, CASE WHEN h % {variants.DROPPED_EVERY} = 0
                           THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed)
  WHERE length(word) >= {variants.LEAST_LENGTH} GROUP BY word HAVING SUM(times) >= {variants.LEAST_COUNT}),
shorter AS (
  SELECT word, n, i, left(word, i) || substr(word, i + 2) AS rest FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
longer AS (SELECT DISTINCT l.word, l.n, w.word AS near, w.n AS near_n FROM shorter l JOIN words w ON l.rest = w.word),
pairs AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM shorter a JOIN shorter b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT word, near, near_n FROM longer UNION SELECT near, word, n FROM longer),
best AS (
  SELECT word, COUNT(*) AS n_near, first(near ORDER BY near_n DESC, near) AS near, MAX(near_n) AS near_n FROM pairs GROUP BY word),
formed AS (
  SELECT w.word, w.n, COALESCE(n_near, 0) AS n_near, CASE WHEN near_n >= 2 * w.n THEN near END AS form,
         CASE WHEN near_n >= 2 * w.n THEN near_n END AS form_n
  FROM words w LEFT JOIN best b ON w.word = b.word),
walk AS (
  SELECT word, word AS at FROM formed
  UNION ALL SELECT walk.word, f.form FROM walk JOIN formed f ON walk.at = f.word WHERE f.form IS NOT NULL)
SELECT f.word, f.form, walk.at AS root, f.n, f.n_near, f.form_n
FROM formed f JOIN walk ON f.word = walk.word JOIN formed e ON walk.at = e.word AND e.form IS NULL
"""

QUERIES = {
    "op1_language_mixtures": language,
    "op2_main_text": main_text,
    "op3_multiset_fingerprints": multiset_hash,
    "op4_weighted_minhash": weighted_minhash,
    "op5_byte_bpe": byte_bpe,
    "op6_suffix_automaton": contamination,
    "op7_feistel_pseudonyms": feistel_pseudonyms,
    "op8_secret_ledger": secret_ledger,
    "op9_rotated_chats": rotated_chats,
    "op10_context_trees": context_tree,
    "op11_merkle_manifest": merkle_manifest,
    "op12_spelling_variants": spelling_variants,
    "op13_wavelet_shards": wavelet_shards,
    "pipeline": corpus_pipeline.run,
}
ORACLES = {
    "op6_suffix_automaton": CONTAMINATION_SQL,
    "op8_secret_ledger": SECRETS_SQL,
    "op9_rotated_chats": CHAT_SQL,
    "op11_merkle_manifest": MERKLE_SQL,
    "op12_spelling_variants": VARIANTS_SQL,
}
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
