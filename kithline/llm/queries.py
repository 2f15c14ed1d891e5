"""Registered queries of the subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import compaction, huffman_ids, lexicon_bpe, mpeg_media, packing, perspectives, quality_cascade, simhash_ring, substring_dedup, url_templates
from .common import new_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The number in a page's last path segment is the document it shows; labels of documents are the pages' labels."""
    pages, labels = table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels")
    shown = F.expr("try_cast(regexp_extract(url, '/([0-9]+)(/|\\\\.html)?([?#].*)?$', 1) AS bigint)")
    bad = F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).otherwise(0)
    known = pages.select("page_id", shown.alias("doc_id")).join(labels.select("doc_id", bad.alias("bad")), "doc_id").select("page_id", "bad")
    return url_templates.judge(pages, known)


def op2_huffman_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, file = table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")
    return huffman_ids.read_files(*huffman_ids.encode_corpus(docs, file, end=2))


def op3_difference_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digests(table(spark, sf_dir, "documents"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end=0)


def op5_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_cascade.statistics(table(spark, sf_dir, "documents"))


def op6_mpeg_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mpeg_media.store_and_read(table(spark, sf_dir, "documents"))


def op7_size_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the newest version, with its rows by the manifest and how many runs of shards are left to merge."""
    docs = table(spark, sf_dir, "documents")
    made = compaction.compacted(docs, new_path(spark, "sharded"))
    listed = made.manifest()
    counts = [F.lit(listed.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]).cast("long").alias("version_rows"), F.lit(made.plan(listed).select("run").distinct().count()).cast("long").alias("runs_left")]
    return made.read().select("doc_id", F.coalesce(F.pmod("doc_id", F.lit(4)), F.lit(0)).alias("arrival"), F.octet_length("text").cast("long").alias("n_bytes"), F.md5("text").alias("text_md5"), "lang", "source", "n_chars", *counts)


def op8_simhash_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_ring.near_duplicates(table(spark, sf_dir, "documents"))


def op9_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perspectives.flat(perspectives.rotated(table(spark, sf_dir, "conversations")))


def op10_lexicon_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexicon_bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (op1_url_templates, op2_huffman_ids, op3_difference_cover, op4_best_fit_packing, op5_quality_cascade, op6_mpeg_media, op7_size_tiers, op8_simhash_ring, op9_perspectives, op10_lexicon_bpe)
    return {f.__name__: f for f in own}


OP3_SQL = r"""
WITH t AS (SELECT doc_id, regexp_extract_all(coalesce("text", ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
words AS (SELECT doc_id, unnest(generate_series(1, len(w))) AS i, unnest(w) AS word FROM t),
windows AS (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS k FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 19)) AS i FROM t)),
later AS (SELECT doc_id, i FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS n FROM windows) WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, i + j AS i, true AS gone FROM later, (SELECT unnest(range(20)) AS j)),
kept AS (
  SELECT doc_id, count(*) AS n_words, count(gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (WHERE gone IS NULL) AS kept
  FROM words LEFT JOIN gone USING (doc_id, i) GROUP BY doc_id
)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM t LEFT JOIN kept USING (doc_id)
"""

OP5_SQL = rf"""
WITH t AS (
  SELECT doc_id, coalesce("text", '') AS x, regexp_extract_all(coalesce("text", ''), '[^\x20\x09-\x0D]+') AS w,
    [l FOR l IN string_split(coalesce("text", ''), chr(10)) IF regexp_matches(l, '[^\x20\x09-\x0D]')] AS ls
  FROM documents
), windows AS (SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS k FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 7)) AS i FROM t)),
twice AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, k) AS n FROM windows) WHERE n > 1),
again AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM twice, (SELECT unnest(range(8)) AS j) GROUP BY doc_id),
counted AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(x, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words, len(ls) AS n_lines, length(regexp_replace(x, '[^!]', '', 'g')) AS n_bangs,
    len([v FOR v IN w IF regexp_matches(v, '[A-Za-z]|[^\x00-\x7F]')]) AS n_lettered,
    len([v FOR v IN w IF list_contains(['{"', '".join(quality_cascade.STOP_WORDS)}'], translate(v, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))]) AS n_stop,
    len([v FOR v IN w IF regexp_matches(v, '^[A-Z]{{2,}}$')]) AS n_capitals, len([i FOR i IN generate_series(2, len(w)) IF w[i] = w[i - 1]]) AS n_stutter,
    len([l FOR l IN ls IF regexp_matches(l, '^[ \t]*[-*\x{{2022}}\x{{2023}}\x{{2013}}][ \t]')]) AS n_bullets, len([l FOR l IN ls IF regexp_matches(l, '(?:\.\.\.|\x{{2026}})[ \t\x0B\f\r]*$')]) AS n_ellipses
  FROM t LEFT JOIN again USING (doc_id)
), judged AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counted)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > n_words OR 2 * n_bangs > n_words OR 2 * n_dup_lines > n_lines OR (n_lines >= 5 AND 10 * n_dup_lines > 3 * n_lines) OR word_chars < 2 * n_words
    OR word_chars > 15 * n_words OR 10 * n_lettered < 6 * n_words OR (n_words >= 50 AND n_stop < 2) OR 2 * n_capitals > n_words OR 10 * n_stutter > 3 * n_words
    OR 10 * n_bullets > 9 * n_lines OR 10 * n_ellipses > 3 * n_lines) AS kept
FROM judged
"""

OP7_SQL = """
SELECT doc_id, coalesce(doc_id % 4, 0) AS arrival, CAST(octet_length(encode("text")) AS BIGINT) AS n_bytes, md5("text") AS text_md5, lang, source, n_chars,
  count(*) OVER () AS version_rows, CAST(0 AS BIGINT) AS runs_left
FROM documents
"""

OP9_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce("text", '') AS said, regexp_replace(coalesce("text", ''), '<(\\*)\|', '<\\\1|', 'g') || '<|end|>' || chr(10) AS body
  FROM conversations
), headed AS (
  SELECT *, CASE WHEN role = 'system' THEN '<|system|>' ELSE '<|user name=' || regexp_replace(regexp_replace(role, '<(\\*)\|', '<\\\1|', 'g'), '\|(\\*)>', '|\\\1>', 'g') || '|>' END || chr(10) AS head
  FROM turns
), placed AS (
  SELECT *, sum(length(head) + length(body)) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, said ROWS UNBOUNDED PRECEDING) - length(head) - length(body) AS begun
  FROM headed
), speakers AS (
  SELECT DISTINCT conv_id, role AS speaker FROM turns WHERE role <> 'system'
), pieces AS (
  SELECT t.conv_id, speaker, begun // 262144 AS piece, turn, role, said, body, role = speaker AS own, CASE WHEN role = speaker THEN '<|assistant|>' || chr(10) ELSE head END AS shown
  FROM placed t JOIN speakers s ON t.conv_id IS NOT DISTINCT FROM s.conv_id
), ended AS (
  SELECT *, sum(length(shown) + length(body)) OVER (PARTITION BY conv_id, speaker ORDER BY turn NULLS FIRST, role, said ROWS UNBOUNDED PRECEDING) AS upto
  FROM pieces
)
SELECT conv_id, speaker, CAST(piece AS BIGINT) AS piece, CAST(min(upto - length(shown) - length(body)) AS BIGINT) AS start, count(*) AS n_turns, count(*) FILTER (WHERE own) AS n_own,
  string_agg(shown || body, '' ORDER BY turn NULLS FIRST, role, said) AS rendered,
  coalesce(string_agg(CAST(upto - length(body) AS VARCHAR) || ':' || CAST(upto AS VARCHAR), ',' ORDER BY turn NULLS FIRST, role, said) FILTER (WHERE own), '') AS mask_spans
FROM ended GROUP BY conv_id, speaker, piece
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_difference_cover": OP3_SQL, "op5_quality_cascade": OP5_SQL, "op7_size_tiers": OP7_SQL, "op9_perspectives": OP9_SQL}
