"""Registered queries of the training-data operators: each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    ann,
    decontaminate,
    html_extract,
    language_id,
    line_dedup,
    packing,
    phrases,
    quality,
    simhash,
    token_counts,
    token_ids,
    toxicity,
    whitening,
)
from .common import table, tokenizer_path


def op1_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op3_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.char_length("text").cast("long"))


def op4_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = token_ids.token_files(
        spark, table(spark, sf_dir, "documents"), vocabulary=tokenizer_path("word_bpe_49k.json"), kind="word",
        end_id=1, vocabulary_size=49_408,
    )
    return out.select("doc_id", "start", "n_tokens", "ids_crc32")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(
        table(spark, sf_dir, "documents"), vocabulary=tokenizer_path("word_bpe_49k.json"), limit=2048
    )


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", F.md5("text").alias("text_md5"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "held_out", "score", "predicted", F.size("spans").alias("n_spans"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "pages"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_all(table(spark, sf_dir, "documents"))


def pack_all(docs: DataFrame) -> DataFrame:
    return packing.pack_documents(
        docs, vocabulary=tokenizer_path("byte_bpe_50k.json"), kind="byte", end_id=0, capacity=2048
    )


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings")).drop("deviation_wide")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_nearest_neighbours, op2_simhash, op3_html_extract, op4_token_ids, op5_token_counts, op6_decontaminate,
        op7_line_dedup, op8_toxicity, op9_language_id, op10_packing, op11_quality, op12_collocations, op13_whitening,
    )
}

#: Line dedup in DuckDB SQL.  Shared halves select the pairs (none is lost); characters decide, since
#: DuckDB's own edit distance counts bytes.
LINE_DEDUP_SQL = """
WITH parts AS (SELECT doc_id, string_split(text, chr(10)) AS p FROM documents WHERE text IS NOT NULL),
cut AS (SELECT doc_id, unnest(range(1, len(p) + 1)) AS line_no, unnest(p) AS raw FROM parts),
placed AS (SELECT doc_id, line_no, raw, trim(raw, ' ' || chr(9) || chr(13)) AS line,
                  doc_id::HUGEINT * 1000000000 + line_no AS place FROM cut),
firsts AS (SELECT line, min(place) AS first, length(line) AS n FROM placed WHERE line <> '' GROUP BY line),
near AS (SELECT * FROM firsts WHERE n >= 16),
halves AS (
  SELECT line, first, n, n AS base, 0 AS side, substring(line, 1, n // 2) AS half FROM near
  UNION ALL SELECT line, first, n, n, 1, substring(line, n // 2 + 1) FROM near
  UNION ALL SELECT line, first, n, n - 1, 0, substring(line, 1, (n - 1) // 2) FROM near
  UNION ALL SELECT line, first, n, n - 1, 1, substring(line, (n - 1) // 2 + 2) FROM near),
pairs AS (
  SELECT DISTINCT a.line, b.line AS other, a.n, b.n AS m FROM halves a
  JOIN halves b ON a.base = b.base AND a.side = b.side AND a.half = b.half AND b.first < a.first),
verified AS (
  SELECT DISTINCT line FROM pairs WHERE CASE
    WHEN n = m THEN len(list_filter(range(1, n + 1), lambda i: substring(line, i, 1) <> substring(other, i, 1))) = 1
    WHEN n > m THEN len(list_filter(range(1, n + 1),
                        lambda i: substring(line, 1, i - 1) || substring(line, i + 1) = other)) > 0
    ELSE len(list_filter(range(1, m + 1),
             lambda i: substring(other, 1, i - 1) || substring(other, i + 1) = line)) > 0 END),
gone AS (
  SELECT p.doc_id, p.line_no FROM placed p JOIN firsts f USING (line)
  WHERE p.place <> f.first OR line IN (SELECT line FROM verified)),
kept AS (
  SELECT doc_id, string_agg(raw, chr(10) ORDER BY line_no) AS text, count(*) AS n
  FROM placed WHERE (doc_id, line_no) NOT IN (SELECT (doc_id, line_no) FROM gone) GROUP BY doc_id)
SELECT d.doc_id, CAST(CASE WHEN d.text IS NULL THEN 0 ELSE len(string_split(d.text, chr(10))) END AS INTEGER) AS n_lines,
       CAST(CASE WHEN d.text IS NULL THEN 0 ELSE len(string_split(d.text, chr(10))) - coalesce(k.n, 0) END AS INTEGER) AS n_removed,
       CASE WHEN d.text IS NULL THEN NULL ELSE md5(coalesce(k.text, '')) END AS text_md5
FROM documents d LEFT JOIN kept k USING (doc_id)
"""

#: Phrase collocations in DuckDB SQL: all phrases counted, all cuts scored, every longer candidate looked at.
COLLOCATIONS_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
worded AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, CAST(sum(len(w)) AS HUGEINT) AS n FROM worded GROUP BY lang),
starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM worded),
spans AS (SELECT lang, w, i, unnest(range(1, least(5, len(w) - i + 1) + 1)) AS m FROM starts),
counted AS (
  SELECT lang, array_to_string(list_slice(w, i, i + m - 1), ' ') AS phrase, any_value(m) AS m,
         CAST(count(*) AS HUGEINT) AS f
  FROM spans GROUP BY ALL),
frequent AS (SELECT lang, phrase, max(m) AS m, max(f) AS f FROM counted WHERE f >= 100 GROUP BY lang, phrase),
candidates AS (SELECT lang, phrase, m, f AS a, string_split(phrase, ' ') AS w FROM frequent WHERE m >= 2),
cuts AS (SELECT lang, phrase, m, a, w, unnest(range(1, m)) AS k FROM candidates),
scored AS (
  SELECT c.lang, c.phrase, c.a, c.k, x.f AS l, y.f AS r, t.n, (1000 * c.a * t.n) // (x.f * y.f) AS score
  FROM cuts c JOIN totals t USING (lang)
  JOIN frequent x ON x.lang = c.lang AND x.phrase = array_to_string(list_slice(c.w, 1, c.k), ' ')
  JOIN frequent y ON y.lang = c.lang AND y.phrase = array_to_string(list_slice(c.w, c.k + 1, c.m), ' ')),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
parts AS (
  SELECT lang, a, m, w, unnest(range(1, m + 1)) AS i FROM candidates),
inner_parts AS (
  SELECT lang, a, m, w, i, unnest(range(i + 1, m + 1)) AS j FROM parts),
gone AS (
  SELECT DISTINCT p.lang, c.phrase FROM inner_parts p
  JOIN candidates c ON c.lang = p.lang AND c.phrase = array_to_string(list_slice(p.w, p.i, p.j), ' ')
  WHERE p.j - p.i + 1 < p.m AND 100 * p.a >= 100 * c.a),
ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank,
         phrase, a, l, r, n, score
  FROM lowest WHERE (lang, phrase) NOT IN (SELECT (lang, phrase) FROM gone))
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
       CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked WHERE rank <= 2000
"""

SQL: dict[str, str] = {"op7_line_dedup": LINE_DEDUP_SQL, "op12_collocations": COLLOCATIONS_SQL}
