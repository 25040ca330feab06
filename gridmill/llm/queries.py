"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import arrow_output, bpe, jaccard, language, line_dedup, media, mixing, suffix_dedup, topk, toxicity
from .shared import documents


def word_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(documents(spark, sf_dir), word_vocabulary())


def op2_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup(documents(spark, sf_dir))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(documents(spark, sf_dir))


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(documents(spark, sf_dir))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir))


def op7_arrow_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arrow_output.read_tokens(arrow_output.write_tokens(documents(spark, sf_dir), word_vocabulary()))


def op8_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.media_columns(documents(spark, sf_dir))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join_documents(documents(spark, sf_dir))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_suffix_array": op2_suffix_array,
    "op3_language_id": op3_language_id,
    "op4_topk": op4_topk,
    "op5_line_dedup": op5_line_dedup,
    "op6_mixing": op6_mixing,
    "op7_arrow_tokens": op7_arrow_tokens,
    "op8_media": op8_media,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_toxicity": op10_toxicity,
}

OP6_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents
), h AS (
  SELECT *, CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || CAST(size AS VARCHAR)), 1, 12) AS BIGINT) AS h FROM d
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source
), r AS (
  SELECT *, [5, 2, 1][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INT)] AS w FROM s
), l AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(source_size * 3) OVER (ORDER BY source_size * 3 / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(w) OVER (ORDER BY source_size * 3 / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM r
), f AS (
  SELECT *, (SELECT arg_min(level, source_size * 3 / w) FROM l WHERE level <= source_size * 3 / w) AS final FROM l
), t AS (
  SELECT source, source_size, CAST(least(final * w, source_size * 3) AS DOUBLE) AS target FROM f
), g AS (
  SELECT *, CASE WHEN source_size > 0 THEN least(CAST(floor(target / source_size) AS BIGINT), 3) ELSE 0 END AS repeats FROM t
), b AS (
  SELECT source, h, sum(size) AS n FROM h GROUP BY source, h
), c AS (
  SELECT source, h, n, sum(n) OVER (PARTITION BY source ORDER BY h) - n AS below FROM b
), e AS (
  SELECT c.source, arg_max(CASE WHEN (target - repeats * source_size - below) * 2 >= n THEN c.h + 1 ELSE c.h END, c.h) AS bound
  FROM c JOIN g ON c.source IS NOT DISTINCT FROM g.source WHERE below <= target - repeats * source_size GROUP BY c.source
)
SELECT doc_id, size, g.source_size, g.target,
  CAST(size * least(repeats + CASE WHEN target - repeats * source_size > 0 AND h.h < bound THEN 1 ELSE 0 END, 3) AS BIGINT) AS taken
FROM h JOIN g ON h.source IS NOT DISTINCT FROM g.source LEFT JOIN e ON h.source IS NOT DISTINCT FROM e.source
"""

OP4_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

OP5_SQL = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS x, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents WHERE text IS NOT NULL
), f AS (
  SELECT *, len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) AS n FROM l WHERE NOT regexp_full_match(x, '[\x09-\x0D\x20]*')
), o AS (
  SELECT doc_id, i, x, n, lead(x) OVER u AS y, lead(x, 2) OVER u AS z, lead(n) OVER u AS ny, lead(i) OVER u AS j, lead(i, 2) OVER u AS k FROM f WINDOW u AS (PARTITION BY doc_id ORDER BY i)
), m AS (
  SELECT *, CASE WHEN n >= 12 THEN 1 WHEN n + ny >= 12 THEN 2 WHEN z IS NOT NULL THEN 3 END AS m FROM o
), g AS (
  SELECT *, row_number() OVER (PARTITION BY m, x, CASE WHEN m > 1 THEN y END, CASE WHEN m > 2 THEN z END ORDER BY doc_id, i) AS r FROM m WHERE m IS NOT NULL
), d AS (
  SELECT doc_id, i FROM g WHERE r > 1 UNION SELECT doc_id, j FROM g WHERE r > 1 AND m > 1 UNION SELECT doc_id, k FROM g WHERE r > 1 AND m > 2
), t AS (
  SELECT l.doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(d.i) AS BIGINT) AS n_removed,
    coalesce(string_agg(CASE WHEN d.i IS NULL THEN x END, chr(10) ORDER BY l.i), '') AS kept
  FROM l LEFT JOIN d ON l.doc_id = d.doc_id AND l.i = d.i GROUP BY l.doc_id
)
SELECT o.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM documents o LEFT JOIN t ON o.doc_id = t.doc_id
"""

ORACLE: dict[str, str] = {"op4_topk": OP4_SQL, "op5_line_dedup": OP5_SQL, "op6_mixing": OP6_SQL}
