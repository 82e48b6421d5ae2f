"""The results of the training-data queries in SQL, for DuckDB, where SQL can express them."""

from __future__ import annotations

_MIX = r"""
WITH sized AS (
  SELECT doc_id, source,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS k
  FROM documents
), per_source AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
  FROM sized GROUP BY source
), weighted AS (
  SELECT *, CASE place % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w,
         3.0::DOUBLE * source_size AS cap
  FROM per_source
), levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0.0))
            / (sum(w) OVER () - coalesce(sum(w) OVER before, 0.0)) AS level
  FROM weighted
  WINDOW before AS (ORDER BY cap / w, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), chosen AS (
  SELECT level FROM levels WHERE level * w <= cap ORDER BY cap / w, place LIMIT 1
), targets AS (
  SELECT source, source_size, least(cap, coalesce((SELECT level FROM chosen) * w, cap)) AS target FROM weighted
), placed AS (
  SELECT s.doc_id, s.size, t.source_size, t.target,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.k, s.doc_id, s.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
         CAST(round(t.target) AS BIGINT) AS budget
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), cut AS (
  SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS epochs FROM placed
)
SELECT doc_id, size, source_size, target,
       CAST(epochs * size + greatest(0, least(size, budget - epochs * source_size - before)) AS BIGINT) AS taken
FROM cut
"""


def oracle_sql() -> dict[str, str]:
    import corpus_pipeline

    found = {"op8_weighted_mix": _MIX}
    return found | {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else found
