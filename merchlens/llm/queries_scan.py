"""Registered queries of the operators that scan texts for something, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import decontaminate
from .queries_dedup import documents


def op5_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.leaks(documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"))


def _op5_sql(window: int = 20, identity: int = 80) -> str:
    """All windows of all alignments that share tokens; no masks."""

    def tokens(table: str, key: str) -> str:
        return rf"SELECT {key}, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '') AS t FROM {table}"

    span, short = decontaminate.SPAN, decontaminate.SHORT
    return f"""
WITH d AS ({tokens('documents', 'doc_id')}), b AS (
  SELECT item_id, t AS u, CASE WHEN len(t) < {span} THEN len(t) ELSE least({window}, len(t)) END AS compared, CASE WHEN len(t) < {span} THEN 100 ELSE {identity} END AS identity
  FROM ({tokens('benchmark', 'item_id')}) WHERE item_id IS NOT NULL AND len(t) >= {short}
), dp AS (SELECT doc_id, unnest(t) AS w, unnest(range(0, len(t))) AS p FROM d), bp AS (SELECT item_id, compared, identity, unnest(u) AS w, unnest(range(0, len(u))) AS q FROM b),
a AS (
  SELECT doc_id, item_id, p - q AS shift FROM dp JOIN bp USING (w) GROUP BY ALL HAVING count(*) * 100 >= any_value(compared * identity)
), v AS (
  SELECT doc_id, item_id, shift, compared, identity, t, u, unnest(range(0, len(u) - compared + 1)) AS start FROM a JOIN d USING (doc_id) JOIN b USING (item_id)
), m AS (
  SELECT doc_id, item_id, shift, start, compared, identity,
    len(list_filter(range(start, start + compared), lambda j: shift + j >= 0 AND t[shift + j + 1] = u[j + 1])) AS matched FROM v
)
SELECT doc_id, item_id, shift, start, matched, compared FROM m WHERE matched * 100 >= compared * identity
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY matched DESC, shift, start) = 1
"""


OP5_SQL = _op5_sql()
