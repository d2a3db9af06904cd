"""Registered queries of the dedup operators and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import exact_dedup, line_dedup, minhash, substring_dedup


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def op10_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.dedup(documents(spark, folder))


OP10_SQL = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t)
"""


def op9_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, folder), words=2, threshold=80)


OP9_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(w) < 2 THEN w ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM d
), e AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS c
  FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n) GROUP BY 1, 2
), l AS (SELECT a, b FROM p WHERE 100 * c >= 80 * (na + nb - c)),
both_ways AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS node, doc_id AS c FROM s UNION SELECT x.b, r.c FROM r JOIN both_ways x ON x.a = r.node),
c AS (SELECT node, min(c) AS component_id FROM r GROUP BY 1)
SELECT doc_id, len(s) AS n_shingles, component_id, doc_id = component_id AS kept FROM s JOIN c ON c.node = s.doc_id
"""


def op1_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = substring_dedup.dedup(documents(spark, folder), window=35)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP1_SQL = r"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
p AS (SELECT doc_id, unnest(range(1, len(w) - 33)) AS i, w FROM d),
k AS (SELECT doc_id, i, array_to_string(w[i:i + 34], ' ') AS s FROM p),
r AS (SELECT doc_id, i FROM k QUALIFY count(*) OVER (PARTITION BY s) > 1),
g AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS j FROM r),
l AS (SELECT doc_id, list(j) AS gone FROM g GROUP BY 1),
f AS (SELECT d.doc_id, len(w) AS n_words, len(coalesce(gone, [])) AS n_removed,
  array_to_string(list_filter(w, lambda x, j: NOT list_contains(coalesce(gone, []), j)), ' ') AS kept FROM d LEFT JOIN l USING (doc_id))
SELECT doc_id, n_words, n_removed, sha256(kept) AS kept_sha256 FROM f
"""


MIN_WORDS = 8  # a repeated line of so many words goes whatever its neighbours


def op4_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = line_dedup.marks(documents(spark, folder), min_lines=2, min_words=MIN_WORDS)
    removed = F.array_join(F.col("removed").cast("array<string>"), ",")
    return found.select("doc_id", "n_lines", F.size("removed").cast("long").alias("n_removed"), removed.alias("removed"))


OP4_SQL = rf"""
WITH d AS (SELECT doc_id, CASE WHEN text IS NULL THEN [] ELSE string_split(text, chr(10)) END AS l FROM documents),
w AS (SELECT doc_id, l, unnest(range(0, len(l) - 1)) AS n FROM d),
c AS (SELECT doc_id, n FROM w QUALIFY row_number() OVER (PARTITION BY l[n + 1], l[n + 2] ORDER BY doc_id, n) > 1),
s AS (SELECT doc_id, unnest(l) AS line, unnest(range(0, len(l))) AS n FROM d),
o AS (SELECT doc_id, n, line FROM s QUALIFY row_number() OVER (PARTITION BY line ORDER BY doc_id, n) > 1),
g AS (
  SELECT doc_id, unnest([n, n + 1]) AS line FROM c
  UNION SELECT doc_id, n FROM o WHERE len(list_filter(string_split_regex(line, '[\x20\x09-\x0D]+'), lambda x: x <> '')) >= {MIN_WORDS}
), r AS (SELECT doc_id, count(*) AS n_removed, string_agg(line, ',' ORDER BY line) AS removed FROM g GROUP BY 1)
SELECT doc_id, len(l) AS n_lines, coalesce(n_removed, 0) AS n_removed, coalesce(removed, '') AS removed FROM d LEFT JOIN r USING (doc_id)
"""
