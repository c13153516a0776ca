"""Queries of problem 4 and the SQL they are held against."""

from pyspark.sql import functions as F

from ..operators import references as R
from ..session import table
from ..streaming import ingest as T
from .exchange import _half_streams, _place


def p4_orphans(spark, d):
    return R.orphan_references(R.reference_log(table(spark, d, "interaction_examples"), table(spark, d, "reference_chunks")), table(spark, d, "source_catalog"))


def p4_found(spark, d):
    return p4_orphans(spark, d).select("table_name", "record_id", "source_key", "kind").distinct()


def p4_report(spark, d):
    return R.orphan_report(p4_orphans(spark, d))


def p4_upkeep(spark, d):
    """The change deltas of both sides, streamed in two runs into the counts kept per key: keys referred to that nothing holds."""
    refs = R.reference_log(table(spark, d, "interaction_examples"), table(spark, d, "reference_chunks")).select(R.clean_key(F.col("source_key")).alias("key")).where("key is not null").groupBy("key").agg(F.count(F.lit(1)).alias("refs"))
    stays = R.existence_deltas(table(spark, d, "source_catalog")).groupBy("key").agg(F.sum("exist").alias("exist"))
    zero = F.lit(0).cast("long")
    deltas = refs.select("key", "refs", zero.alias("exist")).unionByName(stays.select("key", zero.alias("refs"), "exist"))
    at = _place(spark)
    for stream in _half_streams(spark, at, deltas, "in"):
        T.keep_reference_counts(stream, f"{at}/counts")
    return R.current_orphans(T.reference_counts(spark, f"{at}/counts")).select(F.col("key").alias("source_key"), F.col("refs").alias("n_references"))


_BASE = r"""
WITH refs AS (
  SELECT DISTINCT table_name, record_id, upper(trim(k, E' \t\n\r')) AS source_key, d FROM (
    SELECT 'interaction_examples' AS table_name, interaction_id AS record_id, unnest(citations) AS k,
           strftime(created_at AT TIME ZONE 'UTC', '%Y-%m-%d') AS d FROM interaction_examples
    UNION ALL
    SELECT 'reference_chunks', chunk_id, source_id, substr(accessed_at, 1, 10) FROM reference_chunks)
  WHERE trim(k, E' \t\n\r') <> ''),
stays AS (
  SELECT upper(trim(source_id, E' \t\n\r')) AS k, nullif(access_date, '') AS a, nullif(removed_date, '') AS z FROM source_catalog),
judged AS (
  SELECT r.table_name, r.record_id, r.source_key, r.d,
         count(s.k) AS n, coalesce(bool_or(s.k IS NOT NULL AND (s.a IS NULL OR s.a <= r.d) AND (s.z IS NULL OR r.d < s.z)), false) AS holds,
         bool_or(s.k IS NOT NULL AND s.a IS NULL) AS always, min(s.a) AS first_a
  FROM refs r LEFT JOIN stays s ON r.source_key = s.k GROUP BY ALL),
kinds AS (
  SELECT table_name, record_id, source_key, d,
    CASE WHEN n = 0 THEN 'missing' WHEN d IS NULL THEN NULL
         WHEN NOT always AND d < first_a THEN 'late' WHEN NOT holds THEN 'deleted' END AS kind FROM judged)
"""
QUERIES = {"p4_found": p4_found, "p4_report": p4_report, "p4_upkeep": p4_upkeep}
ORACLE = {
    "p4_found": _BASE + "SELECT DISTINCT table_name, record_id, source_key, kind FROM kinds WHERE kind IS NOT NULL",
    "p4_upkeep": r"""WITH r AS (SELECT upper(trim(k, E' \t\n\r')) AS k FROM (SELECT unnest(citations) AS k FROM interaction_examples UNION ALL SELECT source_id FROM reference_chunks) WHERE trim(k, E' \t\n\r') <> ''),
 s AS (SELECT upper(trim(source_id, E' \t\n\r')) AS k, count_if(coalesce(removed_date, '') = '') AS n FROM source_catalog GROUP BY 1)
 SELECT r.k AS source_key, count(*) AS n_references FROM r LEFT JOIN s USING (k) WHERE coalesce(n, 0) = 0 GROUP BY 1""",
    "p4_report": _BASE + "SELECT table_name, substr(d, 1, 7) AS month, kind, count(*) AS n_references, count(DISTINCT source_key) AS n_keys FROM kinds WHERE kind IS NOT NULL GROUP BY ALL",
}
