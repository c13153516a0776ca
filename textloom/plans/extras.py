"""Streaming queries, and relational queries beyond the text operators."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.web import domain
from ..session import table
from ..sources.files import is_folder
from ..streaming import ingest as S


def _stream(spark, d, name):
    at = f"{d}/{name}.parquet"
    reader = spark.readStream.schema(spark.read.parquet(at).schema)
    if is_folder(spark, at):
        return reader.parquet(at)
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(d)  # a stream reads folders


def stream_dedup(spark, d):
    return S.run_once(S.once_per_content(_stream(spark, d, "documents").select("text"), "text")).select("content_sha256")


def stream_host_cap(spark, d):
    pages = _stream(spark, d, "health_pages").select(domain(F.col("url")).alias("host"), "page_id")
    return S.run_once(S.cap_per_host(pages, 5))


def stream_events(spark, d):
    """Tumbling windows over the stream; the last windows stay open until a later event closes them."""
    return S.run_once(S.windowed(_stream(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp")), "ts", "1 day", by=["event_type"]))


def events_tumbling(spark, d):
    return S.windowed(table(spark, d, "events"), "ts", "1 day", by=["event_type"])


def events_sliding(spark, d):
    return S.windowed(table(spark, d, "events"), "ts", "2 days", "1 day")


def event_sessions(spark, d):
    return S.sessions(table(spark, d, "events"), "ts", "user_id", "12 hours")


def pricing_rollup(spark, d):
    li = table(spark, d, "lineitem")
    out = li.rollup("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_extendedprice"), 2).alias("total"), F.grouping_id().cast("long").alias("level"))
    return out


def region_revenue(spark, d):
    t = {n: table(spark, d, n) for n in ("lineitem", "orders", "customer", "nation", "region")}
    j = t["lineitem"].join(t["orders"], F.col("l_orderkey") == F.col("o_orderkey")).join(t["customer"], F.col("o_custkey") == F.col("c_custkey"))
    j = j.join(t["nation"], F.col("c_nationkey") == F.col("n_nationkey")).join(t["region"], F.col("n_regionkey") == F.col("r_regionkey"))
    return j.groupBy("r_name").agg(F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"))


def top_orders(spark, d):
    w = Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey")
    return table(spark, d, "orders").withColumn("rank", F.row_number().over(w).cast("long")).where("rank <= 2").select("o_custkey", "o_orderkey", "rank")


def customers_without_orders(spark, d):
    return table(spark, d, "customer").join(table(spark, d, "orders"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


def order_gaps(spark, d):
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    days = F.datediff("o_orderdate", F.lag("o_orderdate").over(w))
    return table(spark, d, "orders").select("o_orderkey", days.cast("long").alias("days"))


def key_sets(spark, d):
    a, b = table(spark, d, "customer").select(F.col("c_nationkey").alias("k")), table(spark, d, "supplier").select(F.col("s_nationkey").alias("k"))
    return a.intersect(b).withColumn("part", F.lit("both")).unionByName(a.exceptAll(b).distinct().withColumn("part", F.lit("more")))


QUERIES = {f.__name__: f for f in (stream_dedup, stream_host_cap, stream_events, events_tumbling, events_sliding, event_sessions, pricing_rollup, region_revenue, top_orders, customers_without_orders, order_gaps, key_sets)}
ORACLE = {
    "stream_dedup": "SELECT DISTINCT sha256(text) AS content_sha256 FROM documents",
    # one batch: the first pages of a host by page id, deliveries counted one by one
    "stream_host_cap": "SELECT host, page_id FROM (SELECT host, page_id, row_number() OVER (PARTITION BY host ORDER BY page_id) AS r FROM (SELECT page_id, replace(lower(regexp_extract(url, '//([^/?#]*)', 1)), 'www.', '') AS host FROM health_pages)) WHERE r <= 5",
    # a window is given out once the latest event is past its end by the lateness allowed
    "stream_events": "SELECT date_trunc('day', ts) AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL HAVING date_trunc('day', any_value(ts)) + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE",
    "events_tumbling": "SELECT date_trunc('day', ts) AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL",
    "events_sliding": "SELECT w AS window_start, count(*) AS n, round(sum(value), 4) AS total FROM (SELECT value, unnest([date_trunc('day', ts), date_trunc('day', ts) - INTERVAL 1 DAY]) AS w, ts FROM events) GROUP BY 1",
    "event_sessions": "WITH g AS (SELECT user_id, ts, CASE WHEN lag(ts) OVER w IS NULL OR ts >= lag(ts) OVER w + INTERVAL 12 HOUR THEN 1 ELSE 0 END AS s FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), n AS (SELECT *, sum(s) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g) SELECT user_id, min(ts) AS session_start, count(*) AS n FROM n GROUP BY user_id, k",
    "pricing_rollup": "SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_extendedprice), 2) AS total, grouping_id(l_returnflag, l_linestatus) AS level FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)",
    "region_revenue": "SELECT r_name, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1",
    "top_orders": "SELECT o_custkey, o_orderkey, rank FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders) WHERE rank <= 2",
    "customers_without_orders": "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)",
    "order_gaps": "SELECT o_orderkey, date_diff('day', (lag(o_orderdate) OVER w)::DATE, o_orderdate::DATE) AS days FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)",
    "key_sets": "SELECT k, 'both' AS part FROM (SELECT c_nationkey AS k FROM customer INTERSECT SELECT s_nationkey FROM supplier) UNION ALL SELECT k, 'more' FROM (SELECT DISTINCT k FROM (SELECT c_nationkey AS k FROM customer EXCEPT ALL SELECT s_nationkey FROM supplier))",
}
