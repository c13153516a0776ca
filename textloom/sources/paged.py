"""Sources behind an interface of pages: a data source with cursors, lookups by key, and crawling.

What fetches a page is given by name ("module:function"), so that tests use files and a deployment
its own client; nothing here opens a connection.
"""

from __future__ import annotations

import importlib
import json
import os
import time
from functools import partial
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.text import normal_license
from ..session import checkpointed, map_pandas, ship


def _function(name: str):
    module, _, attribute = name.partition(":")
    return getattr(importlib.import_module(module), attribute)


def with_retry(call, *args, tries: int = 4, wait: float = 0.5):
    """The call's result; errors are retried with growing waits, the last one is raised."""
    for k in range(tries):
        try:
            return call(*args)
        except Exception:
            if k == tries - 1:
                raise
            time.sleep(wait * 2**k)


class Pace:
    """At most ``rate`` calls a second in a task; a source's limit is to be parted by the tasks that call it."""

    def __init__(self, rate: float | None, clock=time.monotonic, sleep=time.sleep):
        self.gap, self.next, self.clock, self.sleep = 1 / rate if rate else 0.0, None, clock, sleep

    def wait(self) -> None:
        now = self.clock()
        if self.gap and self.next is not None and self.next > now:
            self.sleep(self.next - now)
            now = self.next
        self.next = now + self.gap


def folder_record(key: str, options: dict) -> str | None:
    """The text of ``<folder>/<key>.json``; null where there is none."""
    at = os.path.join(options["folder"], f"{key}.json")
    if not os.path.exists(at):
        return None
    with open(at, encoding="utf-8") as f:
        return f.read()


def folder_page(query: str, cursor: str, options: dict) -> dict[str, Any]:
    """A page from ``<folder>/<query>_<cursor>.json``: {"results": [...], "next": cursor or null}."""
    with open(os.path.join(options["folder"], f"{query}_{cursor.strip('*') or 'first'}.json"), encoding="utf-8") as f:
        return json.load(f)


class _Chain(InputPartition):
    def __init__(self, query: str):
        self.query = query


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options

    def partitions(self):
        # the pages of one query follow one another; queries are independent
        return [_Chain(q) for q in self.options["queries"].split("|")]

    def read(self, partition):
        fetch = _function(self.options["fetch"])
        cursor, left = "*", int(self.options.get("max_pages", 1_000_000))
        pace = Pace(float(self.options.get("rate", 0)) or None)
        while cursor and left:
            pace.wait()
            page = with_retry(fetch, partition.query, cursor, self.options)
            for row in page.get("results", []):
                yield (partition.query, json.dumps(row, sort_keys=True))
            cursor, left = page.get("next"), left - 1


class PagedSource(DataSource):
    """``spark.read.format("paged")`` with options fetch, queries (parted by ``|``), max_pages."""

    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self) -> str:
        return "query string, record string"

    def reader(self, schema):
        return _Reader(dict(self.options))


def read_pages(spark: SparkSession, fetch: str, queries: list[str], **options) -> DataFrame:
    """(query, record): all records of all pages, as JSON text (use ``parse_json`` or ``from_json``)."""
    ship(spark)
    spark.dataSource.register(PagedSource)
    return spark.read.format("paged").options(fetch=fetch, queries="|".join(queries), **options).load()


def candidates(records: DataFrame) -> DataFrame:
    """Work records into rows: the first location with an archive id decides ``pmcid``."""
    v = F.parse_json("record")
    schema = "struct<id:string,title:string,doi:string,publication_year:int,license:string,locations:array<struct<pmcid:string>>>"
    r = F.from_json(F.to_json(v), schema)
    out = records.select("query", r.alias("r"))
    first = F.try_element_at(F.filter("r.locations", lambda x: F.coalesce(x["pmcid"], F.lit("")) != ""), F.lit(1))
    return out.select("query", F.col("r.id").alias("work_id"), "r.title", "r.doi", "r.publication_year", "r.license", first["pmcid"].alias("pmcid"))


def _lookup(it, fetch: str, options: dict):
    call, pace = _function(fetch), Pace(options.get("rate"))

    def one(k):
        pace.wait()
        return with_retry(call, k, options)

    for pdf in it:
        keys = pdf["key"].tolist()
        yield pd.DataFrame({"key": keys, "value": [one(k) for k in keys]}, dtype="object")


def lookup(keys: DataFrame, key: str, fetch: str, **options) -> DataFrame:
    """(key, value): a value per distinct key; what is not found is null. Join it back by key.

    ``rate`` among the options is the most calls a second of a task.
    """
    once = keys.select(F.col(key).cast("string").alias("key")).where("key is not null").distinct()
    return map_pandas(once, partial(_lookup, fetch=fetch, options=options), "key string, value string")


def enrich(rows: DataFrame, found: DataFrame, key: str, columns: list[str], schema: str) -> DataFrame:
    """Columns of the found record where they are filled, else the row's own; ``enriched`` says which."""
    hit = found.select(F.col("key").alias(key), F.from_json("value", schema).alias("_v"))
    out = rows.join(hit, key, "left")
    new = {c: F.coalesce(F.when(F.trim(F.col("_v")[c]) != "", F.col("_v")[c]), F.col(c) if c in rows.columns else F.lit(None).cast("string")) for c in columns}
    return out.withColumns(new).withColumn("enriched", F.col("_v").isNotNull()).drop("_v")


def eligible(rows: DataFrame, licences: DataFrame, license_col: str = "license", id_col: str = "pmcid") -> DataFrame:
    """Enriched rows with an id whose licence, in its normal spelling, is in ``licences`` (license)."""
    fine = licences.select(normal_license(F.col("license")).alias("_license")).distinct()
    kept = rows.where(F.col("enriched") & (F.trim(F.coalesce(id_col, F.lit(""))) != "")).withColumn("_license", normal_license(F.col(license_col)))
    return kept.join(fine, "_license", "left_semi").drop("_license")


def to_enrich(rows: DataFrame, refresh: bool = False, most: int | None = None) -> DataFrame:
    """Rows with a ``doi`` that were not enriched, with ``refresh`` also those without a licence; the first ``most`` by doi."""
    open_ = ~F.coalesce("enriched", F.lit(False))
    if refresh:
        open_ = open_ | (F.trim(F.coalesce("license", F.lit(""))) == "")
    out = rows.where((F.trim(F.coalesce("doi", F.lit(""))) != "") & open_)
    return out.orderBy("doi").limit(most) if most else out


def crawl(seeds: DataFrame, links: DataFrame, max_depth: int = 3, per_page: int = 25, per_host: int = 4000, allowed: DataFrame | None = None) -> DataFrame:
    """(url, depth): breadth-first over a table of links (url, pos, target), each URL once.

    A step is a join of the frontier with the links and an anti-join with what was seen; both stay
    distributed, and the number of steps is the depth. ``per_page`` first links that pass the filters
    are followed, at most ``per_host`` pages of a host in all (by depth and URL).
    """
    from pyspark.sql import Window

    from ..functions.web import blocked, domain, host_suffixes

    targets = links.where(~blocked(F.col("target")))
    if allowed is not None:
        ok = allowed.select(F.col("domain").alias("suffix")).distinct()
        fine = targets.select("target", F.explode(host_suffixes(domain(F.col("target")))).alias("suffix")).join(ok, "suffix", "left_semi").select("target").distinct()
        targets = targets.join(fine, "target", "left_semi")
    first = Window.partitionBy("url").orderBy("pos", "target")
    targets = targets.withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= per_page).select("url", "target")
    seen = checkpointed(seeds.select("url").distinct().withColumn("depth", F.lit(0)))
    frontier = seen
    for depth in range(1, max_depth + 1):
        new = frontier.join(targets, "url").select(F.col("target").alias("url")).distinct().join(seen.select("url"), "url", "left_anti")
        frontier = checkpointed(new.withColumn("depth", F.lit(depth)))
        seen = checkpointed(seen.unionByName(frontier))
        if frontier.isEmpty():
            break
    host = Window.partitionBy("host").orderBy("depth", "url")
    return seen.withColumn("host", domain(F.col("url"))).withColumn("_n", F.row_number().over(host)).where(F.col("_n") <= per_host).select("url", "depth")
