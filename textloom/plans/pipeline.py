"""A data set refreshed step by step: the order follows from what a step reads."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean
from ..operators import curation, validate
from ..session import table
from ..sources.sinks import current_version, write_version


@dataclass(frozen=True)
class Step:
    """``make`` gets the tables in ``reads``, in order."""

    name: str
    reads: tuple[str, ...]
    make: Callable[..., DataFrame]


def order(steps: list[Step], inputs: set[str]) -> list[str]:
    """The steps' names in the order they can run; what nothing makes and no input gives is an error, as is a circle."""
    by = {s.name: s for s in steps}
    unknown = {r for s in steps for r in s.reads} - set(by) - set(inputs)
    if unknown:
        raise KeyError(f"nothing makes {sorted(unknown)}")
    sorter, out = TopologicalSorter({s.name: set(s.reads) & set(by) for s in steps}), []
    sorter.prepare()
    while sorter.is_active():
        ready = sorted(sorter.get_ready())
        out += ready
        sorter.done(*ready)
    return out


def dry_run(spark, steps: list[Step], inputs: set[str]) -> DataFrame:
    """(place, step, reads): what ``run`` would do; nothing is read or written."""
    by = {s.name: s for s in steps}
    rows = [(k, name, ";".join(by[name].reads)) for k, name in enumerate(order(steps, inputs), 1)]
    return spark.createDataFrame(rows, "place long, step string, reads string")


def run(steps: list[Step], inputs: dict[str, DataFrame], place: str | None = None) -> dict[str, DataFrame]:
    """All tables by name. With a ``place`` every step is written as a version there and read back.

    Nothing is computed without a ``place`` until a result is used.
    """
    by, done = {s.name: s for s in steps}, dict(inputs)
    for name in order(steps, set(inputs)):
        made = by[name].make(*(done[r] for r in by[name].reads))
        if place:
            write_version(made, f"{place}/{name}")
            made = current_version(made.sparkSession, f"{place}/{name}")
        done[name] = made
    return done


def _cleaned(rows: DataFrame) -> DataFrame:
    return rows.withColumn("assistant_output", F.when(F.col("assistant_output").isNotNull(), clean(F.col("assistant_output"))["text"]))


def _violations(rows: DataFrame, catalog: DataFrame) -> DataFrame:
    return validate.all_violations(
        validate.not_unique(rows, "interaction_id", "interaction_id is unique"),
        validate.missing_values(rows, "interaction_id", ["raw_input", "assistant_output"], "fields are filled"),
        validate.array_orphans(rows, "interaction_id", "citations", catalog, "source_id", "citations are in the catalogue"),
    )


REFRESH = [
    Step("summary", ("routed",), lambda r: r.groupBy("target").agg(F.count(F.lit(1)).alias("n"))),
    Step("routed", ("cleaned",), lambda r: r.withColumn("target", curation.route(F.col("interaction_id"), F.col("review_status"), F.col("risk_level")))),
    Step("cleaned", ("rows",), _cleaned),
    Step("violations", ("cleaned", "catalog"), _violations),
    Step("rows", ("interactions",), lambda i: curation.first_per_key(i, [F.col("interaction_id")], [F.col("ingested_at"), F.col("raw_input"), F.col("assistant_output")])),
]


def _refreshed(spark, d):
    i = table(spark, d, "interaction_examples").select("interaction_id", "review_status", "raw_input", "assistant_output", "citations", "risk_level", "ingested_at")
    return run(REFRESH, {"interactions": i, "catalog": table(spark, d, "source_catalog")})


def refresh_summary(spark, d):
    return _refreshed(spark, d)["summary"]


def refresh_violations(spark, d):
    return _refreshed(spark, d)["violations"].groupBy("check_name").agg(F.count(F.lit(1)).alias("n"))


def refresh_plan(spark, d):
    return dry_run(spark, REFRESH, {"interactions", "catalog"})


def latest_sources(spark, d):
    cat = table(spark, d, "source_catalog").select(F.upper(F.trim("source_id")).alias("source_id"), "last_checked_date", "title", "url")
    return curation.last_per_key(cat, [F.col("source_id")], [F.col("last_checked_date"), F.col("title"), F.col("url")]).select("source_id", "last_checked_date", "title")


def id_ends(spark, d):
    return curation.first_and_last(table(spark, d, "interaction_examples"), "interaction_id")


_ROWS = "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY interaction_id ORDER BY ingested_at NULLS FIRST, raw_input NULLS FIRST, assistant_output NULLS FIRST) AS rn FROM interaction_examples) WHERE rn = 1"
QUERIES = {f.__name__: f for f in (refresh_summary, refresh_violations, refresh_plan, latest_sources, id_ends)}
ORACLE = {
    "refresh_summary": f"SELECT CASE WHEN NOT coalesce(review_status IN ('human_reviewed', 'clinician_reviewed'), false) THEN 'review_queue' WHEN coalesce(risk_level IN ('urgent_care', 'emergency_care'), false) THEN 'safety_train' WHEN ('0x' || substr(md5(interaction_id), 1, 8))::BIGINT % 5 = 0 THEN 'validation' ELSE 'train' END AS target, count(*) AS n FROM ({_ROWS}) GROUP BY 1",
    "refresh_violations": f"WITH r AS ({_ROWS}) SELECT check_name, count(*) AS n FROM (SELECT 'fields are filled' AS check_name FROM r WHERE coalesce(trim(raw_input, ' '), '') = '' UNION ALL SELECT 'fields are filled' FROM r WHERE coalesce(trim(regexp_replace(assistant_output, '[ \\t\\n\\x0B\\f\\r]{{2,}}', ' ', 'g'), ' '), '') = '' UNION ALL SELECT 'citations are in the catalogue' FROM (SELECT unnest(citations) AS c FROM r) WHERE c IS NOT NULL AND c NOT IN (SELECT source_id FROM source_catalog WHERE source_id IS NOT NULL)) GROUP BY 1",
    "refresh_plan": "SELECT * FROM (VALUES (1::BIGINT, 'rows', 'interactions'), (2, 'cleaned', 'rows'), (3, 'routed', 'cleaned'), (4, 'violations', 'cleaned;catalog'), (5, 'summary', 'routed')) AS t(place, step, reads)",
    "latest_sources": "SELECT source_id, last_checked_date, title FROM (SELECT upper(trim(source_id, ' ')) AS source_id, last_checked_date, title, row_number() OVER (PARTITION BY upper(trim(source_id, ' ')) ORDER BY last_checked_date DESC NULLS LAST, title DESC NULLS LAST, url DESC NULLS LAST) AS r FROM source_catalog) WHERE r = 1",
    "id_ends": "WITH d AS (SELECT DISTINCT interaction_id AS value FROM interaction_examples WHERE interaction_id IS NOT NULL) SELECT * FROM (SELECT value, 'first' AS \"end\" FROM d ORDER BY value LIMIT 5) UNION ALL SELECT * FROM (SELECT value, 'last' FROM d ORDER BY value DESC LIMIT 2)",
}
