"""Structured Streaming: ingest once per content, caps per host, windows over events, orphan upkeep."""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.references import merge_counts
from ..session import checkpoint_root, ship
from ..sources.files import path_exists


def _place(spark: SparkSession, place: str | None) -> str:
    return place or f"{checkpoint_root(spark)}/stream-{uuid.uuid4().hex}"


def run_once(stream: DataFrame, place: str | None = None, mode: str = "append") -> DataFrame:
    """All that is there, through the stream, into files under ``place``; the result as a table.

    Called again with the same place it takes up where it stopped: only new input is read.
    """
    spark = stream.sparkSession
    at = _place(spark, place)
    stream.writeStream.format("parquet").option("path", f"{at}/out").option("checkpointLocation", f"{at}/log").outputMode(mode).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{at}/out")


def once_per_content(stream: DataFrame, text: str) -> DataFrame:
    """The first row of each content; the state holds one digest per content seen."""
    return stream.withColumn("content_sha256", F.sha2(F.col(text), 256)).dropDuplicates(["content_sha256"])


def _stream_id(spark: SparkSession, log: str) -> str:
    """The id a stream keeps with its checkpoint."""
    return spark.read.text(f"{log}/metadata").select(F.get_json_object("value", "$.id")).first()[0]


def batches(spark: SparkSession, place: str, but: tuple[str, int] | None = None) -> DataFrame | None:
    """What the batches under ``place`` hold, without the one of this stream and number; null where there is none.

    Only a missing folder is "none": whatever else goes wrong on reading is an error.
    """
    if not path_exists(spark, f"{place}/stream=*"):
        return None
    rows = spark.read.option("basePath", place).parquet(f"{place}/stream=*/batch=*")
    if but:
        rows = rows.where(~((F.col("stream") == but[0]) & (F.col("batch") == but[1])))
    return rows.drop("stream", "batch")


def _write_batch(df: DataFrame, place: str, stream: str, number: int) -> None:
    """A folder per stream and batch: a batch that is delivered again writes the same folder again."""
    df.write.mode("overwrite").parquet(f"{place}/stream={stream}/batch={number}")


def _each_batch(stream: DataFrame, place: str, make) -> None:
    log = f"{place}-log"

    def batch(df: DataFrame, number: int) -> None:
        me = _stream_id(df.sparkSession, log)
        _write_batch(make(df, batches(df.sparkSession, place, (me, number))), place, me, number)

    stream.writeStream.foreachBatch(batch).option("checkpointLocation", log).trigger(availableNow=True).start().awaitTermination()


def ingest_new(stream: DataFrame, text: str, place: str) -> None:
    """Rows whose content is not yet in the batches under ``place`` are added to them, batch by batch.

    A batch is appended; what was there is read for its digests only and never written again.
    """

    def new(df: DataFrame, known: DataFrame | None) -> DataFrame:
        fresh = df.withColumn("content_sha256", F.sha2(F.col(text), 256)).dropDuplicates(["content_sha256"])
        return fresh if known is None else fresh.join(known.select("content_sha256"), "content_sha256", "left_anti")

    _each_batch(stream, place, new)


def _cap(key, batches, state: GroupState, most: int):
    n = state.get[0] if state.exists else 0
    for pdf in batches:
        keep = pdf.sort_values("page_id").head(max(0, most - n))
        n += len(keep)
        if len(keep):
            yield pd.DataFrame({"host": [key[0]] * len(keep), "page_id": keep["page_id"].tolist()})
    state.update((n,))


def cap_per_host(stream: DataFrame, most: int) -> DataFrame:
    """(host, page_id): at most ``most`` pages of a host over the whole stream; the state is a count."""
    ship(stream.sparkSession)
    rows = stream.select("host", "page_id")
    return rows.groupBy("host").applyInPandasWithState(lambda k, b, s: _cap(k, b, s, most), "host string, page_id long", "n long", "append", GroupStateTimeout.NoTimeout)


def windowed(events: DataFrame, time: str, length: str, slide: str | None = None, late: str = "10 minutes", by: list[str] | None = None, value: str = "value") -> DataFrame:
    """Counts and sums per window, for a table or a stream; late rows within ``late`` are counted."""
    rows = events.withWatermark(time, late) if events.isStreaming else events
    w = F.window(time, length, slide) if slide else F.window(time, length)
    out = rows.groupBy(w.alias("w"), *(by or [])).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(value), 4).alias("total"))
    return out.select(F.col("w.start").alias("window_start"), *(by or []), "n", "total")


def sessions(events: DataFrame, time: str, by: str, gap: str, late: str = "10 minutes") -> DataFrame:
    """Runs of events of one key with pauses shorter than ``gap``."""
    rows = events.withWatermark(time, late) if events.isStreaming else events
    out = rows.groupBy(F.session_window(time, gap).alias("w"), by).agg(F.count(F.lit(1)).alias("n"))
    return out.select(by, F.col("w.start").alias("session_start"), "n")


def keep_reference_counts(deltas: DataFrame, place: str) -> None:
    """Upkeep of signed reference and existence counts from a stream of (key, refs, exist) deltas.

    Each batch appends its own sums per key; ``reference_counts`` adds them up.
    """

    def sums(df: DataFrame, _: DataFrame | None) -> DataFrame:
        rows = df.select("key", F.col("refs").cast("long"), F.col("exist").cast("long"))
        return merge_counts(rows.limit(0), rows)

    _each_batch(deltas, place, sums)


def reference_counts(spark: SparkSession, place: str) -> DataFrame:
    """(key, refs, exist) over all batches under ``place``."""
    rows = batches(spark, place)
    if rows is None:
        return spark.createDataFrame([], "key string, refs long, exist long")
    return merge_counts(rows.limit(0), rows)
