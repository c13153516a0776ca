"""Problem 9: sources mixed to target shares of the total size.

A mix is a row of equal slots of at most ``SLOT_TOKENS`` tokens, ``LEAST_SLOTS`` at least, so that
sources alternate as closely in a large mix as in a small one. Golden-ratio points, which cover the unit interval evenly
from the first on, are mapped through the cumulative target shares, so that every stretch of the mix
holds the sources near their shares; a source's slots are numbered in order. The source's records,
shuffled by a hash, are laid end to end and cut into blocks of one slot's tokens, records staying
whole with the block they begin in. Slot i takes block i, going round the source again until the
allowed number of repeats is used up; what a source cannot fill stays out, and the shares reached
are reported.

The schedule is made by the tasks, in chunks of ``CHUNK`` slots: a source's slots are counted per chunk,
the counts added up, and the slots numbered within their chunk. The running token sums behind the blocks are taken in two steps, within hash ranges of a source and
over the ranges' totals, so a large source is spread over tasks.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import checkpointed

SLOT_TOKENS, LEAST_SLOTS, CHUNK = 1 << 20, 8192, 1 << 16
RANGE_ROWS, MOST_RANGES, MAX_TARGETS = 100_000, 1 << 20, 10_000
GOLDEN = (5**0.5 - 1) / 2


def schedule(spark: SparkSession, mixes: list[tuple[str, int, list[str], list[float]]]) -> DataFrame:
    """(mix_name, source, slot, nth) for mixes (name, slots, sources, shares): golden-ratio points through the cumulative shares.

    ``nth`` numbers a source's slots from 0 in order.
    """
    edges = [(m, n, names, (np.cumsum(shares) / np.sum(shares)).tolist()) for m, n, names, shares in mixes]
    rows = spark.createDataFrame(edges, "mix_name string, n long, sources array<string>, edges array<double>")  # a row a mix
    chunks = rows.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / CHUNK))).alias("chunk"))
    chunks = chunks.repartition("mix_name", "chunk")
    begin = F.col("chunk") * CHUNK
    slots = chunks.select("mix_name", "chunk", "sources", "edges", F.explode(F.sequence(begin, F.least(begin + CHUNK, F.col("n")) - 1)).alias("slot"))
    u = (F.col("slot") + 0.5) * GOLDEN
    u = u - F.floor(u)
    k = F.least(F.size(F.filter("edges", lambda e: e <= u)), F.size("sources") - 1)
    slots = slots.select("mix_name", "chunk", "slot", F.get("sources", k).alias("source"))
    within = Window.partitionBy("mix_name", "chunk", "source").orderBy("slot")
    slots = slots.withColumn("nth", F.row_number().over(within) - 1)
    before = Window.partitionBy("mix_name", "source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)  # a row a chunk
    counts = slots.groupBy("mix_name", "source", "chunk").agg(F.count(F.lit(1)).alias("c")).withColumn("offset", F.coalesce(F.sum("c").over(before), F.lit(0)))
    return slots.join(counts.drop("c"), ["mix_name", "source", "chunk"]).select("mix_name", "source", "slot", (F.col("nth") + F.col("offset")).alias("nth"))


def _positions(sizes: DataFrame) -> DataFrame:
    """(source, id, n_tokens, begin): where each record begins in its shuffled source.

    The hash ranges grow in number with the rows, so a range of a source that holds everything has
    about RANGE_ROWS rows.
    """
    ranges = min(MOST_RANGES, max(16, -(-sizes.count() // RANGE_ROWS)))
    h = F.xxhash64(F.col("id"), F.lit(9))
    rows = sizes.select("source", "id", "n_tokens", h.alias("h"), F.pmod(F.shiftrightunsigned(h, 20), F.lit(ranges)).alias("range"))
    rows = checkpointed(rows.repartition("source", "range"))
    within = Window.partitionBy("source", "range").orderBy("h", "id").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("before", F.coalesce(F.sum("n_tokens").over(within), F.lit(0)))
    totals = rows.groupBy("source", "range").agg(F.sum("n_tokens").alias("t"))
    over = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    totals = totals.select("source", "range", F.coalesce(F.sum("t").over(over), F.lit(0)).alias("offset"))
    return rows.join(totals, ["source", "range"]).select("source", "id", "n_tokens", (F.col("offset") + F.col("before")).alias("begin"))


def mix_sources(sizes: DataFrame, targets: DataFrame, slot_tokens: int = SLOT_TOKENS, least_slots: int = LEAST_SLOTS) -> tuple[DataFrame, DataFrame]:
    """(drawn, report) for sizes (id, source, n_tokens) and the mixes of ``targets``.

    drawn: mix_name, slot, source, id, repeat_no, n_tokens. report: mix_name, source, target_share,
    target_tokens, tokens, share, available_tokens, n_records, most_repeats, reached. A listed source
    without records is reported with nothing. Null sources, null ids and records without tokens are
    not drawn; of several rows of one id the largest counts. No id is used more than max_repeats times.
    """
    spark = sizes.sparkSession
    spec = targets.select("mix_name", "source", "target_share", "max_repeats", "total_fraction").dropDuplicates(["mix_name", "source"]).orderBy("mix_name", "source").limit(MAX_TARGETS + 1).collect()
    if len(spec) > MAX_TARGETS:
        raise ValueError(f"at most {MAX_TARGETS} targets")
    total = sizes.agg(F.sum("n_tokens")).first()[0] or 0
    sizes = sizes.where("id is not null and source is not null and n_tokens > 0").groupBy("id").agg(F.max(F.struct("n_tokens", "source")).alias("x")).select("id", "x.source", "x.n_tokens")
    wanted = sorted({r["source"] for r in spec if r["source"] is not None})
    rows = checkpointed(_positions(sizes.where(F.col("source").isin(wanted))))
    have = {r["source"]: r["t"] for r in rows.groupBy("source").agg(F.sum("n_tokens").alias("t")).collect()}  # MAX_TARGETS rows at most
    mixes, goals = [], []
    for mix in dict.fromkeys(r["mix_name"] for r in spec):
        own = [r for r in spec if r["mix_name"] == mix and r["target_share"] and r["target_share"] > 0]
        if not own:
            continue
        size = float(total) * own[0]["total_fraction"]
        slots = max(least_slots, -(-int(size) // slot_tokens))
        block = max(1, int(round(size / slots)))
        mixes.append((mix, slots, [r["source"] for r in own], [r["target_share"] for r in own]))
        for r in own:
            n_blocks = -(-have.get(r["source"], 0) // block)
            goals.append((mix, r["source"], float(r["target_share"]), int(round(size * r["target_share"])), int(have.get(r["source"], 0)), int(r["max_repeats"]), block, n_blocks))
    goals_df = spark.createDataFrame(goals, "mix_name string, source string, target_share double, target_tokens long, available_tokens long, max_repeats int, block_tokens long, n_blocks long")
    # MAX_TARGETS rows at most; slots and blocks are as many as the mix is large and joined by hash
    few = F.broadcast(goals_df.where("n_blocks > 0").select("mix_name", "source", "n_blocks", "max_repeats"))
    plan = schedule(spark, mixes).join(few, ["mix_name", "source"]).where(F.col("nth") < F.col("n_blocks") * F.col("max_repeats"))
    slots_df = plan.select("mix_name", "source", "slot", (F.col("nth") % F.col("n_blocks")).alias("block"), F.floor(F.col("nth") / F.col("n_blocks")).cast("int").alias("repeat_no"))
    mixes = F.broadcast(goals_df.select("mix_name", "source", "block_tokens"))
    in_blocks = rows.join(mixes, "source").withColumn("block", F.floor(F.col("begin") / F.col("block_tokens")))
    drawn = checkpointed(in_blocks.join(slots_df, ["mix_name", "source", "block"]).select("mix_name", "slot", "source", "id", "repeat_no", "n_tokens"))
    used = drawn.groupBy("mix_name", "source").agg(F.sum("n_tokens").alias("tokens"), F.countDistinct("id").alias("n_records"), (F.max("repeat_no") + 1).alias("most_repeats"))
    report = goals_df.drop("n_blocks").join(used, ["mix_name", "source"], "left")
    tokens = F.coalesce("tokens", F.lit(0))
    all_ = F.sum(tokens).over(Window.partitionBy("mix_name"))  # one row per target
    report = report.select(
        "mix_name", "source", "target_share", "target_tokens", tokens.alias("tokens"), F.when(all_ > 0, tokens / all_).otherwise(0.0).alias("share"), "available_tokens",
        F.coalesce("n_records", F.lit(0)).alias("n_records"), F.coalesce("most_repeats", F.lit(0)).alias("most_repeats"), (tokens >= 0.98 * F.col("target_tokens")).alias("reached"),
    )
    return drawn, report
