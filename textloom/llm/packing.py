"""Problem 8: texts packed whole into containers of fixed capacity.

Sum-of-squares packing, online: the next text goes to the fill level that makes the sum of the
squared numbers of partly filled containers per level smallest; the numbers stand in an array with
a place for each level. Among equal choices the fullest container is taken. A separator between two
texts is part of the size: texts of size + separator into capacity + separator.

The texts are dealt to shards by a hash and each shard packed on its own; then the containers that
are still open are put together as wholes across the shards, in rounds of ``FAN_IN`` shards to one,
until one shard is left. An open container is one row in those rounds, whatever it holds, and is put
into the fullest one that has room, the fullest first. After that no two containers of a shard fit
together, so at most one is half full or less, and of the others only one can ever take it: two go
on into the next round, the rest are closed. A round thus has ``FAN_IN * SHARD_ROWS`` rows a task at
most, the later ones twice ``FAN_IN``.
"""

from __future__ import annotations

from bisect import bisect_right, insort

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpointed, ship

SHARD_ROWS, FAN_IN, MAX_PACKS = 20_000, 16, 1000


class SumOfSquares:
    """Containers of one capacity; ``place`` gives the number of the container a size goes to."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.count = np.zeros(capacity + 1, np.int64)
        self.open: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.used: list[int] = []

    def place(self, size: int) -> int:
        c = self.capacity
        best, level = (2 * self.count[size] + 1 if size < c else 0), 0
        if size < c:
            n = self.count[1 : c - size + 1]
            if n.any():
                cost = 1 - 2 * n
                cost[:-1] += 2 * self.count[1 + size : c] + 1
                cost[n == 0] = np.iinfo(np.int64).max
                k = len(cost) - 1 - int(cost[::-1].argmin())  # the fullest of the best
                if cost[k] <= best:
                    level = k + 1
        if level:
            box = self.open[level].pop()
            self.count[level] -= 1
        else:
            box = len(self.used)
            self.used.append(0)
        self.used[box] += size
        if level + size < c:
            self.open[level + size].append(box)
            self.count[level + size] += 1
        return box


class FullestFirst(SumOfSquares):
    """Each size into the fullest container that has room."""

    def __init__(self, capacity: int):
        super().__init__(capacity)
        self.levels: list[int] = []  # of open containers, in order

    def place(self, size: int) -> int:
        k = bisect_right(self.levels, self.capacity - size) - 1
        level = self.levels.pop(k) if k >= 0 else 0
        if k >= 0:
            box = self.open[level].pop()
        else:
            box = len(self.used)
            self.used.append(0)
        self.used[box] += size
        if level + size < self.capacity:
            self.open[level + size].append(box)
            insort(self.levels, level + size)
        return box


def closed(levels: np.ndarray, capacity: int) -> np.ndarray:
    """Which containers of a shard nothing more is to be put into, sizes and capacity with the separator.

    Those without room for the emptiest, and of those more than half full all that are more than the
    others can fill, the emptiest being kept open.
    """
    shut = levels + levels.min(initial=capacity) > capacity
    small = 2 * levels <= capacity
    large = np.flatnonzero(~small & ~shut)
    large = large[np.argsort(levels[large], kind="stable")]
    shut[large[max(int(small.sum()), 1) :]] = True
    return shut


def _pack(pdf: pd.DataFrame) -> pd.DataFrame:
    """One shard of one pack: rows (pack_name, shard, capacity, separator, key, size, first)."""
    pdf = pdf.sort_values(["rank", "key"], kind="stable").reset_index(drop=True)
    sep = int(pdf["separator"].iat[0])
    capacity = int(pdf["capacity"].iat[0]) + sep
    boxes = SumOfSquares(capacity) if pdf["first"].iat[0] else FullestFirst(capacity)
    where = np.array([boxes.place(int(z) + sep) for z in pdf["size"]], np.int64)
    used = np.array(boxes.used, np.int64)
    # a shard knows of the others' containers only that they may be as empty as one token; after a
    # round of whole containers its own two open ones are all that can matter
    shut = used >= capacity if pdf["first"].iat[0] else closed(used, capacity)
    out = pdf[["pack_name", "shard", "key"]].copy()
    out["box"] = where
    out["level"] = used[where] - sep
    out["shut"] = shut[where]
    return out


_PACKED = "pack_name string, shard long, key string, box long, level long, shut boolean"


def pack_items(items: DataFrame, packs: list[tuple[str, int, int]]) -> DataFrame:
    """(pack_name, container, item, position) for items (item, size) with size <= every capacity asked.

    ``items`` must have a pack_name and, per pack, unique item keys (strings).
    """
    spark = items.sparkSession
    ship(spark)
    dims = F.create_map(*(x for n, c, s in packs for x in (F.lit(n), F.struct(F.lit(c).cast("long").alias("c"), F.lit(s).cast("long").alias("s")))))
    rows = items.groupBy("pack_name").count().collect()  # one row per pack, MAX_PACKS at most
    shards = {r["pack_name"]: max(1, -(-r["count"] // SHARD_ROWS)) for r in rows}
    if not shards:
        return spark.createDataFrame([], "pack_name string, container string, item string, position int")
    n_shards = F.create_map(*(x for n, k in shards.items() for x in (F.lit(n), F.lit(k).cast("long"))))
    work = items.select("pack_name", F.pmod(F.xxhash64("item"), n_shards[F.col("pack_name")]).alias("shard"), F.xxhash64("item", F.lit(1)).alias("rank"), F.col("item").alias("key"), "size")
    with_dims = work.select("*", dims[F.col("pack_name")]["c"].alias("capacity"), dims[F.col("pack_name")]["s"].alias("separator"))
    with_dims = with_dims.withColumn("first", F.lit(True))
    packed = checkpointed(with_dims.groupBy("pack_name", "shard").applyInPandas(_pack, _PACKED))
    name = F.concat_ws(".", F.col("shard").cast("string"), F.col("box").cast("string"))
    placed = packed.select("pack_name", F.col("key").alias("item"), name.alias("container"))
    boxes = packed.select("pack_name", "shard", name.alias("container"), "level", "shut").distinct()
    most, turn = max(shards.values()), 0
    while most > 1:
        most, turn = -(-most // FAN_IN), turn + 1
        cap = dims[F.col("pack_name")]["c"]
        room = F.col("level") + dims[F.col("pack_name")]["s"]
        # nothing fits where not even the emptiest open container of the pack would
        least = {r["pack_name"]: r["least"] for r in boxes.where(~F.col("shut") & (room < cap)).groupBy("pack_name").agg(F.min("level").alias("least")).collect()}  # MAX_PACKS rows at most
        caps = {n: c - s for n, c, s in packs}
        least = {n: k for n, k in least.items() if 2 * k <= caps[n]}
        if not least:
            break
        emptiest = F.create_map(*(x for n, k in least.items() for x in (F.lit(n), F.lit(k).cast("long"))))[F.col("pack_name")]
        open_ = boxes.where(~F.col("shut") & (room + emptiest <= cap))
        again = open_.select("pack_name", F.floor(F.col("shard") / FAN_IN).alias("shard"), (-F.col("level")).alias("rank"), F.col("container").alias("key"), F.col("level").alias("size"))
        again = again.select("*", cap.alias("capacity"), dims[F.col("pack_name")]["s"].alias("separator"), F.lit(False).alias("first"))
        moved = checkpointed(again.groupBy("pack_name", "shard").applyInPandas(_pack, _PACKED))
        new = F.concat_ws(".", F.lit(f"r{turn}"), F.col("shard").cast("string"), F.col("box").cast("string"))
        moved = moved.select("pack_name", "shard", F.col("key").alias("container"), new.alias("to"), "level", "shut")
        placed = placed.join(moved.select("pack_name", "container", "to"), ["pack_name", "container"], "left").select("pack_name", "item", F.coalesce("to", "container").alias("container"))
        boxes = moved.select("pack_name", "shard", F.col("to").alias("container"), "level", "shut").distinct()
    return placed.select("pack_name", "container", "item")


def pack_texts(sizes: DataFrame, packs: DataFrame) -> DataFrame:
    """(pack_name, container, position, id, part_no, start_token, n_tokens) for sizes (id, n_tokens).

    ``packs`` has pack_name, capacity_tokens, separator_tokens. A text longer than the capacity is cut
    into full containers and a rest that is packed like a text; all others stay whole. Texts without
    tokens and null ids take part in nothing; rows of one id count once (the largest).
    """
    spec = [(r["pack_name"], int(r["capacity_tokens"]), int(r["separator_tokens"])) for r in packs.limit(MAX_PACKS + 1).collect()]
    if len(spec) > MAX_PACKS:
        raise ValueError(f"at most {MAX_PACKS} packs")
    spec = [x for x in dict.fromkeys(spec) if x[1] > 0]
    if not spec:
        return sizes.sparkSession.createDataFrame([], f"pack_name string, container string, position int, id {dict(sizes.dtypes)['id']}, part_no int, start_token long, n_tokens long")
    texts = sizes.where("n_tokens > 0 and id is not null").groupBy("id").agg(F.max("n_tokens").alias("n"))
    each = F.explode(F.array(*(F.struct(F.lit(n).alias("pack_name"), F.lit(c).cast("long").alias("c")) for n, c, _ in spec)))
    parts = texts.select("id", "n", each.alias("p")).select("id", "n", "p.pack_name", "p.c")
    last = F.floor((F.col("n") - 1) / F.col("c")).cast("int")
    parts = parts.select("pack_name", "id", "c", "n", F.explode(F.sequence(F.lit(0), last)).alias("part_no"))
    parts = parts.select("pack_name", "id", "part_no", (F.col("part_no") * F.col("c")).alias("start_token"), F.least("c", F.col("n") - F.col("part_no") * F.col("c")).alias("n_tokens"), "c")
    parts = parts.withColumn("item", F.concat_ws("/", F.col("id").cast("string"), F.col("part_no").cast("string")))
    parts = checkpointed(parts)
    loose = parts.where("n_tokens < c")
    placed = pack_items(loose.select("pack_name", "item", F.col("n_tokens").alias("size")), spec).select("pack_name", "container", "item")
    placed = loose.join(placed, ["pack_name", "item"])
    full = parts.where("n_tokens = c").withColumn("container", F.concat(F.lit("f"), "item"))
    out = placed.unionByName(full.select(placed.columns))
    from pyspark.sql import Window

    # a container's rows are at most its capacity in tokens
    order = Window.partitionBy("pack_name", "container").orderBy("id", "part_no")
    return out.select("pack_name", "container", (F.row_number().over(order) - 1).alias("position"), "id", "part_no", "start_token", "n_tokens")


def packing_report(placed: DataFrame, packs: DataFrame) -> DataFrame:
    """Per pack: texts, tokens, containers, the fewest that could hold them, and the share of room used."""
    dims = F.broadcast(packs.select("pack_name", "capacity_tokens", "separator_tokens").distinct().limit(MAX_PACKS))
    boxes = placed.groupBy("pack_name", "container").agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("n"))
    agg = boxes.groupBy("pack_name").agg(F.sum("n").alias("n_items"), F.sum("tokens").alias("n_tokens"), F.count(F.lit(1)).alias("n_containers")).join(dims, "pack_name")
    need = F.ceil((F.col("n_tokens") + F.col("n_items") * F.col("separator_tokens")) / (F.col("capacity_tokens") + F.col("separator_tokens")))
    return agg.select("pack_name", "capacity_tokens", "n_items", "n_tokens", "n_containers", need.alias("least_containers"), F.round(F.col("n_tokens") / (F.col("n_containers") * F.col("capacity_tokens")), 6).alias("fill"))
