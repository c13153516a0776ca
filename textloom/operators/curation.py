"""Dedup, deterministic splits, queues, samples, id assignment and review updates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import digest_bucket
from ..session import checkpointed

# States of review that count as reviewed, levels that count as high, and their order.
REVIEWED = ("human_reviewed", "clinician_reviewed")
HIGH_LEVELS = ("urgent_care", "emergency_care")
LEVELS = ("normal_variation", "routine_review", "prompt_medical_review", "urgent_care", "emergency_care")


def level_rank(c: Column) -> Column:
    """Place of an ordered level, 0 for unknown ones."""
    m = F.create_map(*(x for k, v in enumerate(LEVELS) for x in (F.lit(v), F.lit(k))))
    return F.coalesce(F.try_element_at(m, c), F.lit(0))


def higher_level(a: Column, b: Column) -> Column:
    names = F.array(*(F.lit(v) for v in LEVELS))
    return F.element_at(names, F.greatest(level_rank(a), level_rank(b)) + 1)


def first_per_key(df: DataFrame, keys: list[Column], order: list[Column]) -> DataFrame:
    """The first row of each key in the given order; null keys form one key.

    A ``min`` over a struct: partial aggregation keeps one row per key and task, so a key that holds
    a large part of the rows is not gathered anywhere.
    """
    names = [f"_k{i}" for i in range(len(keys))]
    packed = F.struct(*(o.alias(f"_o{i}") for i, o in enumerate(order)), F.struct(*df.columns).alias("_row"))
    kept = df.select(*(k.alias(n) for k, n in zip(keys, names, strict=True)), packed.alias("_x")).groupBy(*names).agg(F.min_by("_x", F.struct(*(F.col(f"_x._o{i}") for i in range(len(order))))).alias("_x"))
    return kept.select("_x._row.*")


def duplicate_groups(df: DataFrame, key: Column, id_col: str) -> DataFrame:
    """(fingerprint, n_rows, first_id) of keys that occur more than once."""
    return df.select(key.alias("fingerprint"), F.col(id_col).alias("id")).groupBy("fingerprint").agg(F.count(F.lit(1)).alias("n_rows"), F.min("id").alias("first_id")).where("n_rows > 1")


def numbered(df: DataFrame, order: list[str], name: str = "ordinal") -> DataFrame:
    """Ordinals from 1 in a total order, without gathering the rows in one task.

    The rows are range-partitioned by the order, counted per partition, and numbered inside each
    partition from its offset; the counts (one number per partition) are all the driver sees. The
    sorted rows are checkpointed first, so both passes see the same partitions.
    """
    ranged = checkpointed(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id()))
    counts = sorted((r["_part"], r["n"]) for r in ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).collect())
    offsets, total = [], 0
    for part, n in counts:
        offsets.append((part, total))
        total += n
    start = F.broadcast(df.sparkSession.createDataFrame(offsets, "_part int, _start long"))
    within = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return ranged.join(start, "_part").withColumn(name, F.col("_start") + within).drop("_part", "_start")


def max_suffix(ids: DataFrame, column: str, pattern: str) -> Column:
    """Aggregate: the largest numeric suffix of ids that match ``pattern`` (one group), 0 for none."""
    return F.coalesce(F.max(F.try_to_number(F.nullif(F.regexp_extract(F.col(column), pattern, 1), F.lit("")), F.lit("999999999999")).cast("long")), F.lit(0))


def review_ok(status: Column) -> Column:
    return F.coalesce(status.isin(*REVIEWED), F.lit(False))


def route(id_: Column, status: Column, level: Column, findings: Column | None = None, folds: int = 5) -> Column:
    """review_queue, safety_train, validation or train, for every row."""
    with_findings = (level == "prompt_medical_review") & (F.size(findings) > 0) if findings is not None else F.lit(False)
    high = F.coalesce(level.isin(*HIGH_LEVELS) | with_findings, F.lit(False))
    return F.when(~review_ok(status), "review_queue").when(high, "safety_train").when(digest_bucket(id_, folds) == 0, "validation").otherwise("train")


def review_queue(df: DataFrame, id_col: str, status_col: str, level_col: str, order: list[str], created: str) -> DataFrame:
    """Unreviewed rows as queue entries, numbered in order."""
    waiting = df.where(~review_ok(F.col(status_col))).select(*order, F.col(id_col).alias("origin_record_id"), F.col(level_col).alias("_level"))
    out = numbered(waiting, order, "n")
    severity = F.when(F.coalesce(F.col("_level").isin(*HIGH_LEVELS), F.lit(False)), "high").otherwise("medium")
    return out.select(F.format_string("RQAUTO%03d", "n").alias("queue_id"), "origin_record_id", severity.alias("severity"), F.lit("Unreviewed case requiring quality routing").alias("reason"), F.lit("open").alias("status"), F.lit(created).alias("created_at"))


def hash_sample(df: DataFrame, id_col: str, n: int, seed: str = "") -> DataFrame:
    """n rows, the smallest by a digest of seed and id: the same rows on every run and engine."""
    return df.orderBy(F.md5(F.concat(F.lit(seed), F.col(id_col).cast("string"))), id_col).limit(n)


def first_n_per_group(df: DataFrame, groups: list[str], order: list[Column], n: int) -> DataFrame:
    """At most n rows of each group (0: all); planned with a group limit before the shuffle."""
    if n <= 0:
        return df
    w = Window.partitionBy(*groups).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= n).drop("_n")


def set_review(df: DataFrame, chosen: DataFrame, id_col: str, status: str, from_status: list[str] | None = None) -> DataFrame:
    """Status, human_reviewed and clinician_reviewed set for the chosen ids."""
    hit = F.col("_hit").isNotNull()
    if from_status:
        hit = hit & F.col("review_status").isin(*from_status)
    marked = df.join(chosen.select(id_col).distinct().withColumn("_hit", F.lit(True)), id_col, "left")
    reviewed = F.lit(status in REVIEWED)
    return marked.withColumns({
        "review_status": F.when(hit, status).otherwise(F.col("review_status")),
        "human_reviewed": F.when(hit, reviewed).otherwise(F.col("human_reviewed")),
        "clinician_reviewed": F.when(hit, F.lit(status == "clinician_reviewed")).otherwise(F.lit(False)),
    }).drop("_hit")


def known_citations(df: DataFrame, id_col: str, column: str, keys: DataFrame, default: list[str]) -> DataFrame:
    """(id, citations): those that are in ``keys`` (key), in order and once; the default where none is.

    A join with the keys, so that their number has no bound. Rows of one id count as one.
    """
    each = df.select(id_col, F.posexplode(column).alias("_pos", "key"))
    hits = each.join(keys.select("key").distinct(), "key", "left_semi").groupBy(id_col).agg(F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct("_pos", "key"))), lambda x: x["key"])).alias(column))
    return df.select(id_col).distinct().join(hits, id_col, "left").select(id_col, F.coalesce(column, F.array(*(F.lit(x) for x in default))).alias(column))


def new_by_text(df: DataFrame, existing: DataFrame, text: str, order: list[Column]) -> DataFrame:
    """Rows whose text, trimmed and in lower case, neither stands in ``existing`` nor before in the batch."""
    key = F.lower(F.trim(F.col(text)))
    fresh = df.withColumn("_key", F.md5(key)).join(existing.select(F.md5(key).alias("_key")).distinct(), "_key", "left_anti").drop("_key")
    return first_per_key(fresh, [key], order)


def with_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Absent columns added, nulls of present ones filled."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) if c in df.columns else F.lit(v) for c, v in defaults.items()})


def fill_missing(df: DataFrame, made: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Null or blank strings filled from ``made`` by key, and nothing else changed."""
    other = made.select(key, *(F.col(c).alias(f"_{c}") for c in columns))
    out = df.join(other, key, "left")
    return out.withColumns({c: F.when(F.coalesce(F.trim(F.col(c)), F.lit("")) == "", F.coalesce(F.col(f"_{c}"), F.col(c))).otherwise(F.col(c)) for c in columns}).drop(*(f"_{c}" for c in columns))


def last_per_key(df: DataFrame, keys: list[Column], order: list[Column]) -> DataFrame:
    """The last row of each key: what a lookup filled row by row holds in the end."""
    names = [f"_k{i}" for i in range(len(keys))]
    packed = F.struct(F.struct(*(o.alias(f"_o{i}") for i, o in enumerate(order))).alias("_o"), F.struct(*df.columns).alias("_row"))
    kept = df.select(*(k.alias(n) for k, n in zip(keys, names, strict=True)), packed.alias("_x")).groupBy(*names).agg(F.max_by("_x._row", "_x._o").alias("_row"))
    return kept.select("_row.*")


def first_and_last(df: DataFrame, column: str, first: int = 5, last: int = 2) -> DataFrame:
    """(value, end): the smallest and the largest distinct values."""
    once = df.select(F.col(column).alias("value")).where("value is not null").distinct()
    a = once.orderBy("value").limit(first).withColumn("end", F.lit("first"))
    return a.unionByName(once.orderBy(F.desc("value")).limit(last).withColumn("end", F.lit("last")))


def article_rows(articles: DataFrame, catalog: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Catalogue rows of articles (name, title, abstract) not known yet, and candidates for review."""
    key = F.concat(F.lit("PMC_"), F.col("name"))
    fresh = articles.withColumn("source_id", key).join(catalog.select("source_id").distinct(), "source_id", "left_anti")
    title = F.coalesce("title", F.lit("Untitled"))
    sources = fresh.select("source_id", title.alias("title"), F.lit("full_text_xml").alias("document_type"), F.lit("retrieval_only").alias("license_status"))
    asked = F.when(F.col("abstract").isNotNull(), F.concat(F.lit("Summarize: "), F.substring("abstract", 1, 500))).otherwise(F.concat(F.lit("Summarize the article: "), title))
    made = fresh.select("source_id", asked.alias("raw_input"), F.substring(title, 1, 180).alias("normalized_case_summary"), F.array("source_id").alias("citations"), F.lit("pending_human_review").alias("review_status"))
    return sources, made
