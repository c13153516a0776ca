"""Checks of a dataset as constraint queries, all collected instead of stopping at the first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHAPE = ("check_name", "key", "message")


def _rows(df: DataFrame, name: str, key: Column, message: Column) -> DataFrame:
    return df.select(F.lit(name).alias("check_name"), key.cast("string").alias("key"), message.alias("message"))


def not_unique(df: DataFrame, key: str, name: str) -> DataFrame:
    bad = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return _rows(bad, name, F.col(key), F.format_string("occurs %d times", "n"))


def missing_values(df: DataFrame, key: str, columns: list[str], name: str) -> DataFrame:
    """One row per key and required column that is null or blank."""
    types = dict(df.dtypes)
    empty = [F.when(F.col(c).isNull() | ((F.trim(F.col(c)) == "") if types[c] == "string" else F.lit(False)), F.lit(c)) for c in columns]
    gone = df.select(F.col(key), F.explode(F.filter(F.array(*empty), lambda x: x.isNotNull())).alias("c"))
    return _rows(gone, name, F.col(key), F.concat(F.col("c"), F.lit(" is missing")))


def unknown_values(df: DataFrame, key: str, column: str, allowed: list[str], name: str) -> DataFrame:
    bad = df.where(F.col(column).isNotNull() & ~F.col(column).isin(*allowed))
    return _rows(bad, name, F.col(key), F.concat(F.lit(f"{column}="), F.col(column)))


def orphans(df: DataFrame, key: str, foreign: str, parents: DataFrame, parent_key: str, name: str) -> DataFrame:
    """Rows whose foreign key no parent has; null foreign keys are none."""
    bad = df.where(F.col(foreign).isNotNull()).join(parents.select(F.col(parent_key).alias(foreign)).distinct(), foreign, "left_anti")
    return _rows(bad, name, F.col(key), F.concat(F.lit("unknown "), F.col(foreign).cast("string")))


def array_orphans(df: DataFrame, key: str, foreign: str, parents: DataFrame, parent_key: str, name: str) -> DataFrame:
    each = df.select(F.col(key), F.explode(foreign).alias(foreign))
    return orphans(each, key, foreign, parents, parent_key, name)


def failing(df: DataFrame, key: str, condition: Column, name: str, message: str) -> DataFrame:
    """Rows for which a condition that should hold does not (null counts as not)."""
    return _rows(df.where(~F.coalesce(condition, F.lit(False))), name, F.col(key), F.lit(message))


def all_violations(*checks: DataFrame) -> DataFrame:
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    return out


def citation_coverage(df: DataFrame, citations: str, parents: DataFrame, parent_key: str) -> DataFrame:
    """One row: citations in all, known, unknown; aggregated per cited key before the join."""
    used = df.select(F.explode(citations).alias("k")).groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    known = parents.select(F.col(parent_key).alias("k"), F.lit(True).alias("known")).distinct()
    both = used.join(known, "k", "left")
    return both.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_citations"), F.coalesce(F.sum(F.when(F.col("known"), F.col("n"))), F.lit(0)).alias("n_known"), F.coalesce(F.sum(F.when(F.col("known").isNull(), F.col("n"))), F.lit(0)).alias("n_unknown"))


def distribution(df: DataFrame, label: Column) -> DataFrame:
    return df.groupBy(label.alias("label")).agg(F.count(F.lit(1)).alias("n"))


def filled_ratio(df: DataFrame, group: Column, column: str) -> DataFrame:
    filled = F.count_if(F.coalesce(F.trim(F.col(column)), F.lit("")) != "")
    return df.groupBy(group.alias("grp")).agg(F.count(F.lit(1)).alias("n_rows"), filled.alias("n_filled"), F.round(filled / F.count(F.lit(1)), 6).alias("ratio"))


def most_common(df: DataFrame, column: str, n: int = 8) -> DataFrame:
    """The n most frequent values; ties by value."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), column).limit(n)
