"""New rows from templates: deterministic picks instead of a random generator's state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import digest_bucket, strip_fragments
from .curation import numbered


def pick(key: Column, salt: str, options: Sequence[str]) -> Column:
    """One of the options by a digest of salt and key: the same on every run, evenly spread."""
    return F.element_at(F.array(*(F.lit(o) for o in options)), digest_bucket(F.concat(F.lit(salt), key), len(options)) + 1)


def chance(key: Column, salt: str, percent: int) -> Column:
    return digest_bucket(F.concat(F.lit(salt), key), 100) < percent


def prepended(text: Column, paragraph: Column) -> Column:
    """The paragraph before the text, unless the text holds it already or it is blank."""
    has = F.contains(F.coalesce(text, F.lit("")), paragraph) | (F.trim(paragraph) == "")
    return F.when(F.coalesce(has, F.lit(True)), text).otherwise(F.concat_ws(" ", paragraph, text))


def context_paragraph(parts: Sequence[Column], most: int = 4) -> Column:
    """The first ``most`` sentences that are there, in order."""
    return F.array_join(F.slice(F.filter(F.array(*parts), lambda x: x.isNotNull()), 1, most), " ")


def varied(df: DataFrame, key: str, text: str, openers: Sequence[str], closers: Sequence[str], fragments: Sequence[str] = ()) -> DataFrame:
    """Fixed fragments taken out and an opener and a closer put around, picked per key."""
    k = F.col(key).cast("string")
    return df.withColumn(text, F.concat_ws(" ", pick(k, "open", openers), strip_fragments(F.col(text), fragments), pick(k, "close", closers)))


def scaled(templates: DataFrame, target: int, suffixes: Sequence[tuple[str, int]], text: str = "raw_input") -> DataFrame:
    """(row_no, template columns, text): ``target`` distinct texts from templates and suffixes at chances (percent).

    Twice the target is drawn and reduced to distinct texts; fewer come out if the templates cannot
    make as many. Rows are made by a range, so their number does not pass through the driver.
    """
    n = templates.count()
    order = F.md5(F.concat_ws("|", *(F.col(c).cast("string") for c in templates.columns)))
    places = numbered(templates.withColumn("_by", order), ["_by"], "_t").withColumn("_t", (F.col("_t") - 1).cast("int")).drop("_by")
    rows = templates.sparkSession.range(2 * target).withColumn("_t", F.pmod(F.col("id"), F.lit(max(n, 1))).cast("int"))
    k = F.col("id").cast("string")
    extra = [F.when(chance(k, s, p), F.lit(s)) for s, p in suffixes]
    made = rows.join(places, "_t").withColumn(text, F.concat_ws(" ", F.col(text), *extra))
    once = made.groupBy(text).agg(F.min_by(F.struct(*made.columns), "id").alias("r")).select("r.*")
    return once.orderBy("id").limit(target).withColumnRenamed("id", "row_no").drop("_t")



def summary(hint: Column, parts: Sequence[tuple[Column, Column]], text: Column, most: int = 140) -> Column:
    """The hint where it is filled; else the texts of the parts whose condition holds; else the text's beginning."""
    said = F.filter(F.array(*(F.when(F.coalesce(c, F.lit(False)), t) for c, t in parts)), lambda x: x.isNotNull())
    return F.when(F.coalesce(hint, F.lit("")) != "", hint).when(F.size(said) > 0, F.array_join(said, "; ")).otherwise(F.substring(text, 1, most))


def rebuilt(df: DataFrame, key: str, text: str, slots: Sequence[Sequence[str]], fragments: Sequence[str], context: Column | None = None) -> DataFrame:
    """Fixed fragments stripped, the rest put between picked openers (all slots but the last) and a picked closer, and the context before."""
    k = F.col(key).cast("string")
    picked = [pick(k, f"slot{i}", options) for i, options in enumerate(slots)]
    body = F.concat_ws(" ", *picked[:-1], F.nullif(strip_fragments(F.col(text), fragments), F.lit("")), picked[-1])
    return df.withColumn(text, prepended(body, context) if context is not None else body)
