"""Pages into sources and chunks: what is new, what is skipped and why."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import collapse_white, first_filled, organisation, topics
from ..functions.web import path
from . import chunking, curation

MIN_CHARS = 150


def prepared(pages: DataFrame) -> DataFrame:
    """Pages with url, clean text and the fingerprint of both."""
    url = F.trim(F.coalesce(first_filled(F.col("canonical_url"), F.col("url")), F.lit("")))
    text = collapse_white(F.coalesce(F.col("content"), F.lit("")))
    out = pages.select("page_id", url.alias("page_url"), F.trim(F.coalesce("title", F.lit(""))).alias("page_title"), F.col("content").alias("raw_text"), text.alias("clean_text"), F.col("fetched_at"), F.col("publication_date"))
    return out.withColumn("content_sha1", F.sha1(F.concat_ws("\n", "page_url", "clean_text")))


def with_reason(pages: DataFrame, known_hashes: DataFrame | None = None, min_chars: int = MIN_CHARS) -> DataFrame:
    """``reason``: empty, too_short, existing, repeated (an earlier row of the batch) or null for new pages."""
    first = pages.groupBy("content_sha1").agg(F.min(F.struct("fetched_at", "page_id")).alias("first"))
    out = pages.join(first, "content_sha1")
    if known_hashes is not None:
        out = out.join(known_hashes.select("content_sha1").distinct().withColumn("_known", F.lit(True)), "content_sha1", "left")
    else:
        out = out.withColumn("_known", F.lit(None).cast("boolean"))
    reason = (
        F.when((F.col("page_url") == "") | (F.col("clean_text") == ""), "empty")
        .when(F.length("clean_text") < min_chars, "too_short")
        .when(F.col("_known"), "existing")
        .when(~F.col("first").eqNullSafe(F.struct("fetched_at", "page_id")), "repeated")
    )
    return out.withColumn("reason", reason).drop("first", "_known")


def skip_counts(marked: DataFrame) -> DataFrame:
    return marked.groupBy(F.coalesce("reason", F.lit("new")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def assign_sources(new_pages: DataFrame, catalog: DataFrame) -> DataFrame:
    """(page_url, source_id, is_new): the catalogue's id of a known URL, else numbers after the largest."""
    known = catalog.where(F.col("url").isNotNull()).groupBy(F.col("url").alias("page_url")).agg(F.min(F.upper(F.trim("source_id"))).alias("source_id"))
    urls = new_pages.select("page_url").distinct().join(known, "page_url", "left")
    top = catalog.agg(curation.max_suffix(catalog, "source_id", r"^\s*[Ss][Rr][Cc](\d+)\s*$").alias("m")).first()["m"]
    fresh = curation.numbered(urls.where("source_id is null").select("page_url"), ["page_url"], "n")
    fresh = fresh.select("page_url", F.format_string("SRC%05d", F.col("n") + top).alias("source_id"), F.lit(True).alias("is_new"))
    return urls.where("source_id is not null").withColumn("is_new", F.lit(False)).unionByName(fresh)


def source_rows(new_pages: DataFrame, ids: DataFrame, day: str) -> DataFrame:
    """Catalogue rows for the new sources, from the first page of each."""
    first = curation.first_per_key(new_pages, [F.col("page_url")], [F.col("fetched_at"), F.col("page_id")])
    joined = first.join(ids.where("is_new"), "page_url")
    title = F.when(F.col("page_title") != "", F.col("page_title")).otherwise(F.concat(F.lit("Crawled Page "), "source_id"))
    about = F.concat_ws(" ", F.lower(path(F.col("page_url"))), "page_title")
    return joined.select(
        "source_id", title.alias("title"), organisation(F.col("page_url")).alias("organization"), F.col("page_url").alias("url"), F.lit("INTL").alias("country"), F.array_join(topics(about), ";").alias("topic_tags"),
        F.lit("tier2").alias("source_tier"), F.lit("web_scrape").alias("document_type"), F.trim(F.coalesce("publication_date", F.lit(""))).alias("publication_date"), F.lit(day).alias("access_date"), F.lit(day).alias("last_checked_date"),
        F.lit("retrieval_only").alias("license_status"), F.lit("false").alias("trainable_for_model_flag"), F.lit("true").alias("retrieval_only_flag"),
    )


def chunk_rows(new_pages: DataFrame, ids: DataFrame, known_chunks: DataFrame | None = None, max_chars: int = chunking.MAX_CHARS) -> DataFrame:
    """Chunks of the new pages, cut at line breaks before white space is collapsed.

    A page whose URL already has chunks gets ids with the start of its fingerprint, so a changed page
    is a version of its own and no id is given twice.
    """
    rows = new_pages.join(ids, "page_url")
    packed = rows.select("source_id", "is_new", "page_url", "page_title", "content_sha1", "fetched_at", "page_id", F.posexplode(chunking.pack_paragraphs(chunking.paragraphs(F.col("raw_text"), "\n"), max_chars)).alias("pos", "text"))
    name = F.format_string("%s_%s_%03d", "source_id", F.substring("content_sha1", 1, 8), F.col("pos") + 1)
    out = packed.select(name.alias("chunk_id"), "source_id", F.substring("text", 1, 160).alias("claim_summary"), "text", "content_sha1", F.col("page_url").alias("source_url"), F.when(F.col("page_title") != "", F.col("page_title")).otherwise("Untitled").alias("title"), F.col("fetched_at").alias("accessed_at"))
    if known_chunks is not None:
        out = out.join(known_chunks.select("chunk_id").distinct(), "chunk_id", "left_anti")
    return out
