"""Paragraph packing and the unified corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import domain_of_name, first_line, slug

MAX_CHARS = 1200
BLANKS = " \t\n\r\x0b\x0c"


def paragraphs(c: Column, separator: str = "\n\n") -> Column:
    return F.filter(F.transform(F.split(c, separator), lambda p: F.btrim(p, F.lit(BLANKS))), lambda p: p != "")


def pack_paragraphs(items: Column, max_chars: int = MAX_CHARS) -> Column:
    """Neighbouring paragraphs joined by line breaks while they fit.

    The size of the first chunk counts a break after each paragraph, that of a later chunk none after
    its first; a paragraph over the limit stays whole. Only positions are folded, texts are joined at
    the end, so long documents stay linear.
    """
    size = F.transform(items, lambda p: F.length(p))
    start = F.struct(F.array().cast("array<struct<a:int,b:int>>").alias("done"), F.lit(0).alias("a"), F.lit(0).alias("b"), F.lit(0).alias("n"))

    def step(acc, x):
        over = (acc["n"] > 0) & (acc["n"] + 1 + x > max_chars)
        done = F.when(over, F.concat(acc["done"], F.array(F.struct(acc["a"].alias("a"), acc["b"].alias("b"))))).otherwise(acc["done"])
        return F.struct(done.alias("done"), F.when(over, acc["b"]).otherwise(acc["a"]).alias("a"), (acc["b"] + 1).alias("b"), F.when(over, x).otherwise(acc["n"] + x + 1).alias("n"))

    def finish(acc):
        return F.when(acc["b"] > acc["a"], F.concat(acc["done"], F.array(F.struct(acc["a"].alias("a"), acc["b"].alias("b"))))).otherwise(acc["done"])

    spans = F.aggregate(size, start, step, finish)
    return F.transform(spans, lambda s: F.array_join(F.slice(items, s["a"] + 1, s["b"] - s["a"]), "\n"))


def chunks(df: DataFrame, key: Column, text: Column, prefix: str = "", max_chars: int = MAX_CHARS, separator: str = "\n\n") -> DataFrame:
    """(key, chunk_no, chunk_id, text, claim_summary), chunk numbers from 1."""
    packed = df.select(key.alias("key"), F.posexplode(pack_paragraphs(paragraphs(text, separator), max_chars)).alias("pos", "text"))
    no = F.col("pos") + 1
    return packed.select("key", no.alias("chunk_no"), F.format_string(f"{prefix}%s_%03d", slug(F.col("key").cast("string")), no).alias("chunk_id"), "text", first_line(F.col("text")).alias("claim_summary"))


CORPUS_COLUMNS = ("chunk_id", "source_title", "source_type", "domain_group", "topic_tags", "text", "claim_summary", "evidence_strength", "license_status", "geography_scope", "life_stage_scope", "safety_relevance", "trainability", "validation_status", "notes")


def _corpus(df: DataFrame, **columns) -> DataFrame:
    made = {k: v if isinstance(v, Column) else F.lit(v) for k, v in columns.items()}
    return df.select(*(made[c].alias(c) for c in CORPUS_COLUMNS))


def reference_corpus(ref: DataFrame) -> DataFrame:
    tags = F.col("topic_tags")
    return _corpus(
        ref, chunk_id=F.col("chunk_id"), source_title=F.col("source_id"), source_type="official_reference_chunk", domain_group=F.coalesce(F.try_element_at(tags, F.lit(1)), F.lit("unknown")), topic_tags=tags, text=F.col("text"),
        claim_summary=F.col("claim_summary"), evidence_strength="validated", license_status=F.col("license_status"), geography_scope="global_basics", life_stage_scope="mixed", safety_relevance="high",
        trainability="retrieval_only", validation_status="guideline_or_official_source_backed", notes="",
    )


def _derived(made: DataFrame, **literals) -> DataFrame:
    group = domain_of_name(F.col("key").cast("string"))
    return _corpus(made, chunk_id=F.col("chunk_id"), source_title=F.col("key").cast("string"), domain_group=group, topic_tags=F.array(group), text=F.col("text"), claim_summary=F.col("claim_summary"), license_status="local_workspace", geography_scope="mixed", life_stage_scope="mixed", safety_relevance="medium", **literals)


def markdown_corpus(made: DataFrame) -> DataFrame:
    """Chunks of markdown files (as ``chunks`` makes them)."""
    return _derived(made, source_type="local_markdown_summary", evidence_strength="summary", trainability="review_before_training", validation_status="local_summary_needs_source_trace", notes="")


def manual_corpus(made: DataFrame) -> DataFrame:
    """Chunks of word-processor manuals."""
    return _derived(made, source_type="local_docx_manual", evidence_strength="research_or_manual_summary", trainability="retrieval_only_until_verified", validation_status="needs_manual_review", notes="Derived from local docx manual; do not treat as ground truth without validation.")


def corpus_index(corpus: DataFrame) -> DataFrame:
    return corpus.select("chunk_id", "source_title", "source_type", "domain_group", "topic_tags", "claim_summary", "safety_relevance", "trainability")


def validation_matrix(corpus: DataFrame) -> DataFrame:
    return corpus.select("chunk_id", "source_title", "evidence_strength", "license_status", "validation_status", "notes")
