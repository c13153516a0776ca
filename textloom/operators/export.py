"""Training files: chat, completion and metadata rows, and joins by position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .curation import numbered

# The instructions the exported rows begin with.
CHAT_SYSTEM = "You are a women-centric educational assistant. Use safety-first behavior. Never diagnose. If danger signs are present, route to medical care and include clear follow-up steps."
COMPLETION_SYSTEM = "SYSTEM: You are a women-centric educational assistant. Use safety-first responses and cite uncertainty."


def ascii_json(c: Column) -> Column:
    return F.to_json(c, {"ignoreNullFields": "false", "writeNonAsciiCharacterAsCodePoint": "true"})


def answer(c: Column) -> Column:
    return F.trim(F.coalesce(c, F.lit("")))


def chat_rows(df: DataFrame) -> DataFrame:
    """(interaction_id, messages): system, user (a JSON string) and assistant."""
    user = ascii_json(F.struct(F.col("raw_input").alias("question"), "extracted_features", F.coalesce("citations", F.array().cast("array<string>")).alias("citations_used"), F.col("risk_level").alias("risk_level_target")))

    def message(role, content):
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    return df.select("interaction_id", F.array(message("system", F.lit(CHAT_SYSTEM)), message("user", user), message("assistant", answer(F.col("assistant_output")))).alias("messages"))


def completion_rows(df: DataFrame) -> DataFrame:
    """(interaction_id, prompt, completion); line breaks of the completion are written as ``\\n``."""
    none = F.lit("None")
    prompt = F.concat(
        F.lit(COMPLETION_SYSTEM + "\nInput: "), F.coalesce("raw_input", none), F.lit("\nExtracted features: "), F.coalesce(ascii_json(F.col("extracted_features")), F.lit("{}")),
        F.lit("\nTarget risk: "), F.coalesce("risk_level", none), F.lit("\nAssistant:"),
    )
    return df.select("interaction_id", prompt.alias("prompt"), F.replace(answer(F.col("assistant_output")), F.lit("\n"), F.lit("\\n")).alias("completion"))


def metadata_rows(df: DataFrame, source: Column) -> DataFrame:
    return df.select(
        "interaction_id", "data_origin", source.alias("split_source"), "review_status", "risk_level", "raw_input", "normalized_case_summary", F.coalesce("human_reviewed", F.lit(False)).alias("human_reviewed"),
        "care_recommendation", "abstained", F.coalesce("citations", F.array().cast("array<string>")).alias("citations"), F.col("risk_level").alias("label"), "split",
    )


def local_prompt(question: Column, summary: Column) -> Column:
    return F.concat(F.lit("Question: "), F.coalesce(question, F.lit("")), F.lit("\nCase summary: "), F.coalesce(summary, F.lit("")), F.lit("\nAnswer:"))


def exportable(df: DataFrame) -> DataFrame:
    """Rows with both a question and an answer."""
    filled = [F.coalesce(F.trim(F.col(c)), F.lit("")) != "" for c in ("raw_input", "assistant_output")]
    return df.where(filled[0] & filled[1])


def zipped(a: DataFrame, b: DataFrame, order_a: list[str], order_b: list[str]) -> DataFrame:
    """Rows side by side by their place in the given orders; different lengths are an error."""
    x, y = numbered(a, order_a, "_i"), numbered(b, order_b, "_i")
    if x.count() != y.count():
        raise ValueError("the two sides have different numbers of rows")
    return x.join(y, "_i").drop("_i")
