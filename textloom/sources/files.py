"""Readers: JSON lines, CSV, text lines, markdown, word-processor files, article XML, listings."""

from __future__ import annotations

import io
import zipfile
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.text import strip_tags
from ..operators.chunking import paragraphs
from ..session import map_pandas


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p))


def is_folder(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return bool(fs.exists(p) and fs.getFileStatus(p).isDirectory())


def json_lines(spark: SparkSession, path: str, schema: StructType | str, mode: str = "strict", missing_ok: bool = False) -> DataFrame:
    """Rows of JSON-lines files; blank lines are skipped.

    ``strict`` fails on a line that is no JSON (naming the file), ``lenient`` drops it, ``keep`` keeps it
    in ``_corrupt_record``. A missing path is an empty table with ``missing_ok``.
    """
    if missing_ok and not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    options = {"strict": "FAILFAST", "lenient": "DROPMALFORMED", "keep": "PERMISSIVE"}
    return spark.read.schema(schema).option("mode", options[mode]).json(path)


def csv_strings(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header; every value stays a string; quoted commas and line breaks are read."""
    return spark.read.options(header=True, multiLine=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)


def text_lines(spark: SparkSession, path: str, comment: str | None = None) -> DataFrame:
    """(line): trimmed lines without blank ones, and without those that begin with ``comment``."""
    rows = spark.read.text(path).select(F.trim("value").alias("line")).where("line <> ''")
    return rows.where(~F.col("line").startswith(comment)) if comment else rows


def whole_files(spark: SparkSession, path: str, glob: str | None = None, limit: int | None = None) -> DataFrame:
    """(path, text) in the order of the paths."""
    reader = spark.read.option("pathGlobFilter", glob) if glob else spark.read
    rows = reader.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
    return rows.orderBy("path").limit(limit) if limit else rows


def stem(path_col):
    return F.regexp_extract(path_col, r"([^/]+?)(?:\.[^./]*)?$", 1)


def markdown_paragraphs(spark: SparkSession, path: str) -> DataFrame:
    """(path, name, text, paragraphs): paragraphs are parted by blank lines."""
    rows = whole_files(spark, path, "*.md")
    return rows.select("path", stem(F.col("path")).alias("name"), "text", paragraphs(F.col("text")).alias("paragraphs"))


def unique_files(spark: SparkSession, path: str, glob: str) -> DataFrame:
    """(path, content, sha256): of files with the same bytes the first by path."""
    rows = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path", "content")
    rows = rows.withColumn("sha256", F.sha2("content", 256))
    first = rows.groupBy("sha256").agg(F.min("path").alias("path"))
    return rows.join(first, ["sha256", "path"], "left_semi").select("path", "content", "sha256")


def docx_text(content: bytes) -> list[str] | None:
    """Paragraphs of a word-processor file; null for a file that cannot be read."""
    w = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
    try:
        with zipfile.ZipFile(io.BytesIO(content)) as z:
            root = ElementTree.fromstring(z.read("word/document.xml"))
    except (zipfile.BadZipFile, KeyError, ElementTree.ParseError):
        return None
    found = ("".join(t.text or "" for t in p.iter(f"{w}t")).strip() for p in root.iter(f"{w}p"))
    return [x for x in found if x]


def _docx(it):
    for pdf in it:
        yield pd.DataFrame({"path": pdf["path"].tolist(), "paragraphs": [docx_text(c) for c in pdf["content"]]})


def docx_paragraphs(spark: SparkSession, path: str) -> DataFrame:
    """(path, name, paragraphs) of the distinct word-processor files."""
    rows = map_pandas(unique_files(spark, path, "*.docx").select("path", "content"), _docx, "path string, paragraphs array<string>")
    return rows.select("path", stem(F.col("path")).alias("name"), "paragraphs")


def article_xml(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """(name, title, abstract) from the first article-title and abstract elements, tags stripped."""

    def first(tag):
        return F.nullif(strip_tags(F.regexp_extract("text", rf"(?is)<{tag}[^>]*>(.*?)</{tag}>", 1)), F.lit(""))

    return whole_files(spark, path, "*.xml", limit).select(stem(F.col("path")).alias("name"), first("article-title").alias("title"), first("abstract").alias("abstract"))
