"""Writers: JSON lines, CSV, versions of a dataset, split outputs, one file per key, manifests."""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_json_lines(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines with nulls kept and other than ASCII characters escaped."""
    df.write.mode(mode).option("ignoreNullFields", "false").option("writeNonAsciiCharacterAsCodePoint", "true").json(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header in every file; quotes are doubled, white space around values stays."""
    df.write.mode(mode).options(header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)


def write_splits(df: DataFrame, path: str, column: str = "split") -> None:
    """A folder per value, so that reading one split reads nothing else."""
    df.write.mode("overwrite").partitionBy(column).parquet(path)


def write_sorted_lines(df: DataFrame, column: str, path: str) -> None:
    """Distinct lines in order, in files whose names follow the order."""
    df.select(F.col(column).cast("string").alias("value")).distinct().repartitionByRange("value").sortWithinPartitions("value").write.mode("overwrite").text(path)


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def write_version(df: DataFrame, root: str) -> str:
    """A new version beside the old ones, made current by one rename: a dataset may be derived from itself.

    Readers use ``current_version``; a write that fails leaves the current version as it was.
    """
    spark = df.sparkSession
    fs, base = _fs(spark, root)
    old = [f.getPath().getName() for f in (fs.listStatus(base) if fs.exists(base) else [])]
    n = max((int(x[1:]) for x in old if x.startswith("v") and x[1:].isdigit()), default=0) + 1
    at = f"{root}/v{n:06d}"
    df.write.mode("overwrite").parquet(f"{at}.part")
    fs.rename(_fs(spark, f"{at}.part")[1], _fs(spark, at)[1])
    return at


def _versions(spark: SparkSession, root: str) -> list[str]:
    fs, base = _fs(spark, root)
    names = sorted(f.getPath().getName() for f in fs.listStatus(base)) if fs.exists(base) else []
    return [x for x in names if x.startswith("v") and x[1:].isdigit()]


def current_version(spark: SparkSession, root: str) -> DataFrame:
    """The last version; FileNotFoundError where there is none, and no other error."""
    names = _versions(spark, root)
    if not names:
        raise FileNotFoundError(f"no version under {root}")
    return spark.read.parquet(f"{root}/{names[-1]}")


def drop_versions(spark: SparkSession, root: str, keep: int = 2) -> None:
    """Removes all but the last ``keep`` versions."""
    fs, _ = _fs(spark, root)
    for x in _versions(spark, root)[: -max(keep, 1)]:
        fs.delete(_fs(spark, f"{root}/{x}")[1], True)


def folder_of(path: str) -> str:
    """A path on the executors' own file system without its scheme; other schemes stay."""
    return re.sub(r"^file:/+", "/", path)


def _save(rows, folder: str, suffix: str):
    from pyarrow import fs as arrow_fs

    fs, base = arrow_fs.FileSystem.from_uri(folder)
    fs.create_dir(base, recursive=True)
    for r in rows:
        at = f"{base}/{r['key']}{suffix}"
        if fs.get_file_info(at).type == arrow_fs.FileType.NotFound:
            with fs.open_output_stream(f"{at}.part") as f:
                f.write(bytes(r["value"]))
            fs.move(f"{at}.part", at)


def write_file_per_key(df: DataFrame, key: str, value: str, folder: str, suffix: str = ".xml") -> None:
    """One file per key in a shared folder or object store; text as UTF-8, binary as it is.

    Files that are there are kept, so a repeated task does no harm; null keys and values write nothing.
    """
    rows = df.select(F.col(key).cast("string").alias("key"), F.col(value).cast("binary").alias("value")).where("key is not null and value is not null")
    at = folder_of(folder)
    rows.foreachPartition(lambda part: _save(part, at, suffix))


def manifest(df: DataFrame, counts: dict, **facts) -> DataFrame:
    """One row: aggregates of a dataset and given facts, as JSON."""
    row = df.agg(*(c.alias(k) for k, c in counts.items()))
    return row.select(F.to_json(F.struct(*row.columns, *(F.lit(v).alias(k) for k, v in facts.items()))).alias("manifest"))


def write_manifest(df: DataFrame, path: str) -> None:
    """The one row of ``manifest`` as a JSON file, on the file system of the path."""
    text = json.dumps(json.loads(df.first()["manifest"]), indent=2, sort_keys=True) + "\n"
    fs, at = _fs(df.sparkSession, path)
    out = fs.create(at, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
