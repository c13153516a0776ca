"""Session factory and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession


def get_session(app: str = "textloom", cpus: str | None = None) -> SparkSession:
    """A local session for tests and benches; on a cluster spark-submit's settings win."""
    cpus = cpus or os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("TEXTLOOM_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for written intermediate results.

    Taken from ``spark.checkpoint.dir``; only where that is unset and all tasks run in this
    process (tests) a temporary folder is made and set. On a cluster it must be set.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="textloom-checkpoint-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage through a reliable checkpoint (files all executors can read)."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def ship(spark: SparkSession) -> None:
    """Give this package to the executors, once per Spark context, so that Python workers can import it."""
    sc = spark.sparkContext
    if getattr(sc, "_textloom_shipped", False):
        return
    base = os.path.dirname(os.path.abspath(__file__))
    made = os.path.join(tempfile.mkdtemp(prefix="textloom-"), "textloom.zip")
    with zipfile.ZipFile(made, "w") as z:
        for folder, _, names in os.walk(base):
            for n in names:
                if not n.endswith(".pyc"):
                    z.write(os.path.join(folder, n), os.path.join("textloom", os.path.relpath(os.path.join(folder, n), base)))
    sc.addPyFile(made)
    sc._textloom_shipped = True


def map_pandas(df: DataFrame, f, schema: str) -> DataFrame:
    """``mapInPandas`` with this package importable in the workers."""
    ship(df.sparkSession)
    return df.mapInPandas(f, schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
