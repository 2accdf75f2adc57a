"""Session helpers shared by queries, benchmarks and tests."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the parquet tables of a scale-factor directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir``.

    Only where the setting is absent (tests, a laptop) and the master is local is a
    temporary folder made and recorded in the session.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.sparkContext.master
        if not master.startswith("local[") and master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="paperloom-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path


def shared_path(spark: SparkSession) -> str:
    """:func:`shared_dir` as a path for memory mapping; it must be a mounted file system."""
    path = shared_dir(spark)
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    if "://" in path:
        raise ValueError(f"memory-mapped files need a mounted shared folder, not {path}")
    os.makedirs(path, exist_ok=True)
    return path


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    spark = df.sparkSession
    sc = spark.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)
