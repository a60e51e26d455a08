"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str | None] = {"folder": None}


def build_session(app_name: str = "shopgauge", master: str | None = None, **conf) -> SparkSession:
    """A session with adaptive execution, UTC dates and day-wise overwrite.

    Nothing here fixes the number of partitions: adaptive execution sizes
    them, and a caller can pass any setting as a keyword with dots written as
    double underscores.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), str(value))
    return builder.getOrCreate()


def scratch_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it.

    Only a session on one machine may do without ``spark.checkpoint.dir``; it
    gets a temporary folder. On a cluster a local folder would be lost with its
    machine, so there the setting is required.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        named = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not named and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not named:
        named = _LOCAL["folder"] or tempfile.mkdtemp(prefix="shopgauge-")
        _LOCAL["folder"] = named
    return named


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the scratch folder that no other call returns."""
    return os.path.join(scratch_folder(spark), f"{name}-{uuid.uuid4().hex}")


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as a Parquet table in the scratch folder and read it back.

    Used where several branches of one query need the same expensive result:
    the readers get column pruning, real sizes and no lineage to recompute.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
