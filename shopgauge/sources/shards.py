"""Reading daily source shards and counting them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import SOURCE_EVENTS, ddl

SUFFIX = "source_table_suffix"


def read_shards(
    spark: SparkSession, path: str, first: str | None = None, last: str | None = None
) -> DataFrame:
    """Shards stored as Parquet folders by suffix, optionally one range of days.

    The range is a filter on the partition column, so other days are not listed
    or read.
    """
    return in_range(spark.read.schema(ddl(SOURCE_EVENTS)).parquet(path), first, last)


def in_range(shards: DataFrame, first: str | None, last: str | None) -> DataFrame:
    if first is not None:
        shards = shards.where(F.col(SUFFIX) >= first)
    if last is not None:
        shards = shards.where(F.col(SUFFIX) <= last)
    return shards


def one_shard(shards: DataFrame, suffix: str) -> DataFrame:
    return shards.where(F.col(SUFFIX) == suffix)


def shard_dates(shards: DataFrame) -> DataFrame:
    """Suffixes that exist, one row per day."""
    return shards.select(F.col(SUFFIX).alias("date_suffix")).distinct()


def shard_row_counts(rows: DataFrame, name: str = "source_rows") -> DataFrame:
    """Rows per day suffix; works on shards and on raw tables."""
    return rows.groupBy(F.col(SUFFIX).alias("date_suffix")).agg(F.count("*").alias(name))
