"""Stored tables: create, reload by day, rebuild, append, report files.

Tables are snapshots, see ``snapshots``: a reader sees a table as it was before a
write or as it is after it. The raw ones are partitioned by day suffix, so a reload
replaces folders of whole days and a reader skips the other days.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import PIPELINE_RUNS, ddl
from . import snapshots
from .shards import SUFFIX


def table_exists(spark: SparkSession, path: str) -> bool:
    """False only when nothing is stored there; any other trouble raises."""
    try:
        spark.read.format("binaryFile").load(path).schema  # lists the folder only
        return True
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def create_if_absent(spark: SparkSession, path: str, columns: dict[str, str]) -> None:
    """An empty table, unless one is there. Its columns are those that readers declare."""
    snapshots.create(spark, path)


def read_table(spark: SparkSession, path: str, columns: dict[str, str]) -> DataFrame:
    return snapshots.read(spark, path, ddl(columns))


def reload_day(
    rows: DataFrame, path: str, day, column: str = SUFFIX, cluster_by: tuple = ()
) -> None:
    """Replace one day of a table partitioned by ``column``.

    A day that has become empty is cleared, and running it twice leaves the
    same rows as running it once.
    """
    reload_days(rows, path, [day], column, cluster_by, by_day_already=True)


def reload_days(
    rows: DataFrame,
    path: str,
    days: list | None = None,
    column: str = SUFFIX,
    cluster_by: tuple = (),
    by_day_already: bool = False,
) -> None:
    """Replace many days in one write; all days found in ``rows`` when none are named.

    Rows are rebalanced by day first: adaptive execution splits a heavy day
    over several files and joins light ones. Rows read from files of single
    days (``by_day_already``) are written as they come, without a shuffle.
    ``cluster_by`` sorts inside the files for row-group statistics. Named days
    without rows are cleared: the folders written tell which days have any.
    """
    if days == []:
        return
    if days is not None:
        rows = rows.where(in_days(column, days))
    laid_out = rows if by_day_already else rows.hint("rebalance", column)
    if cluster_by:
        laid_out = laid_out.sortWithinPartitions(column, *cluster_by)
    snapshots.replace_partitions(laid_out, path, column, days)


def in_days(column: str, days: list) -> Column:
    """Rows of some days, of which NULL may be one; never NULL itself."""
    known = F.coalesce(F.col(column).isin([day for day in days if day is not None]), F.lit(False))
    return known | F.col(column).isNull() if None in days else known


def merge_by_key(
    batch: DataFrame, path: str, key: str, column: str, gone: DataFrame | None = None
) -> list:
    """Merge ``batch`` into a table partitioned by ``column``; returns the days rewritten.

    Rows of ``batch`` replace those of equal key, wherever these lie; keys in
    ``gone`` that ``batch`` lacks disappear. Which partitions hold such keys is
    found from the two columns alone, and only these are read in full and
    rewritten; the others keep their files. Columns follow those of ``batch``.
    ``batch`` is read several times and has one row per key, so store it first.
    """
    spark = batch.sparkSession
    target = snapshots.read(spark, path, batch.schema)
    keys = batch.select(key) if gone is None else batch.select(key).union(gone.select(key)).distinct()
    held = target.select(key, column).join(keys, key, "left_semi").select(column)
    days = [row[0] for row in held.union(batch.select(column)).distinct().collect()]  # one per day
    kept = target.where(in_days(column, days)).join(keys, key, "left_anti").select(*batch.columns)
    reload_days(kept.unionByName(batch), path, days, column)
    return days


def rebuild_by_day(rows: DataFrame, path: str, column: str) -> None:
    """Replace a whole table partitioned by ``column``."""
    snapshots.replace_all(rows.hint("rebalance", column), path, column)


def rebuild(df: DataFrame, path: str) -> DataFrame:
    """Replace a whole table and read it back. ``df`` may read from the table as it was."""
    snapshots.replace_all(df, path)
    return snapshots.read(df.sparkSession, path, df.schema)


def append_runs(runs: DataFrame, path: str) -> None:
    """Add many attempts at once, such as the days of a backfill."""
    snapshots.append(runs.select(*PIPELINE_RUNS), path)


def write_report(report: DataFrame, path: str) -> None:
    """Replace a report: text files with a header row, in the report's order. One that breaks leaves the old one."""
    snapshots.replace_folder(report.write.option("header", True).csv, report.sparkSession, path)
