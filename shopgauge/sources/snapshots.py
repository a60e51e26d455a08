"""Tables whose readers never see half a write.

A write puts its files into a folder of its own below ``data``. Then one small file in
``manifest`` names the folders that now make up the table; it is written beside and
renamed, so it is there as a whole or not at all. Readers go by the manifest with the
highest number. A write that breaks leaves the table as it was. One writer at a time.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

#: Fixed value: the name that Spark gives to the partition of NULL.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
#: Manifests that ``expire`` leaves, for readers that began with an earlier one.
KEEP = 10


class _Files:
    """Spark's own access to the file system of a path."""

    def __init__(self, spark: SparkSession, path: str):
        context = spark.sparkContext
        self.path = context._jvm.org.apache.hadoop.fs.Path
        self.fs = self.path(path).getFileSystem(context._jsc.hadoopConfiguration())

    def names(self, folder: str) -> list[str]:
        """What lies in a folder, hidden names left out; nothing if there is no folder."""
        where = self.path(folder)
        if not self.fs.exists(where):
            return []
        found = [status.getPath().getName() for status in self.fs.listStatus(where)]
        return sorted(name for name in found if name[0] not in "._")

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def publish(self, name: str, text: str) -> None:
        """Write a file under a hidden name, then rename it; fails if the name is taken."""
        folder, last = name.rsplit("/", 1)
        hidden = self.path(f"{folder}/.{last}-{uuid.uuid4().hex}")
        stream = self.fs.create(hidden, False)
        try:
            stream.write(text.encode())
        finally:
            stream.close()
        if self.fs.exists(self.path(name)) or not self.fs.rename(hidden, self.path(name)):
            self.fs.delete(hidden, False)
            raise RuntimeError(f"another writer has published {name}")

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)

    def put_in_place(self, fresh: str, name: str) -> None:
        """A folder that has been written takes the place of another."""
        self.delete(name)
        if not self.fs.rename(self.path(fresh), self.path(name)):
            raise RuntimeError(f"{fresh} could not be renamed")


def _manifest(path: str, number: int) -> str:
    return f"{path}/manifest/{number:012d}"


def exists(spark: SparkSession, path: str) -> bool:
    """True once something, be it an empty table, has been published."""
    return bool(_Files(spark, path).names(f"{path}/manifest"))


def folders(spark: SparkSession, path: str) -> list[str]:
    """The folders that make up the table now, relative to ``data``: one for each write and partition."""
    files = _Files(spark, path)
    numbers = files.names(f"{path}/manifest")
    return files.read(f"{path}/manifest/{numbers[-1]}").split() if numbers else []


def partitions(spark: SparkSession, path: str) -> list[str]:
    """The partitions with rows, such as ``day=20240101``."""
    return sorted({folder.split("/", 1)[1] for folder in folders(spark, path) if "/" in folder})


def read(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """The table as it is now, with the columns of ``schema`` (text or a type) in their order.

    Columns that older files lack are NULL, columns no longer declared are left
    out. The partition column is known from the folders, so filters on it
    leave folders unread. A table that has been written as a whole can be read
    without a schema.
    """
    now = folders(spark, path)
    if schema is None:
        return spark.read.option("basePath", f"{path}/data").parquet(*[f"{path}/data/{f}" for f in now]).drop("version")
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if not now:
        return spark.createDataFrame([], schema)
    found = spark.read.schema(schema).option("basePath", f"{path}/data").parquet(*[f"{path}/data/{f}" for f in now])
    return found.select(*[f"`{c}`" for c in schema.names])


def _publish(spark: SparkSession, path: str, now: list[str]) -> None:
    files = _Files(spark, path)
    numbers = files.names(f"{path}/manifest")
    files.publish(_manifest(path, int(numbers[-1]) + 1 if numbers else 1), "\n".join(now))


def _write(rows: DataFrame, path: str, by: str | None) -> list[str]:
    """Store rows in a new folder; returns it, or its partitions, which are none if there are no rows."""
    version = f"version=v{uuid.uuid4().hex}"
    writer = rows.write.partitionBy(by) if by else rows.write
    writer.parquet(f"{path}/data/{version}")
    if not by:
        return [version]
    inside = _Files(rows.sparkSession, path).names(f"{path}/data/{version}")
    return [f"{version}/{name}" for name in inside]


def create(spark: SparkSession, path: str) -> None:
    """An empty table, unless one is there."""
    if not exists(spark, path):
        _publish(spark, path, [])


def clear(spark: SparkSession, path: str) -> None:
    """The table becomes empty."""
    _publish(spark, path, [])


def forget(spark: SparkSession, path: str) -> None:
    """The table counts as never built; its files go with ``expire``."""
    _Files(spark, path).delete(f"{path}/manifest")


def replace_all(rows: DataFrame, path: str, by: str | None = None) -> None:
    """The table becomes ``rows``, which may read from the table as it was."""
    _publish(rows.sparkSession, path, _write(rows, path, by))


def replace_partitions(rows: DataFrame, path: str, by: str, named: list | None = None) -> None:
    """The partitions found in ``rows``, and those ``named``, become what ``rows`` holds of them.

    A named partition without rows disappears: the folders that were written
    tell which have any.
    """
    spark = rows.sparkSession
    written = _write(rows, path, by)
    gone = {folder.split("/", 1)[1] for folder in written}
    gone |= {f"{by}={NO_VALUE if value is None else value}" for value in named or []}
    kept = [folder for folder in folders(spark, path) if folder.split("/", 1)[1] not in gone]
    _publish(spark, path, kept + written)


def append(rows: DataFrame, path: str) -> None:
    """The table and ``rows`` besides."""
    spark = rows.sparkSession
    _publish(spark, path, folders(spark, path) + _write(rows, path, None))


def replace_folder(write, spark: SparkSession, path: str) -> None:
    """Have ``write`` fill a folder, then let it replace the one at ``path``, for files that others read by their place.

    A write that breaks leaves the old folder; only for the rename is there none.
    """
    fresh = f"{path}.{uuid.uuid4().hex}"
    try:
        write(fresh)
        _Files(spark, path).put_in_place(fresh, path)
    finally:
        _Files(spark, path).delete(fresh)


def compact(spark: SparkSession, path: str, schema, most: int = 32) -> bool:
    """Rewrite a table of more than ``most`` appended folders as one; True if there was something to do."""
    if len(folders(spark, path)) <= most:
        return False
    replace_all(read(spark, path, schema).coalesce(1), path)
    return True


def expire(spark: SparkSession, path: str, keep: int = KEEP) -> int:
    """Delete manifests but the last ``keep``, and writes that none of these names; returns how many writes went.

    Writes that broke go as well, so nothing may be written meanwhile.
    """
    files = _Files(spark, path)
    numbers = files.names(f"{path}/manifest")
    used = {folder.split("/")[0] for n in numbers[-keep:] for folder in files.read(f"{path}/manifest/{n}").split()}
    for number in numbers[:-keep]:
        files.delete(f"{path}/manifest/{number}")
    stale = [name for name in files.names(f"{path}/data") if name not in used]
    for name in stale:
        files.delete(f"{path}/data/{name}")
    return len(stale)
