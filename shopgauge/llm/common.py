"""What several of the operators share: tables, words, batches, shared scratch."""

from __future__ import annotations

import gc
import os
import shutil
import tempfile
import threading
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import wraps
from math import ceil
from weakref import WeakKeyDictionary

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopgauge.session import scratch_path

#: A word is a run of anything but these ASCII blanks (the same ones bytes.split() cuts at).
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, read by Spark."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shipped(query: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """``query`` (whose first argument is the session), with this package sent to the Python workers first.

    Their import path needn't have the repository. Spark hands the archive out,
    once for each context.
    """

    @wraps(query)
    def run(spark: SparkSession, *rest) -> DataFrame:
        context = spark.sparkContext
        root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        if os.path.isdir(root) and not getattr(context, "_shopgauge_shipped", False):
            context.addPyFile(shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="shopgauge-"), "shopgauge"), "zip", root, "shopgauge"))
            context._shopgauge_shipped = True
        return query(spark, *rest)

    return run


class Stored:
    """Paths of the tables that one caller has stored, so that it can delete them and no others."""

    def __init__(self):
        self.paths: list[str] = []

    def release(self, spark: SparkSession) -> None:
        """Delete the tables; only when every result that reads them has been written."""
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        while self.paths:
            path = jvm.org.apache.hadoop.fs.Path(self.paths.pop())
            path.getFileSystem(conf).delete(path, True)


#: Whose tables are being stored in this thread, if anybody wants to know.
OWNER: ContextVar[Stored | None] = ContextVar("owner", default=None)


@contextmanager
def owned(by: Stored) -> Iterator[Stored]:
    """Tables stored inside belong to ``by``."""
    before = OWNER.set(by)
    try:
        yield by
    finally:
        OWNER.reset(before)


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as a Parquet table in the shared folder and read it back; see ``owned``."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    owner = OWNER.get()
    if owner is not None:
        owner.paths.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Spark's setting that deletes the shuffle files of an execution at its end.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Sessions in which it is on for now: for how many callers, and what it was before.
FREEING: WeakKeyDictionary[SparkSession, tuple[int, str | None]] = WeakKeyDictionary()
FREEING_LOCK = threading.Lock()


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of each table stored inside go when it is written, not with some later garbage collection.

    The setting is the session's. What else is executed in it meanwhile loses its
    shuffle files too; Spark makes them again if the same plan is executed once more.
    """
    with FREEING_LOCK:
        callers, before = FREEING.get(spark) or (0, spark.conf.get(CLEANUP, None))
        FREEING[spark] = callers + 1, before
        spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        with FREEING_LOCK:
            callers, before = FREEING.pop(spark)
            if callers > 1:
                FREEING[spark] = callers - 1, before
            elif before is None:
                spark.conf.unset(CLEANUP)
            else:
                spark.conf.set(CLEANUP, before)


def collect_garbage(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of plans that nothing refers to, between rounds of a long operator."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def text_of(column: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column), F.lit(""))


def remainder(column: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo the divisor. A null id counts as 0."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(0)) % divisor


def slices(batches: Iterator[pa.RecordBatch], rows: int, chars: int) -> Iterator[pa.RecordBatch]:
    """Cut batches into pieces of at most ``rows`` rows and about ``chars`` bytes, one row at least."""
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            size = min(rows, batch.num_rows - at)
            while size > 1 and batch.slice(at, size).get_total_buffer_size() > 0 and nbytes(batch, at, size) > chars:
                size = size // 2
            yield batch.slice(at, size)
            at += size


def nbytes(batch: pa.RecordBatch, at: int, size: int) -> int:
    return batch.slice(at, size).nbytes


def words_of(text: str) -> list[bytes]:
    """The words of a text as UTF-8."""
    return text.encode("utf-8", "surrogatepass").split()


def fraction_for(bound: int, count: int) -> float:
    """The share of rows that keeps about ``bound`` of ``count`` rows, all of them if fewer."""
    return 1.0 if count <= bound else bound / count


def hashed_below(column: str, share: float, seed: int = 7) -> Column:
    """True for a fixed share of the ids, chosen by their hash and so alike on every run."""
    steps = 1_000_000
    return F.pmod(F.xxhash64(F.col(column), F.lit(seed)), F.lit(steps)) < F.lit(ceil(share * steps))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, bound: int) -> tuple[DataFrame, dict[int, int], dict[int, float]]:
    """``doc_id, text, label`` of about ``bound`` documents with each label 0 and 1, how many labels there are, and the shares kept.

    The labels are thinned out by the hash of their id before they meet the
    documents, so what is broadcast has about ``2 * bound`` rows at any size,
    and no text is shuffled. Null texts and labels drop out. Of several labels
    for one id the largest counts.
    """
    usable = labels.where(F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    sizes = {r["label"]: r["count"] for r in usable.groupBy("label").count().collect()}
    shares = {k: fraction_for(bound, n) for k, n in sizes.items()}
    wanted = F.lit(False)
    for k, share in shares.items():
        wanted = wanted | ((F.col("label") == k) & hashed_below("doc_id", share))
    few = F.broadcast(usable.where(wanted))
    return docs.select("doc_id", "text").where("text is not null").join(few, "doc_id"), sizes, shares


def chosen(docs: DataFrame, keep: list[str], made: tuple[str, ...], text: str = "text") -> tuple[DataFrame, list[str]]:
    """The columns to carry along and the text besides, and the names of the former.

    A column that bears the name of one that is made gives way to it.
    """
    keep = [c for c in keep if c not in made]
    return docs.select(*keep, *([] if text in keep else [text])), keep


def schema_with(df: DataFrame, fields: str) -> T.StructType:
    """The columns of ``df`` and the fields named, such as "score double"."""
    return T.StructType([*df.schema.fields, *T.StructType.fromDDL(fields).fields])
