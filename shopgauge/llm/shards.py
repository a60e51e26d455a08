"""Shards of near equal bytes by histogram sort.

Rows are ordered by a key: the hash of the text, then the id, so equal texts
lie side by side. Splitters are found without sorting: each round counts the
exact bytes below many candidate boundaries, keeps for every splitter the
interval that holds its target, and probes only that interval more finely in
the next round. When all splitters are close enough, rows are exchanged once.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopgauge.llm.common import store, text_of

#: Hexadecimal digits of a key, and how many of them a round adds: 4096 probes in each open interval.
KEY, STEP = 32, 3
#: A splitter may be off by this share of a shard's bytes.
TOLERANCE = 0.001
#: Tasks that share the rows of one shard when places in it are given out.
PARTS = 64
#: Bytes counted for a row besides its text.
OVERHEAD = 16


def key_of(doc_id: str = "doc_id", text: str = "text") -> Column:
    """32 hexadecimal digits: hash of the text, then the id (nought where null)."""
    half = lambda c: F.lpad(F.hex(c), 16, "0")
    return F.concat(half(F.xxhash64(text_of(text))), half(F.coalesce(F.col(doc_id).cast("long"), F.lit(0))))


def size_of(text: str = "text") -> Column:
    return (F.octet_length(text_of(text)) + OVERHEAD).cast("long")


@dataclass
class Splitter:
    """The interval of keys beginning with ``prefix`` holds the target; ``below`` bytes lie before it."""

    target: float
    prefix: str = ""
    below: int = 0
    boundary: str | None = None


def splitters(rows: DataFrame, shards: int, tolerance: float = TOLERANCE) -> list[str]:
    """``shards - 1`` ascending boundaries over ``key`` so that the sums of ``size`` are near equal.

    A row belongs to the shard whose number is the count of boundaries that
    aren't above its key. Only counts reach the driver, at most 4096 for each
    splitter and round. A single row, or rows that share the whole key, are
    never divided; then the nearer side is taken.
    """
    total = rows.agg(F.sum("size")).first()[0] or 0
    open_ = [Splitter(total * k / shards) for k in range(1, shards)]
    found = list(open_)
    slack = tolerance * total / shards
    depth = 0
    while open_ and depth < KEY and total:
        prefixes = sorted({s.prefix for s in open_})
        inside = rows if depth == 0 else rows.where(F.substring("key", 1, depth).isin(prefixes))
        step = min(STEP, KEY - depth)
        counted = (
            inside.groupBy(F.substring("key", 1, depth + step).alias("prefix"))
            .agg(F.sum("size").alias("size"), F.min("key").alias("least"), F.max("key").alias("most"))
            .collect()
        )
        bins: dict[str, list] = {}
        for r in sorted(counted, key=lambda r: r["prefix"]):
            bins.setdefault(r["prefix"][:depth], []).append(r)
        for s in open_:
            below = s.below
            for r in bins[s.prefix]:
                above = below + r["size"]
                if above >= s.target:
                    break
                below = above
            low, high = r["prefix"], r["prefix"] + "G"  # "G" sorts behind every hexadecimal digit
            near = (low, s.target - below) if s.target - below <= above - s.target else (high, above - s.target)
            if near[1] <= slack or r["least"] == r["most"]:
                s.boundary = near[0]
            else:
                s.prefix, s.below = r["prefix"], below
        open_ = [s for s in open_ if s.boundary is None]
        depth += step
    return sorted(s.boundary or s.prefix for s in found)


def shard_of(boundaries: list[str], key: str = "key") -> Column:
    return reduce(lambda a, b: a + b, [(F.col(key) >= b).cast("int") for b in boundaries], F.lit(0))


def place(rows: DataFrame, shards: int, parts: int = PARTS) -> DataFrame:
    """``rows`` (with ``key`` and ``size``) with their ``shard`` and a gapless ``slot`` in it.

    The rows of a shard are numbered in ``parts`` groups by hash, each beginning
    where the groups before it end, so no task holds a whole shard. The counts
    of groups are the only thing broadcast: ``shards * parts`` rows at most.
    An empty table stays empty.
    """
    cut = rows.withColumn("shard", shard_of(splitters(rows, shards))).withColumn("part", F.pmod(F.xxhash64("key"), F.lit(parts)))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begins = cut.groupBy("shard", "part").count().select("shard", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("begin"))
    order = Window.partitionBy("shard", "part").orderBy("key", "size")
    return (
        cut.withColumn("at", F.row_number().over(order) - 1)
        .join(F.broadcast(begins), ["shard", "part"])
        .withColumn("slot", F.col("at") + F.col("begin"))
        .drop("at", "begin", "part")
    )


def shard_table(docs: DataFrame, shards: int) -> DataFrame:
    """``doc_id, size, text_crc32, key, shard, slot`` of every row.

    Null texts count as empty, null ids as 0 in the key. The narrow rows are
    written once to the shared folder, so the texts are read a single time.
    """
    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        size_of().alias("size"),
        F.crc32(text_of().cast("binary")).alias("text_crc32"),
        key_of().alias("key"),
    )
    return place(store(narrow, "shard-keys"), shards)


def write_shards(docs: DataFrame, path: str, shards: int) -> None:
    """The documents themselves, one folder per shard, each row with its slot."""
    rows = docs.drop("key", "size", "shard", "slot", "part", "at", "begin").withColumn("key", key_of()).withColumn("size", size_of())
    place(rows, shards).drop("key", "size").write.partitionBy("shard").parquet(path)
