"""Rank over a whole table without gathering it in one partition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

# Number of quantiles that cut the values into ranges, and of pieces the rows
# sharing one heavy value are spread over, unless a caller names another. It
# bounds the tasks that rank at once, so it should follow the cluster's cores.
RANGES = 256
_CHUNK = 16


def _bounds(df: DataFrame, columns: list[str], ranges: int) -> dict[str, list]:
    """Quantiles of each column; fewer than ``ranges`` values of each come to the driver."""
    steps = [i / ranges for i in range(1, ranges)]
    row = df.agg(
        *[F.percentile_approx(name, steps, 10 * ranges).alias(name) for name in columns]
    ).first()
    return {name: sorted(set(row[name] or [])) for name in columns}


def _literal(numbers: list, kind: str) -> Column:
    """An array of constants, passed as one text rather than one call per number."""
    return F.split(F.lit(",".join(map(str, numbers))), ",").cast(f"array<{kind}>")


def _bucket(df: DataFrame, column: str, bounds: list) -> Column:
    """Number of the range a value is in, growing with the value.

    Range ``2i`` lies strictly between two bounds and range ``2i + 1`` is one
    bound itself; -1 holds the missing values. Bounds are searched in two
    steps, first for the chunk and then inside it.
    """
    if not bounds:
        return F.lit(-1)
    kind = df.schema[column].dataType
    value = F.col(column)
    chunks = [bounds[i : i + _CHUNK] for i in range(0, len(bounds), _CHUNK)]

    def literal(values: list) -> Column:
        return _literal(values, kind.simpleString())

    whole = F.size(F.filter(literal([c[-1] for c in chunks]), lambda b: b < value))
    chunk = F.get(F.array(*[literal(c) for c in chunks]), whole)
    below = whole * _CHUNK + F.coalesce(
        F.when(chunk.isNotNull(), F.size(F.filter(chunk, lambda b: b < value))), F.lit(0)
    )
    on_bound = F.coalesce(F.array_contains(chunk, value), F.lit(False)).cast("int")
    # Past the last chunk every bound is smaller.
    position = F.when(whole == len(chunks), F.lit(2 * len(bounds))).otherwise(
        2 * below + on_bound
    )
    return F.when(value.isNull(), F.lit(-1)).otherwise(position)


def _rows_above(df: DataFrame, buckets: dict[str, str], sizes: dict[str, int]) -> dict[str, list]:
    """For each range, how many rows are in higher ranges; index 0 is range -1.

    The driver receives one count per range, however large the table.
    """
    pairs = F.explode(
        F.array(*[F.struct(F.lit(r).alias("rank"), F.col(b).alias("bucket")) for r, b in buckets.items()])
    ).alias("pair")
    counts = df.select(pairs).groupBy("pair.rank", "pair.bucket").count().collect()
    above = {}
    for rank, size in sizes.items():
        held = {row["bucket"]: row["count"] for row in counts if row["rank"] == rank}
        running, offsets = 0, []
        for bucket in range(size - 1, -2, -1):
            offsets.append(running)
            running += held.get(bucket, 0)
        above[rank] = offsets[::-1]
    return above


def global_ranks(df: DataFrame, ranks: dict[str, str], ranges: int = RANGES) -> DataFrame:
    """Adds ``rank() over (order by value desc)`` columns, as name -> value column.

    The values are cut into ranges at their own quantiles; a row's rank is the
    number of rows in higher ranges plus its rank inside its range. Quantiles
    may be approximate: any cut gives the same ranks. Rows that share a value
    so frequent that it is a quantile all tie, so they are spread over many
    partitions instead of meeting in one. ``df`` should be a stored table: it
    is read twice here and once by the result.
    """
    bounds = _bounds(df, list(dict.fromkeys(ranks.values())), ranges)
    buckets = {rank: f"_{rank}_bucket" for rank in ranks}
    ranged = df.select(
        "*", *[_bucket(df, ranks[r], bounds[ranks[r]]).alias(b) for r, b in buckets.items()]
    )
    sizes = {rank: 2 * len(bounds[value]) + 1 for rank, value in ranks.items()}
    above = _rows_above(ranged, buckets, sizes)
    spread = F.pmod(F.xxhash64(*df.columns), F.lit(ranges))
    for rank, value in ranks.items():
        bucket = F.col(buckets[rank])
        tied = F.when(bucket % 2 != 0, spread).otherwise(0)
        inside = F.rank().over(Window.partitionBy(bucket, tied).orderBy(F.col(value).desc()))
        offset = F.get(_literal(above[rank], "bigint"), bucket + 1)
        ranged = ranged.withColumn(rank, (offset + inside).cast("bigint"))
    return ranged.drop(*buckets.values())


def top_with_ranks(df: DataFrame, ranks: dict[str, str], by: str, n: int, ties: list[str]) -> DataFrame:
    """The first ``n`` rows by the rank ``by``, with all their ranks over the whole of ``df``.

    Equal ranks are settled by the columns ``ties``. Only ``n`` rows reach the
    driver; their ranks are counted in one more pass, without ranking the
    other rows. ``df`` should be a stored table: it is read twice.
    """
    spark = df.sparkSession
    best = df.orderBy(F.col(ranks[by]).desc_nulls_last(), *[F.asc(t) for t in ties]).limit(n).collect()
    kinds = {rank: df.schema[value].dataType for rank, value in ranks.items()}

    def above(rank: str, row) -> Column:
        value, own = F.col(ranks[rank]), row[ranks[rank]]
        return F.count_if(value.isNotNull() if own is None else value > F.lit(own).cast(kinds[rank]))

    if not best:
        counts = []
    else:
        counts = df.agg(*[above(rank, row).alias(f"{rank}_{i}") for i, row in enumerate(best) for rank in ranks]).first()
    rows = [(*row, *[counts[f"{rank}_{i}"] + 1 for rank in ranks]) for i, row in enumerate(best)]
    kind = StructType([*df.schema.fields, *[StructField(rank, LongType()) for rank in ranks]])
    return spark.createDataFrame(rows, kind)
