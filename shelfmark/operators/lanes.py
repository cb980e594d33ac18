"""Skew-proof building blocks.

A group may hold a third of all rows, so nothing here lets one task see a whole group:

* ``attach_group``  - group values for every row, through (key, lane) partials
* ``numbered``      - row numbers per group or over a whole table, through range buckets
* ``running_sum``   - running totals in order, through the same buckets
* ``keep_ranked``   - best k rows per group; Spark cuts each map task to k rows per group first
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.session import stage

LANES = 4096
#: Lanes of a key ranked beyond FEW rows: a lane gets k rows per map task, the last step k rows per lane.
RANK_LANES = 64
FEW = 8
#: A bucket is read by one task.
ROWS_PER_BUCKET = 1_000_000

_PARTIAL = {
    "count": lambda c: F.count(c), "sum": F.sum, "min": F.min, "max": F.max,
    "all": F.bool_and, "any": F.bool_or,
}
_MERGE = {
    "count": F.sum, "sum": F.sum, "min": F.min, "max": F.max, "all": F.bool_and, "any": F.bool_or,
}


def lane(row_key: Sequence[str]) -> Column:
    """Deterministic spread of the rows of one group."""
    return F.pmod(F.xxhash64(*row_key), F.lit(LANES)).cast("int")


def attach_group(df: DataFrame, keys: Sequence[str], row_key: Sequence[str],
                 values: dict[str, tuple[str, Column]]) -> DataFrame:
    """Add aggregates of each group to all of its rows.

    ``values`` maps a new column to (count|sum|min|max|all|any, column). Rows meet only the
    totals of their own (key, lane), so a hot key is spread over LANES join keys while a small
    group costs no replication.
    """
    keys = list(keys)
    rows = df.withColumn("_lane", lane(row_key))
    lanes = rows.groupBy(*keys, "_lane").agg(*[_PARTIAL[k](c).alias(n) for n, (k, c) in values.items()])
    key = Window.partitionBy(*keys)     # at most LANES rows of a key meet here
    spread = lanes.select(*[F.col(k).alias(f"_i_{k}") for k in keys], F.col("_lane").alias("_t_lane"),
                          *[_MERGE[k](n).over(key).alias(n) for n, (k, _) in values.items()])
    return _join_lanes(rows, spread, keys)


def attach_lookup(df: DataFrame, keys: Sequence[str], row_key: Sequence[str], lookup, names: Sequence[str]) -> DataFrame:
    """Add the columns ``names`` that ``lookup`` works out once per distinct key tuple.

    ``lookup`` takes the distinct tuples and returns them with the new columns; tuples it drops
    get nulls. A tuple shared by a third of all rows travels in (key, lane) portions.
    """
    keys = list(keys)
    rows = df.withColumn("_lane", lane(row_key))
    lanes = rows.select(*keys, "_lane").distinct()
    return _spread(rows, lanes, keys, lookup(lanes.select(*keys).distinct()), list(names))


def _spread(rows: DataFrame, lanes: DataFrame, keys: list[str], values: DataFrame, names: list[str]) -> DataFrame:
    """rows + the values of their key, joined on (key, lane)."""
    ids = lanes.select(*[F.col(k).alias(f"_i_{k}") for k in keys], F.col("_lane").alias("_t_lane"))
    values = values.select(*[F.col(k).alias(f"_t_{k}") for k in keys], *names)
    on_key = reduce(lambda a, b: a & b, [F.col(f"_i_{k}").eqNullSafe(F.col(f"_t_{k}")) for k in keys])
    spread = ids.join(values, on_key, "left").select(*[f"_i_{k}" for k in keys], "_t_lane", *names)
    return _join_lanes(rows, spread, keys)


def _join_lanes(rows: DataFrame, spread: DataFrame, keys: list[str]) -> DataFrame:
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_i_{k}")) for k in keys])
    joined = rows.join(spread, on & (F.col("_lane") == F.col("_t_lane")))
    return joined.drop("_lane", "_t_lane", *[f"_i_{k}" for k in keys])


def keep_ranked(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int = 1,
                rank_col: str | None = None) -> DataFrame:
    """First ``k`` rows per key in ``order``, which must be total.

    row_number() <= k is planned with a group limit before the shuffle, so at most k rows per
    key and map task travel. Above a few rows that is still much for one task, so the rows of a
    key are ranked inside lanes first.
    """
    name = rank_col or "_rank"
    if k > FEW:
        inner = Window.partitionBy(*keys, "_lane").orderBy(*order)
        spread = F.pmod(F.xxhash64(*df.columns), F.lit(RANK_LANES)).cast("int")
        df = df.withColumn("_lane", spread).withColumn("_pre", F.row_number().over(inner))
        df = df.filter(F.col("_pre") <= k).drop("_lane", "_pre")
    out = df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    out = out.filter(F.col(name) <= k)
    return out if rank_col else out.drop(name)


def range_bucket(df: DataFrame, order: Sequence[str | Column], buckets: int | None = None,
                 name: str = "_bucket") -> DataFrame:
    """The rows with a bucket number that grows with the order: names of columns (nulls first), or sort expressions.

    The rows are range-partitioned and written once with the number of their partition, so every branch and every
    retry reads the same buckets. Without ``buckets`` there is one per ROWS_PER_BUCKET rows, however many that makes:
    the rows are written first, so that ``df`` is computed once, and counted from the file footers.
    """
    if buckets is None:
        df = stage(df.withColumn(name, F.lit(0)), "rows")
        buckets = -(-df.count() // ROWS_PER_BUCKET)
        if buckets <= 1:
            return df
    ranged = df.repartitionByRange(buckets, *[F.col(c).asc() if isinstance(c, str) else c for c in order])
    return stage(ranged.withColumn(name, F.spark_partition_id()), "buckets")


def running_sum(df: DataFrame, parts: Sequence[str], order: Sequence[str],
                sums: dict[str, Column], buckets: int | None = None) -> DataFrame:
    """Inclusive running sums in ``order`` within ``parts`` (may be empty = the whole table).

    Buckets follow (parts, order): a small part lies in one bucket, a hot one is cut into many. A
    ``_bucket`` column that grows with the order inside each part is used and kept.
    """
    parts = list(parts)
    given = "_bucket" in df.columns
    rows = df if given else range_bucket(df, [*parts, *order], buckets)
    for i, (n, c) in enumerate(sums.items()):
        rows = rows.withColumn(f"_v{i}", c)
    local = Window.partitionBy(*parts, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*parts).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    # one row per (part, bucket): about a millionth of the rows share a window partition here
    heads = rows.groupBy(*parts, "_bucket").agg(*[F.sum(f"_v{i}").alias(f"_s{i}") for i in range(len(sums))])
    heads = heads.select(
        *[F.col(p).alias(f"_h_{p}") for p in parts], F.col("_bucket").alias("_h_bucket"),
        *[F.coalesce(F.sum(f"_s{i}").over(before), F.lit(0)).alias(f"_b{i}") for i in range(len(sums))])
    on = reduce(lambda a, b: a & b, [F.col(p).eqNullSafe(F.col(f"_h_{p}")) for p in parts],
                F.col("_bucket") == F.col("_h_bucket"))
    out = rows.join(heads, on)
    for i, n in enumerate(sums):
        out = out.withColumn(n, F.sum(f"_v{i}").over(local) + F.col(f"_b{i}"))
    out = out.drop("_h_bucket", *[f"_h_{p}" for p in parts], *[f"_{x}{i}" for i in range(len(sums)) for x in "vb"])
    return out if given else out.drop("_bucket")


def numbered(df: DataFrame, order: Sequence[str], parts: Sequence[str] = (), name: str = "rn",
             buckets: int | None = None) -> DataFrame:
    """1-based row numbers without a single-task sort; ``order`` must be total and non-null."""
    return running_sum(df, parts, order, {name: F.lit(1).cast("long")}, buckets)


def lagged(df: DataFrame, order: Sequence[str], value: str, name: str, parts: Sequence[str] = (),
           buckets: int | None = None) -> DataFrame:
    """Previous row's value in order; bucket heads take the last value of the bucket before."""
    parts = list(parts)
    given = "_bucket" in df.columns
    rows = df if given else range_bucket(df, [*parts, *order], buckets)
    key = F.struct(*order)
    ends = rows.groupBy(*parts, "_bucket").agg(F.max_by(F.struct(F.col(value).alias("v")), key).alias("_last"))
    prev = Window.partitionBy(*parts).orderBy("_bucket")
    ends = ends.select(*[F.col(p).alias(f"_h_{p}") for p in parts], F.col("_bucket").alias("_h_bucket"),
                       F.lag("_last").over(prev).alias("_carry"))
    on = reduce(lambda a, b: a & b, [F.col(p).eqNullSafe(F.col(f"_h_{p}")) for p in parts],
                F.col("_bucket") == F.col("_h_bucket"))
    local = Window.partitionBy(*parts, "_bucket").orderBy(*order)
    out = rows.join(ends, on)
    out = out.withColumn(name, F.when(F.row_number().over(local) == 1, F.col("_carry.v"))
                         .otherwise(F.lag(value).over(local)))
    out = out.drop("_h_bucket", "_carry", *[f"_h_{p}" for p in parts])
    return out if given else out.drop("_bucket")
