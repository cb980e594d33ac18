"""Top-k, pages, previews."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark import constants as C
from shelfmark.operators.lanes import range_bucket


def top_counts(df: DataFrame, column: str, n: int = 30) -> DataFrame:
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("rows"))
    return counts.orderBy(F.desc("rows"), column).limit(n)


def preview_with_remainder(df: DataFrame, order: Sequence[Column], n: int = 20) -> DataFrame:
    """The first ``n`` rows, each with the number of rows not shown."""
    more = df.agg(F.greatest(F.count(F.lit(1)) - n, F.lit(0))).scalar()
    return df.orderBy(*order).limit(n).withColumn("more", more)


def latest_named_period(df: DataFrame, title: str) -> DataFrame:
    """Latest of the titles 'YYYY年M月' / 'YYYY年'; a bare year ranks after all its months."""
    pat = C.PERIOD_TITLE
    y = F.regexp_extract(title, pat, 1).try_cast("int")
    m = F.coalesce(F.regexp_extract(title, pat, 2).try_cast("int"), F.lit(13))
    found = df.filter(F.col(title).rlike(pat)).withColumn("_y", y).withColumn("_m", m)
    return found.agg(F.max(F.struct("_y", "_m", title)).alias("p")).select(
        F.col(f"p.{title}").alias("title"), F.col("p._y").alias("year"), F.col("p._m").alias("month"))


def page_slice(df: DataFrame, order: Sequence[Column], offset: int, n: int, buckets: int | None = None) -> DataFrame:
    """One page and the exact total; ``order`` must be total.

    The rows are written once in range buckets. The counts of the buckets, one number each, tell which of them hold the page;
    only those are read again and numbered, so that no offset makes a task hold more than it does for the first page.
    """
    rows = range_bucket(df, order, buckets)
    sizes = sorted((r["_bucket"], r["count"]) for r in rows.groupBy("_bucket").count().collect())
    before, picked = 0, {}
    for bucket, size in sizes:
        if before < offset + n and before + size > offset:
            picked[bucket] = before
        before += size
    page = rows.filter(F.col("_bucket").isin(list(picked)) if picked else F.lit(False))
    base = F.coalesce(*[F.when(F.col("_bucket") == b, F.lit(k)) for b, k in picked.items()], F.lit(0))
    rn = F.row_number().over(Window.partitionBy("_bucket").orderBy(*order)) + base
    page = page.withColumn("_rn", rn).filter(F.col("_rn").between(offset + 1, offset + n))
    return page.orderBy("_rn").drop("_rn", "_bucket").withColumn("total", F.lit(before).cast("bigint"))


def recent_then_filter(df: DataFrame, order: Sequence[Column], n: int, keep: Column) -> DataFrame:
    """The filter runs on the latest ``n`` rows only."""
    return df.orderBy(*order).limit(n).filter(keep)
