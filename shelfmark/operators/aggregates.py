"""Counts, representatives, votes, duplicates, progress and health."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark import constants as C
from shelfmark.functions.paths import blank_to_null
from shelfmark.operators.lanes import numbered


def count_by(df: DataFrame, dims: Sequence[str], name: str = "rows") -> DataFrame:
    return df.groupBy(*dims).agg(F.count(F.lit(1)).alias(name)).orderBy(F.desc(name), *dims)


def distinct_names(df: DataFrame, column: str, approximate: bool = False) -> DataFrame:
    """Distinct non-empty names. Exact: distinct first, then a count, so no task holds the set."""
    name = blank_to_null(F.col(column).cast("string"))
    if approximate:
        return df.agg(F.approx_count_distinct(name).alias("names"))
    return df.select(name.alias("n")).filter(F.col("n").isNotNull()).distinct().agg(F.count(F.lit(1)).alias("names"))


def percent(part: Column, whole: Column) -> Column:
    """Whole percent, null without a base."""
    return F.floor(F.try_divide(part * 100, whole))


def representatives(df: DataFrame, key: str, order: Sequence[str], values: Sequence[str]) -> DataFrame:
    """First row in order and row count per key."""
    best = F.min_by(F.struct(*values), F.struct(*order))
    return df.groupBy(key).agg(best.alias("_r"), F.count(F.lit(1)).alias("rows")).select(key, "_r.*", "rows")


def duplicate_groups(df: DataFrame, keys: Sequence[str], key_id: str) -> DataFrame:
    """Groups of at least two rows; rows with a null key part never group."""
    return df.dropna(subset=list(keys)).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("copies"), F.min(key_id).alias("first_id")).filter(F.col("copies") >= 2)


def rejected_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return df.agg(F.count_if(missing).alias("rejected"), F.count(F.lit(1)).alias("rows"))


def all_older(df: DataFrame, key: str, ts: str, cutoff: Column) -> DataFrame:
    """Keys whose every member is at or before the cutoff; a missing time fails its group."""
    every = F.bool_and(F.coalesce(F.col(ts) <= cutoff, F.lit(False)))
    return df.groupBy(key).agg(every.alias("_all"), F.count(F.lit(1)).alias("members")).filter("_all").drop("_all")


def status_histogram(df: DataFrame, status: str, expected: Sequence[str], top: int | None = None) -> DataFrame:
    """Count per status: the expected ones zero-filled, unknown ones included; ``top`` keeps the most frequent."""
    spark = df.sparkSession
    want = spark.createDataFrame([(s,) for s in expected], "_want string")
    got = df.groupBy(status).agg(F.count(F.lit(1)).alias("n"))
    out = got.join(want, F.col(status) == F.col("_want"), "full").select(
        F.coalesce(status, "_want").alias(status), F.coalesce("n", F.lit(0)).alias("rows"))
    return out.orderBy(F.desc("rows"), status).limit(top) if top else out


def any_detection(df: DataFrame, key: str, readable: Column, score: Column, area_share: Column,
                  min_score: float = C.DETECTION_SCORE_MIN, min_area: float = C.DETECTION_AREA_MIN) -> DataFrame:
    """(key, verdict) over a detections table: 'no_frames' without a readable frame, else yes / no."""
    hit = F.bool_or(F.coalesce(readable & (score >= min_score) & (area_share >= min_area), F.lit(False)))
    out = df.groupBy(key).agg(F.count_if(readable).alias("_ok"), hit.alias("_hit"))
    return out.select(key, F.when(F.col("_ok") == 0, "no_frames").when(F.col("_hit"), "yes").otherwise("no").alias("verdict"))


def preferred_slot(df: DataFrame, keys: Sequence[str], ts: str, value: str, tie: str, hour: int = 6) -> DataFrame:
    """Value of the slot that starts at ``hour``, else of the first slot, and the minimum of all slots."""
    rank = F.struct((F.hour(ts) != hour).alias("o"), F.col(ts).alias("t"), F.col(tie).alias("i"))
    return df.groupBy(*keys).agg(F.min_by(value, rank).alias("chosen"), F.min(value).alias("lowest"))


def progress(df: DataFrame, processed: Column, hit: Column, daily_limit: int, min_sample: int = C.RATE_MIN_SAMPLE) -> DataFrame:
    """One row: processed, hits, remaining, hit_rate, days_left, expected_hits (from ``min_sample`` on, half to even)."""
    out = df.agg(F.count_if(processed).alias("processed"), F.count_if(processed & hit).alias("hits"),
                 F.count_if(~processed).alias("remaining"))
    rate = F.coalesce(F.try_divide(F.col("hits").cast("double"), F.col("processed")), F.lit(0.0))
    return out.withColumn("hit_rate", rate).withColumn(
        "days_left", F.ceil(F.col("remaining") / max(daily_limit, 1))).withColumn(
        "expected_hits", F.when(F.col("processed") >= min_sample, F.bround(F.col("remaining") * F.col("hit_rate"))))


def batches(df: DataFrame, key: str, size: int) -> DataFrame:
    """(batch, total, keys): numbered batches of at most ``size`` keys."""
    rows = numbered(df.select(key), [key])
    total = df.agg(F.ceil(F.count(F.lit(1)) / size)).scalar()
    at = (F.floor((F.col("rn") - 1) / size) + 1).alias("batch")
    return rows.groupBy(at).agg(F.sort_array(F.collect_list(key)).alias("keys")).select("batch", total.alias("total"), "keys")


def scorecard(metrics: DataFrame, rules: DataFrame) -> DataFrame:
    """(name, value, status) with status ok, warn or critical.

    ``metrics`` has (name, value), ``rules`` (name, warn, critical, inclusive, missing): a value
    above (``inclusive``: at or above) a threshold raises it, a null threshold never fires, and
    ``missing`` is the status of a check without a value.
    """
    def fires(limit: str) -> Column:
        v, t = F.col("value"), F.col(limit)
        return F.coalesce(F.when(F.col("inclusive"), v >= t).otherwise(v > t), F.lit(False))
    status = (F.when(F.col("value").isNull(), F.col("missing")).when(fires("critical"), "critical")
              .when(fires("warn"), "warn").otherwise("ok"))
    return rules.join(metrics, "name", "left").select("name", "value", status.alias("status"))


def overall(card: DataFrame) -> DataFrame:
    """The worst status."""
    rank = F.when(F.col("status") == "critical", 2).when(F.col("status") == "warn", 1).otherwise(0)
    worst = F.max(rank)
    return card.agg(F.when(worst == 2, "critical").when(worst == 1, "warn").otherwise("ok").alias("overall"),
                    F.count_if(F.col("status") != "ok").alias("failing"))
