"""Versions, keepers, streaks, deltas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark import constants as C
from shelfmark.operators.lanes import attach_group, keep_ranked


def latest_version_flag(df: DataFrame, group: Sequence[str], version: str, seq: str, in_scope: Column,
                        is_old: str = "is_old") -> DataFrame:
    """Flags every row but the highest version of its group; equal versions keep the first in ``seq``.

    Rows out of scope and rows already flagged stay as they are; ``newly_marked`` tells flips.
    """
    best = F.struct(F.col(version).alias("v"), (-F.col(seq)).alias("s"))
    scope = F.coalesce(in_scope, F.lit(False))
    old = F.coalesce(F.col(is_old), F.lit(False))
    ranked = attach_group(df.filter(scope), group, [seq], {"_best": ("max", best)})
    lost = best < F.col("_best")
    ranked = ranked.withColumn("newly_marked", lost & ~old).withColumn(is_old, old | lost).drop("_best")
    rest = df.filter(~scope).withColumn("newly_marked", F.lit(False)).withColumn(is_old, old)   # never shuffled
    return ranked.unionByName(rest)


def keeper_plan(df: DataFrame, group: Sequence[str], key: str, mtime: str, usable: Column, content: str,
                canonical: str) -> DataFrame:
    """Adds ``plan`` to the members of duplicate groups: keeper (newest usable), row-only (same
    physical file), move (same content), hash-mismatch, no-keeper; single rows get 'single'.
    """
    age = F.coalesce(-F.unix_micros(F.col(mtime).cast("timestamp")), F.lit((1 << 63) - 1))     # without a time: last
    cand = F.when(usable, F.struct(age.alias("age"), F.col(key).alias("id"), F.col(content).alias("hash"),
                                   F.col(canonical).alias("canon")))
    rows = attach_group(df, group, [key], {"_keep": ("min", cand), "copies": ("count", F.lit(1))})
    plan = (F.when(F.col("copies") < 2, "single").when(F.col("_keep").isNull(), "no-keeper")
            .when(F.col(key) == F.col("_keep.id"), "keeper").when(F.col(canonical) == F.col("_keep.canon"), "row-only")
            .when(F.col(content) == F.col("_keep.hash"), "move").otherwise("hash-mismatch"))
    return rows.withColumn("keeper", F.col("_keep.id")).withColumn("plan", plan).drop("_keep")


def dedupe_summary(plan: DataFrame, size: str) -> DataFrame:
    """One row: groups, moves, row-only removals, bytes freed, skips by reason."""
    n = lambda p: F.count_if(F.col("plan") == p)
    groups = F.count_if((F.col("plan") == "keeper"))
    return plan.agg(groups.alias("groups"), n("move").alias("moves"), n("row-only").alias("row_only"),
                    F.coalesce(F.sum(F.when(F.col("plan") == "move", F.col(size))), F.lit(0)).alias("bytes_freed"),
                    n("hash-mismatch").alias("hash_mismatch"), n("no-keeper").alias("no_keeper_rows"))


def dedupe_first(df: DataFrame, keys: Sequence[str], seq: Sequence[str]) -> DataFrame:
    return keep_ranked(df, keys, [F.asc(c) for c in seq])


def dedupe_last(df: DataFrame, keys: Sequence[str], seq: Sequence[str]) -> DataFrame:
    return keep_ranked(df, keys, [F.desc(c) for c in seq])


def run_delta(metrics: DataFrame, parts: Sequence[str], day: str, values: Sequence[str]) -> DataFrame:
    """Each value minus its previous snapshot (0 without one); rows whose deltas are all 0 are left out.

    One row per part and day comes in: a part has as many rows as there are days.
    """
    w = Window.partitionBy(*parts).orderBy(day)
    out = metrics
    for v in values:
        out = out.withColumn(f"{v}_delta", F.col(v) - F.coalesce(F.lag(v).over(w), F.col(v)))
    changed = F.lit(False)
    for v in values:
        changed = changed | (F.col(f"{v}_delta") != 0)
    return out.filter(changed)


def null_streak(df: DataFrame, key: str, order: Sequence[str], is_null: Column, ts: str,
                limit: int = C.NULL_STREAK_LIMIT, asof_day: Column | None = None) -> DataFrame:
    """(key, streak, last_null, permanent, newly_permanent): null outcomes since the last hit.

    Two combinable aggregates, the last hit of the key and the nulls after it, replace an ordered
    pass over the key.
    """
    at = F.struct(*order)
    rows = df.withColumn("_null", is_null)
    rows = attach_group(rows, [key], [key, *order], {"_hit": ("max", F.when(~F.col("_null"), at))})
    live = F.col("_null") & (F.col("_hit").isNull() | (at > F.col("_hit")))
    out = rows.groupBy(key).agg(F.count_if(live).alias("streak"), F.max(F.when(live, F.col(ts))).alias("last_null"))
    out = out.withColumn("permanent", F.col("streak") >= limit)
    if asof_day is not None:
        fresh = (F.col("streak") == limit) & (F.to_date("last_null") == asof_day)
        out = out.withColumn("newly_permanent", F.coalesce(fresh, F.lit(False)))
    return out


def order_kind(df: DataFrame, folder: Sequence[str], key: str, archived: Column) -> DataFrame:
    """'complete' for the only live file of a folder without archived versions, else 'revised'; live files only."""
    rows = attach_group(df.withColumn("_old", archived), folder, [key], {
        "_live": ("count", F.when(~F.col("_old"), F.lit(1))), "_any": ("any", F.col("_old"))})
    kind = F.when((F.col("_live") == 1) & ~F.col("_any"), "complete").otherwise("revised")
    return rows.filter(~F.col("_old")).withColumn("kind", kind).drop("_old", "_live", "_any")
