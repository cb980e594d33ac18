"""Filters and work lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark import constants as C
from shelfmark.functions.names import has_place_suffix
from shelfmark.functions.paths import blank_to_null, segment
from shelfmark.functions.values import hours_between


def contains_any(text: Column, words: Sequence[str]) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | text.contains(w)
    return out


def lacks(tags: Column, value: str) -> Column:
    """NOT (tags contains value) with SQL nulls: a null array drops the row."""
    return ~F.array_contains(tags, value)


def conditional_path_exclude(path: Column, first_contains: str, second: str) -> Column:
    """True for paths to keep: only X*/second is excluded, shorter paths stay."""
    hit = segment(path, 0).contains(first_contains) & (segment(path, 1) == second)
    return ~F.coalesce(hit, F.lit(False))


def catalog_row(df: DataFrame, **given: Column) -> DataFrame:
    """Typed catalog rows from a raw scan; missing text is '', size 0, flag false, source 'drive'."""
    text = ["channel_name", "case_name", "subpath", "filename"]
    col = lambda n, kind="string": given.get(n, F.lit(None).cast(kind))
    source = F.coalesce(blank_to_null(col("source")), F.lit("drive"))
    return df.select(
        col("drive_file_id").alias("drive_file_id"), col("rel_path").alias("rel_path"),
        *[F.coalesce(col(t), F.lit("")).alias(t) for t in text],
        F.coalesce(col("size_bytes", "bigint").cast("bigint"), F.lit(0)).alias("size_bytes"), source.alias("source"),
        F.when(source == "nas", col("nas_path")).alias("nas_share_url"), col("category").alias("category"),
        F.coalesce(col("is_old", "boolean"), F.lit(False)).alias("is_old"))


def untagged_worklist(df: DataFrame, source: str, skip_tag: str, host_tag: str, script_class: str,
                      scope: str | None = None, limit: int | None = None) -> DataFrame:
    """Rows still without a place, in path order; the limit applies after every filter.

    Uses source, city, tags, filename and rel_path. A null tag list drops out (SQL NOT contains).
    """
    out = df.filter((F.col("source") == source) & F.col("city").isNull() & lacks(F.col("tags"), skip_tag)
                    & lacks(F.col("tags"), host_tag) & ~has_place_suffix(F.col("filename"), script_class))
    if scope:
        out = out.filter(F.col("rel_path").startswith(scope.rstrip("/") + "/"))
    out = out.orderBy("rel_path")
    return out.limit(limit) if limit else out


def pending_triage(df: DataFrame, key: str, done: DataFrame, stem: Column, context: Column, tagged: str, rule: str,
                   priority: str) -> DataFrame:
    """Adds ``status`` (done / pre-tagged / rule-skip / pending) and ``priority`` (0 first)."""
    known = done.select(F.col(key).alias("_k")).distinct()
    status = (F.when(F.col("_k").isNotNull(), "done").when(stem.rlike(tagged), "pre-tagged")
              .when(context.rlike(rule), "rule-skip").otherwise("pending"))
    return df.join(known, F.col(key) == F.col("_k"), "left").withColumn("status", status).withColumn(
        "priority", F.when(context.rlike(priority), 0).otherwise(1)).drop("_k")


def triage_worklist(triaged: DataFrame, path: str, cap: int) -> DataFrame:
    """Pending rows, high priority first, up to the daily cap."""
    return triaged.filter(F.col("status") == "pending").orderBy("priority", path).limit(cap)


def shard_of(key: Column, shards: int) -> Column:
    return (F.crc32(key.cast("string")) % shards).cast("int")


def needs_transcode(codec: Column, path: Column, source: Column, codecs: Sequence[str], wanted_source: str) -> Column:
    return codec.isin(list(codecs)) & path.isNotNull() & (source == wanted_source)


def needs_probe(codec: Column, ext: Column, extensions: Sequence[str], unknown: str = "UNKNOWN") -> Column:
    hit = F.lit(False)
    for e in extensions:
        hit = hit | ext.ilike(e)
    return (codec.isNull() | (codec == unknown)) & hit


def date_window(day: Column, asof: Column, days: int = 6) -> Column:
    return day.between(asof, F.date_add(asof, days))


def recent_or_unknown(ts: Column, asof: Column, hours: float = C.NEW_ITEM_HOURS) -> Column:
    """Not older than ``hours``; a missing time is kept."""
    return ts.isNull() | (hours_between(asof, ts) <= hours)
