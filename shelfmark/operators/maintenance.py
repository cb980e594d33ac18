"""Table maintenance: every operator returns the snapshot (or plan) to publish next."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.util import inheritable_thread_target

from shelfmark import constants as C
from shelfmark.functions.values import hours_between
from shelfmark.operators.lanes import attach_lookup, keep_ranked, numbered


def _one_per_key(df: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """The first row of each key in ``order``, else the one with the largest values; a null key is a key too."""
    return keep_ranked(df, [key], list(order) or [F.desc(c) for c in df.columns if c != key] or [F.lit(1)])


def upsert_merge(target: DataFrame, source: DataFrame, key: str, order: Sequence[Column] = ()) -> DataFrame:
    """Rows of ``source`` replace or join those of ``target``; columns it lacks keep their value.

    Of several source rows for a key the first in ``order`` counts, without one that with the largest values.
    """
    src = _one_per_key(source, key, order)
    src = src.select(*[F.col(c).alias(f"_s_{c}") for c in source.columns], F.lit(True).alias("_hit"))
    both = target.join(src, F.col(key) == F.col(f"_s_{key}"), "full")
    given = set(source.columns)
    return both.select(*[
        (F.when(F.col("_hit"), F.col(f"_s_{c}")).otherwise(F.col(c)) if c in given else F.col(c)).alias(c)
        for c in target.columns])


def partial_update(target: DataFrame, patch: DataFrame, key: str, order: Sequence[Column] = ()) -> DataFrame:
    """Columns of ``patch`` overwrite matching rows where they are not null; repeated keys as in ``upsert_merge``."""
    cols = [c for c in patch.columns if c != key]
    p = _one_per_key(patch, key, order).select(F.col(key).alias("_k"), *[F.col(c).alias(f"_p_{c}") for c in cols])
    out = target.join(p, F.col(key) == F.col("_k"), "left")
    return out.select(*[F.coalesce(f"_p_{c}", c).alias(c) if c in cols else F.col(c) for c in target.columns])


def partial_update_report(target: DataFrame, patch: DataFrame, key: str) -> DataFrame:
    """(asked, matched, status): an update that matches nothing is a failure."""
    known = target.select(F.col(key).alias("_k")).distinct()
    hits = patch.select(key).distinct().join(known, F.col(key) == F.col("_k"), "left")
    out = hits.agg(F.count(F.lit(1)).alias("asked"), F.count("_k").alias("matched"))
    return out.withColumn("status", F.when(F.col("matched") > 0, "ok").otherwise("failed"))


def grouped_bulk_update(changes: DataFrame, key: str, targets: Sequence[str],
                        size: int = C.BULK_UPDATE_CHUNK) -> DataFrame:
    """(targets.., chunk, keys): one update statement per chunk of at most ``size`` keys."""
    rows = numbered(changes.select(key, *targets).distinct(), [key], targets)
    chunk = F.floor((F.col("rn") - 1) / size).alias("chunk")
    return rows.groupBy(*targets, chunk).agg(F.sort_array(F.collect_list(key)).alias("keys"))


def delete_by_keys(target: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    return target.join(keys.select(*on), list(on), "left_anti")


def delete_by_prefix(target: DataFrame, path: str, prefix: str) -> DataFrame:
    return target.filter(~F.coalesce(F.col(path).startswith(prefix), F.lit(False)))


def prune_plan(stored: DataFrame, scanned: DataFrame, key: str, source: str,
               share: float = C.PRUNE_MAX_STALE_SHARE) -> DataFrame:
    """(source, scanned, stored, stale, action) for every source the scan returned."""
    seen = scanned.select(source, key).distinct().withColumn("_seen", F.lit(1))
    both = stored.select(source, key).distinct().withColumn("_stored", F.lit(1)).join(seen, [source, key], "full")
    per = both.groupBy(source).agg(
        F.count("_seen").alias("scanned"), F.count("_stored").alias("stored"),
        F.count_if(F.col("_seen").isNull()).alias("stale")).filter(F.col("scanned") > 0)
    action = (F.when(F.col("stale") == 0, "clean")
              .when(F.col("stale") > F.col("scanned") * share, "skip").otherwise("prune"))
    return per.withColumn("action", action)


def guarded_prune(stored: DataFrame, scanned: DataFrame, key: str, source: str,
                  share: float = C.PRUNE_MAX_STALE_SHARE) -> DataFrame:
    """``stored`` without the stale rows of the sources that ``prune_plan`` says to prune."""
    seen = scanned.select(F.col(source).alias("_s"), F.col(key).alias("_k"), F.lit(1).alias("_seen")).distinct()
    rows = stored.join(seen, (F.col(source) == F.col("_s")) & (F.col(key) == F.col("_k")), "left").drop("_s", "_k")
    plan = prune_plan(stored, scanned, key, source, share).select(F.col(source).alias("_s"), F.col("action").alias("_action"))
    rows = attach_lookup(rows, [source], [key], lambda k: k.join(plan, F.col(source) == F.col("_s")), ["_action"])
    gone = F.col("_seen").isNull() & F.col("_action").eqNullSafe("prune")
    return rows.filter(~gone).select(*stored.columns)


def full_refresh(df: DataFrame, path: str) -> DataFrame:
    """Replace the table at ``path`` by the rows of ``df`` and read it back."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def insert_ignore(target: DataFrame, batch: DataFrame, key: str, order: Sequence[Column],
                  generated: Sequence[str] = ()) -> DataFrame:
    """Add the rows whose key is new (first of equal keys); generated columns are never written."""
    fresh = keep_ranked(batch.drop(*generated), [key], order).join(target.select(key), key, "left_anti")
    return target.drop(*generated).unionByName(fresh, allowMissingColumns=True)


#: Times as the export writes them and the restore reads them, to the microsecond.
TIMES = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def export_table(df: DataFrame, keys: Sequence[str], path: str) -> int:
    """Gzipped JSON lines in order of the (unique) key columns: range partitions, sorted inside. Returns the rows written."""
    seen = Observation()
    ordered = df.repartitionByRange(*[F.col(k) for k in keys]).sortWithinPartitions(*keys)
    # above the exchange, so that the rows sampled for its ranges don't count
    ordered.observe(seen, F.count(F.lit(1)).alias("rows")).write.options(**TIMES, compression="gzip").json(path)
    return seen.get["rows"]


#: Tables exported or restored at once.
SIDE_BY_SIDE = 4


def _side_by_side(spark: SparkSession, names: Sequence[str], work: Callable[[str], tuple]) -> DataFrame:
    """(name, rows, file, error, message) of work(name) -> (rows, file) for each name, several at a time; failures are listed."""
    def one(name: str) -> tuple:
        try:
            return (name, *work(name), None, None)
        except Exception as e:      # every other table goes on
            return name, None, None, type(e).__name__, str(e)[:500]

    with ThreadPoolExecutor(SIDE_BY_SIDE) as pool:
        found = list(pool.map(inheritable_thread_target(spark)(one), names))
    return spark.createDataFrame(found, "name string, rows bigint, file string, error string, message string")


def export_all(spark: SparkSession, tables: dict[str, tuple[str, Sequence[str]]], root: str) -> DataFrame:
    """Export tables {name: (parquet path, key columns)} below ``root`` as JSON lines, each with its schema, and return the
    manifest (name, rows, file, error, message); a table that cannot be exported is listed with its error.

    Rows are counted while they are written; tables run side by side.
    """
    def work(name: str) -> tuple:
        path, keys = tables[name]
        df, out = spark.read.parquet(path), f"{root}/{name}"
        rows = export_table(df, keys, out)
        spark.createDataFrame([(df.schema.json(),)], "value string").coalesce(1).write.text(f"{root}-schemas/{name}")
        return rows, out
    return _side_by_side(spark, list(tables), work)


def restore_all(spark: SparkSession, root: str, tables: dict[str, Sequence[str]], target: str) -> DataFrame:
    """Restore exported tables {name: key columns} as Parquet below ``target``: (name, rows, file, error, message).

    Each export is read with the schema it carries and goes through ``insert_ignore`` into what the target has of the table, so that a
    drill that is repeated, or that continues a broken one, adds only what is missing; ``rows`` counts the table afterwards.
    """
    def work(name: str) -> tuple:
        kept = spark.read.text(f"{root}-schemas/{name}").first()["value"]
        schema = StructType.fromJson(json.loads(kept))
        batch = spark.read.schema(schema).options(**TIMES).json(f"{root}/{name}")
        keys, out, label = list(tables[name]), f"{target}/{name}", "_key"
        key = F.to_json(F.struct(*keys))
        try:
            old = spark.read.schema(schema).parquet(out)
            old.limit(1).count()
        except AnalysisException:       # nothing there yet
            old = spark.createDataFrame([], schema)
        whole = insert_ignore(old.withColumn(label, key), batch.withColumn(label, key), label, [F.asc(label)], [])
        seen, fresh = Observation(), f"{out}.new"
        whole.select(*schema.names).observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(fresh)
        spark.read.schema(schema).parquet(fresh).write.mode("overwrite").parquet(out)
        return seen.get["rows"], out
    return _side_by_side(spark, list(tables), work)


def restore_verify(counts: DataFrame, thresholds: DataFrame) -> DataFrame:
    """(name, expected, got, ok) per table; a missing table counts 0."""
    out = thresholds.join(counts, "name", "left").withColumn("got", F.coalesce("got", F.lit(0)))
    return out.select("name", "expected", "got", (F.col("got") >= F.col("expected")).alias("ok"))


def retention_split(df: DataFrame, ts: str, asof: Column, days: int, name: str | None = None,
                    prefix: str = "") -> DataFrame:
    """Adds ``pruned``: older than ``days`` and, when a prefix is given, of that name prefix."""
    old = hours_between(asof, F.col(ts)) > days * 24
    return df.withColumn("pruned", old & F.col(name).startswith(prefix) if name else old)


def journal_append(rows: DataFrame, run_id: str, path: str) -> None:
    """Append one run; its partition is replaced as a whole when the run is repeated."""
    (rows.withColumn("run_id", F.lit(run_id)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(path))


def ledger(journal: DataFrame, ok: Column) -> DataFrame:
    return journal.groupBy("run_id").agg(F.count(F.lit(1)).alias("records"), F.count_if(ok).alias("successes"))


def migrate_keys(state: DataFrame, key: str, value: str, seq: str, prefixes: Sequence[tuple[str, str]],
                 volumes: Sequence[str]) -> DataFrame:
    """(key, value, converted): absolute keys become 'volume:rel', later rows win on collision.

    New-style and unknown keys stay, so a second run changes nothing.
    """
    k = F.col(key)
    slashed = F.translate(k, "\\", "/")
    new = k
    for prefix, volume in reversed(list(prefixes)):
        new = F.when(slashed.startswith(prefix),
                     F.concat(F.lit(volume + ":"), F.substr(slashed, F.lit(len(prefix) + 1)))).otherwise(new)
    done = ~k.startswith("/") & k.contains(":") & F.substring_index(k, ":", 1).isin(list(volumes))
    rows = state.withColumn("_new", F.when(done, k).otherwise(new))
    best = rows.groupBy("_new").agg(
        F.max_by(value, seq).alias(value), F.count_if(F.col("_new") != k).alias("converted"))
    return best.select(F.col("_new").alias(key), value, "converted")
