"""Change feeds as Structured Streaming jobs.

Batches are published below ``<path>/batch_id=<n>`` and replaced when a batch is retried, so an
output holds every batch once. Checkpoints and outputs live in the shared folder.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shelfmark import constants as C
from shelfmark.functions import bloom
from shelfmark.functions.paths import extension
from shelfmark.operators.predicates import recent_or_unknown

Handler = Callable[[DataFrame, int], None]


def file_feed(spark: SparkSession, path: str, schema: str, files_per_batch: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def batch_writer(path: str) -> Handler:
    """A foreachBatch sink that can be repeated."""
    def write(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    return write


def _start(stream: DataFrame, handler: Handler, checkpoint: str, mode: str = "append",
           every: str | None = None) -> StreamingQuery:
    out = stream.writeStream.foreachBatch(handler).outputMode(mode).option("checkpointLocation", checkpoint)
    return (out.trigger(processingTime=every) if every else out.trigger(availableNow=True)).start()


def drain(stream: DataFrame, handler: Handler, checkpoint: str, mode: str = "append",
          state_partitions: int | None = None, settings: dict[str, str] | None = None) -> None:
    """Process everything that is there now and stop; the checkpoint is the resume token.

    ``state_partitions`` sizes the state store; it is fixed by the first run of a checkpoint. ``settings`` hold while the
    query starts, as ``stateful.STORE`` for keyed state.
    """
    conf = stream.sparkSession.conf
    wanted = dict(settings or {}) | ({"spark.sql.shuffle.partitions": str(state_partitions)} if state_partitions else {})
    before = {name: conf.get(name, None) for name in wanted}
    try:
        for name, value in wanted.items():
            conf.set(name, value)
        _start(stream, handler, checkpoint, mode).awaitTermination()
    finally:
        for name, value in before.items():
            if value is None:
                conf.unset(name)
            else:
                conf.set(name, value)


def watch(stream: DataFrame, handler: Handler, checkpoint: str, every: str = "600 seconds") -> StreamingQuery:
    """The polling form of ``drain``: a batch every ``every``."""
    return _start(stream, handler, checkpoint, every=every)


def consume_feed(stream: DataFrame, handler: Handler, checkpoint: str, first_run: bool) -> None:
    """First run: record the position and hand nothing over. Later runs: hand over what is new.

    A failing handler ends the run with the position unchanged.
    """
    drain(stream, (lambda df, batch_id: None) if first_run else handler, checkpoint)


def dedup(stream: DataFrame, key: str, ts: str, horizon: str) -> DataFrame:
    """Each id once within the horizon; the state is partitioned by id and bounded by the watermark."""
    return stream.withWatermark(ts, horizon).dropDuplicatesWithinWatermark([key])


@dataclass(frozen=True)
class Ledger:
    """Keys delivered so far, in folders ``day=<event day>/batch_id=<n>`` below ``path``.

    A batch opens the days of its own rows and the ``horizon_days`` before them, so its cost doesn't grow with the age of
    the ledger; what a key's earlier delivery dated further back is not known to it any more. A retried batch replaces
    its own folders.
    """

    path: str
    key: str
    ts: str
    horizon_days: int = 31

    def create(self, spark: SparkSession) -> "Ledger":
        spark.createDataFrame([], f"{self.key} bigint").write.mode("append").parquet(self.path)
        return self

    def known(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """The keys of the batch that other batches have delivered, each once.

        The days are pruned by the batch's, the keys by a Bloom filter of the batch's before anything is shuffled.
        """
        day = F.to_date(self.ts)
        lo, hi = batch.agg(F.date_sub(F.min(day), self.horizon_days), F.max(day)).first()
        spark = batch.sparkSession
        seen = spark.read.schema(f"{self.key} bigint, day date, batch_id bigint").parquet(self.path)
        window = F.col("day").isNull()
        if lo is not None:
            window = window | F.col("day").between(F.lit(lo), F.lit(hi))
        seen = seen.filter(window & (F.col("batch_id") != batch_id))
        seen = seen.filter(bloom.may_contain(bloom.build(batch, self.key), F.col(self.key)))
        return seen.join(batch.select(self.key), self.key, "left_semi").select(self.key).distinct()

    def add(self, rows: DataFrame, batch_id: int) -> None:
        out = rows.select(F.col(self.key).cast("bigint"), F.to_date(self.ts).alias("day"), F.lit(batch_id).cast("bigint").alias("batch_id"))
        (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day", "batch_id").parquet(self.path))


def _held(handle: Handler) -> Handler:
    """The batch is read once and kept while it is handled."""
    def run(df: DataFrame, batch_id: int) -> None:
        held = df.persist()
        try:
            handle(held, batch_id)
        finally:
            held.unpersist()
    return run


def deliver_once(ledger: Ledger, path: str) -> Handler:
    """Pending = the batch without the keys delivered by other batches. Keys count as seen after delivery."""
    def deliver(df: DataFrame, batch_id: int) -> None:
        todo = df.dropDuplicates([ledger.key]).join(ledger.known(df, batch_id), ledger.key, "left_anti")
        todo.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        ledger.add(df.sparkSession.read.schema(df.schema).parquet(f"{path}/batch_id={batch_id}"), batch_id)
    return _held(deliver)


def announce(ledger: Ledger, reason: Callable[[Column], Column], path: str) -> Handler:
    """Every key of a batch with the reason it is skipped, null where it is announced; announced keys go to the ledger.

    ``reason`` gets the condition that another batch has announced the key; a key that repeats in a batch counts once.
    """
    def handle(df: DataFrame, batch_id: int) -> None:
        known = ledger.known(df, batch_id).withColumn("_seen", F.lit(True))
        rows = df.dropDuplicates([ledger.key]).join(known, ledger.key, "left")
        rows = rows.withColumn("reason", reason(F.col("_seen").isNotNull())).drop("_seen")
        rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        done = df.sparkSession.read.schema(rows.schema).parquet(f"{path}/batch_id={batch_id}")
        ledger.add(done.filter(F.col("reason").isNull()), batch_id)
    return _held(handle)


def skip_reason(has_file: Column, trashed: Column, folder: Column, wanted_type: Column, seen: Column, created: Column,
                asof: Column, in_output: Column, hours: float = C.NEW_ITEM_HOURS) -> Column:
    """Why a change is not announced, null when it is; first reason wins."""
    return (F.when(~has_file, "nofile").when(trashed, "trashed").when(folder, "folder").when(~wanted_type, "nonvideo")
            .when(seen, "dup").when(~recent_or_unknown(created, asof, hours), "old").when(~in_output, "no-output"))


def change_feed(ledger: Ledger, folders: DataFrame, output_name: str, wanted: Sequence[str], path: str, asof: Column | None = None,
                hours: float = C.NEW_ITEM_HOURS) -> Handler:
    """The whole handler of a change feed: why each change is skipped, and for the announced ones case and kind.

    Changes are (key, ts, name, parent, trashed, is_folder); one whose folder is not called ``output_name`` (a row of
    ``folders``) is no output, the folder above names its case, and it is complete as the only live file of its folder in the
    batch, else revised. The ledger keeps what was announced. One write per batch, besides the ledger's.
    """
    def handle(df: DataFrame, batch_id: int) -> None:
        key = ledger.key
        known = ledger.known(df, batch_id).select(F.col(key).alias("_seen"))
        rows = df.dropDuplicates([key]).join(known, F.col(key) == F.col("_seen"), "left")
        out = folders.filter(F.col("name") == output_name).select(F.col("folder_id").alias("_out"), F.col("parent_id").alias("_case"))
        named = folders.select(F.col("folder_id").alias("_case"), F.col("name").alias("case_name"))
        rows = rows.join(out.join(named, "_case", "left"), F.col("parent") == F.col("_out"), "left")
        reason = skip_reason(F.col("name").isNotNull(), F.col("trashed"), F.col("is_folder"), extension(F.col("name")).isin(list(wanted)),
                             F.col("_seen").isNotNull(), F.col(ledger.ts), asof if asof is not None else F.current_timestamp(),
                             F.col("_out").isNotNull(), hours)
        rows = rows.withColumn("reason", reason).drop("_seen", "_out", "_case")
        live = rows.filter(F.col("reason").isNull()).groupBy(F.col("parent").alias("_p")).agg(F.count(F.lit(1)).alias("_live"))
        rows = rows.join(live, F.col("parent") == F.col("_p"), "left").withColumn(
            "kind", F.when(F.col("reason").isNull(), F.when(F.col("_live") == 1, "complete").otherwise("revised"))).drop("_p", "_live")
        rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        done = df.sparkSession.read.schema(rows.schema).parquet(f"{path}/batch_id={batch_id}")
        ledger.add(done.filter(F.col("reason").isNull()), batch_id)
    return _held(handle)


def late_cutoff(ts: str, path: str, hours: float = C.NEW_ITEM_HOURS, asof: Column | None = None) -> Handler:
    """Drop what is older than ``hours`` when its batch is processed (unreadable times stay)."""
    keep = batch_writer(path)

    def handle(df: DataFrame, batch_id: int) -> None:
        keep(df.filter(recent_or_unknown(F.col(ts), asof if asof is not None else F.current_timestamp(), hours)), batch_id)
    return handle


def pending_approvals(requests: DataFrame, actions: DataFrame, ttl_days: int = C.APPROVAL_TTL_DAYS,
                      horizon: str = "31 days") -> DataFrame:
    """Stream-stream join of requests (token, created_at) and actions (action_token, action, at) within the TTL."""
    r = requests.withWatermark("created_at", horizon)
    a = actions.withWatermark("at", horizon)
    on = ((F.col("token") == F.col("action_token")) & (F.col("at") >= F.col("created_at"))
          & (F.col("at") <= F.col("created_at") + F.expr(f"interval {ttl_days} days")))
    return r.join(a, on)
