"""Streams against their batch twins, with retries and several batches."""

import datetime as dt
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import rows
from shelfmark.functions import bloom
from shelfmark.operators import windows as W
from shelfmark.session import shared_path
from shelfmark.streaming import feeds as T
from shelfmark.streaming import stateful as S

SCHEMA = "id bigint, k bigint, ts timestamp, n boolean"
T0 = dt.datetime(2024, 1, 1)


@pytest.fixture
def feed(spark):
    path = shared_path(spark, "feed")

    def put(items):
        spark.createDataFrame(items, SCHEMA).coalesce(1).write.mode("append").parquet(path)
    return path, put


def item(i, k=0, h=0.0, n=True):
    return (i, k, None if h is None else T0 + dt.timedelta(hours=h), n)


def test_first_run_only_records(spark, feed):
    path, put = feed
    out, chk = shared_path(spark, "out"), shared_path(spark, "chk")
    put([item(1), item(2)])
    T.consume_feed(T.file_feed(spark, path, SCHEMA), T.batch_writer(out), chk, True)
    put([item(3)])
    T.consume_feed(T.file_feed(spark, path, SCHEMA), T.batch_writer(out), chk, False)
    T.consume_feed(T.file_feed(spark, path, SCHEMA), T.batch_writer(out), chk, False)      # nothing new
    assert rows(spark.read.schema(SCHEMA).parquet(out), "id") == [(3,)]


def test_failed_run_leaves_position(spark, feed):
    path, put = feed
    out, chk = shared_path(spark, "out"), shared_path(spark, "chk")
    put([item(1)])

    def broken(df, batch_id):
        df.write.parquet(f"{out}/batch_id={batch_id}")
        raise RuntimeError("lost after delivery")
    with pytest.raises(Exception):
        T.consume_feed(T.file_feed(spark, path, SCHEMA), broken, chk, False)
    T.consume_feed(T.file_feed(spark, path, SCHEMA), T.batch_writer(out), chk, False)
    assert rows(spark.read.schema(SCHEMA).parquet(out), "id") == [(1,)]        # delivered again, kept once


def test_dedup_over_batches(spark, feed):
    path, put = feed
    out, chk = shared_path(spark, "out"), shared_path(spark, "chk")
    put([item(1), item(1), item(2, h=1)])
    put([item(2, h=1), item(3, h=2)])
    T.drain(T.dedup(T.file_feed(spark, path, SCHEMA, 1), "id", "ts", "2 days"), T.batch_writer(out), chk)
    assert rows(spark.read.schema(SCHEMA).parquet(out), "id") == [(1,), (2,), (3,)]


def test_polling_delivers_each_id_once(spark, feed):
    path, put = feed
    out, chk, led = (shared_path(spark, x) for x in ("out", "chk", "led"))
    handler = T.deliver_once(T.Ledger(led, "id", "ts").create(spark), out)
    put([item(1), item(2), item(9, h=None)])
    put([item(2), item(3), item(3), item(9, h=None)])
    T.drain(T.file_feed(spark, path, SCHEMA, 1), handler, chk)
    assert rows(spark.read.schema(SCHEMA).parquet(out), "id") == [(1,), (2,), (3,), (9,)]
    handler(spark.createDataFrame([item(2), item(3)], SCHEMA), 1)          # the same batch again
    assert rows(spark.read.schema(SCHEMA).parquet(out), "id") == [(1,), (2,), (3,), (9,)]


def test_ledger_opens_no_old_days(spark):
    led = shared_path(spark, "led")
    ledger = T.Ledger(led, "id", "ts", horizon_days=3).create(spark)
    for i, day in enumerate((0, 20, 22)):
        ledger.add(spark.createDataFrame([item(i, h=24 * day), item(100 + i, h=24 * day)], SCHEMA), i)
    old = next(Path(led).glob("day=2024-01-01/batch_id=0/*.parquet"))
    old.write_bytes(b"not parquet")           # opening it would fail
    Path(old.parent, f".{old.name}.crc").unlink()
    batch = spark.createDataFrame([item(i, h=24 * 23) for i in (0, 1, 2, 5, 101)], SCHEMA)
    known = ledger.known(batch, 7)
    assert rows(known) == [(1,), (101,), (2,)]
    plan = known._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "day" in plan.split("PartitionFilters")[1].split("]")[0]
    assert rows(ledger.known(batch, 1)) == [(2,)]           # its own rows don't count
    assert rows(ledger.known(batch.limit(0), 7)) == []


def test_announced_ids_are_seen(spark):
    out, led = shared_path(spark, "out"), shared_path(spark, "led")

    def reason(seen):
        return F.when(F.col("k") == 1, "nofile").when(seen, "dup").when(F.col("n"), "old")
    handler = T.announce(T.Ledger(led, "id", "ts").create(spark), reason, out)
    first = [item(1, 0, 0, False), item(2, 1, 0, False), item(3, 0, 0, True)]
    second = first + [item(4, 0, 50, False), item(4, 0, 50, False)]
    for n, batch in ((0, first), (1, second), (1, second)):
        handler(spark.createDataFrame(batch, SCHEMA), n)
    got = rows(spark.read.schema("id bigint, reason string").parquet(out), "batch_id", "id", "reason")
    assert got == [(0, 1, None), (0, 2, "nofile"), (0, 3, "old"), (1, 1, "dup"), (1, 2, "nofile"), (1, 3, "old"), (1, 4, None)]


def test_bloom_filter_loses_no_key(spark):
    some = spark.range(0, 20000, 7)
    every = spark.range(20000).withColumn("hit", bloom.may_contain(bloom.build(some, "id", 18), F.col("id"), 18))
    found = {r["id"] for r in every.filter("hit").collect()}
    wanted = set(range(0, 20000, 7))
    assert wanted <= found and len(found - wanted) < 200
    assert spark.range(9).filter(bloom.may_contain(bloom.build(some.limit(0), "id"), F.col("id"))).count() == 0


def test_late_rows_by_batch_time(spark, feed):
    path, put = feed
    out, chk = shared_path(spark, "out"), shared_path(spark, "chk")
    put([item(1, h=0), item(2, h=4), item(3, h=10), item(4, h=None)])
    T.drain(T.file_feed(spark, path, SCHEMA), T.late_cutoff("ts", out, asof=F.lit(T0 + dt.timedelta(hours=10))), chk)
    assert rows(spark.read.schema(SCHEMA).parquet(out), "id") == [(2,), (3,), (4,)]


def streaks(spark, path, out, chk, **options):
    stream = S.null_streaks(T.file_feed(spark, path, SCHEMA), "k", "ts", "id", F.col("n"), **options)
    T.drain(stream, T.batch_writer(out), chk, "update", 2, S.STORE)
    found = spark.read.schema("k bigint, streak bigint, last_null timestamp, batch_id bigint").parquet(out)
    return rows(S.newest(found, ["k"]), "k", "streak", "last_null")


def test_streaks_equal_batch_whatever_the_order(spark, feed):
    path, put = feed
    out, chk = shared_path(spark, "out"), shared_path(spark, "chk")
    rng, seen = random.Random(4), []
    every = [item(i, rng.choice([1, 1, 1, 2, None]), rng.randrange(40), rng.random() < 0.8) for i in range(120)]
    for k in range(0, 120, 40):
        put(every[k:k + 40])
        seen += every[k:k + 40]
        got = streaks(spark, path, out, chk)
        want = W.null_streak(spark.createDataFrame(seen, SCHEMA), "k", ["ts", "id"], F.col("n"), "ts")
        assert got == rows(want, "k", "streak", "last_null")


def test_streak_state_writes_only_touched_keys_and_forgets(spark, feed):
    path, put = feed
    out, chk = shared_path(spark, "out"), shared_path(spark, "chk")
    put([item(1, 1, 1), item(2, 2, 1), item(3, 1, None)])
    assert [r[:2] for r in streaks(spark, path, out, chk, keep_days=2)] == [(1, 1), (2, 1)]
    put([item(4, 1, 48)])
    assert [r[:2] for r in streaks(spark, path, out, chk, keep_days=2)] == [(1, 2), (2, 1)]
    put([item(5, 3, 80)])            # two days after the row of key 2
    streaks(spark, path, out, chk, keep_days=2)
    put([item(6, 1, 81), item(7, 2, 81)])
    assert [r[:2] for r in streaks(spark, path, out, chk, keep_days=2)] == [(1, 3), (2, 1), (3, 1)]
    per_batch = spark.read.schema("k bigint, batch_id bigint").parquet(out).groupBy("batch_id").agg(F.sort_array(F.collect_set("k")).alias("k"))
    assert [r["k"] for r in per_batch.filter(F.size("k") > 0).orderBy("batch_id").collect()] == [[1, 2], [1], [3], [1, 2]]


class Store:
    """A state handle in memory that counts the calls to the store."""

    def __init__(self):
        self.calls, self.timers, self.found = 0, [], None

    def getValueState(self, name, schema):
        return self

    def get(self):
        self.calls += 1
        return self.found

    def update(self, value):
        self.calls += 1
        self.found = value

    def clear(self):
        self.calls += 1
        self.found = None

    def registerTimer(self, at):
        self.calls += 1
        self.timers.append(at)

    def getCurrentWatermarkInMs(self):
        return self.watermark


def test_late_rows_cost_store_calls_per_bucket_not_per_key(spark):
    store = Store()
    p = S.Lateness("id", "bigint")
    p.init(store)

    def batch(rows, watermark):
        store.watermark = watermark
        return sorted((r["id"], r["at"], r["verdict"]) for r in p.handleInputRows((0,), iter([{"id": i, "at": at} for i, at in rows]), store))
    assert batch([(i, i * 1000) for i in range(1000)], 0) == [(i, i * 1000, "kept") for i in range(1000)]
    assert store.calls <= 3 and store.timers == [1]
    assert batch([(1, 1000), (999, 999_500), (2000, 999_000), (2000, 999_001)], 500) == [
        (1, 1000, "late"), (999, 999_500, "duplicate"), (2000, 999_000, "kept"), (2000, 999_001, "duplicate")]
    store.watermark = 999
    list(p.handleExpiredTimer((0,), store, None))
    assert store.timers == [1, 1000] and store.found[1:] == ([999, 2000], [999_000, 999_000])
    store.watermark = 1000
    list(p.handleExpiredTimer((0,), store, None))
    assert store.found is None and store.calls <= 12


def test_late_and_duplicate_are_told_apart(spark, feed):
    path, put = feed
    out, chk = shared_path(spark, "out"), shared_path(spark, "chk")
    for batch in ([item(1, h=0)], [item(2, h=20), item(2, h=20), item(7, h=None)], [item(3, h=1), item(4, h=19), item(1, h=0), item(2, h=20)],
                  [item(5, h=60), item(4, h=19)], [item(4, h=19), item(6, h=None), item(8, h=54)]):
        put(batch)
        stream = S.late_or_duplicate(T.file_feed(spark, path, SCHEMA), "id", "ts", "6 hours")
        T.drain(stream, T.batch_writer(out), chk, "update", 2, S.STORE)
    got = rows(spark.read.schema("id bigint, verdict string").parquet(out), "id", "verdict")
    assert got == sorted([(1, "kept"), (2, "kept"), (2, "duplicate"), (7, "kept"), (3, "late"), (4, "kept"), (1, "late"), (2, "duplicate"),
                          (5, "kept"), (4, "duplicate"), (4, "late"), (6, "kept"), (8, "kept")], key=repr)


def test_skip_reasons_in_order(spark):
    t, f = F.lit(True), F.lit(False)
    now = F.lit(T0)
    old = F.lit(T0 - dt.timedelta(hours=6, seconds=1))
    edge = F.lit(T0 - dt.timedelta(hours=6))
    none = F.lit(None).cast("timestamp")
    got = spark.range(1).select(
        T.skip_reason(f, t, t, f, t, old, now, f).alias("a"), T.skip_reason(t, t, t, f, t, old, now, f).alias("b"),
        T.skip_reason(t, f, t, f, t, old, now, f).alias("c"), T.skip_reason(t, f, f, f, t, old, now, f).alias("d"),
        T.skip_reason(t, f, f, t, t, old, now, f).alias("e"), T.skip_reason(t, f, f, t, f, old, now, f).alias("g"),
        T.skip_reason(t, f, f, t, f, edge, now, f).alias("h"), T.skip_reason(t, f, f, t, f, none, now, t).alias("i")).first()
    assert tuple(got) == ("nofile", "trashed", "folder", "nonvideo", "dup", "old", "no-output", None)


def test_watch_polls_until_stopped(spark, feed):
    path, put = feed
    out, chk = shared_path(spark, "out"), shared_path(spark, "chk")
    put([item(1)])
    q = T.watch(T.file_feed(spark, path, SCHEMA), T.batch_writer(out), chk, every="1 second")
    try:
        q.processAllAvailable()
        put([item(2)])
        q.processAllAvailable()
    finally:
        q.stop()
    assert rows(spark.read.schema(SCHEMA).parquet(out), "id") == [(1,), (2,)]


def test_approval_stream_ttl(spark):
    req, act = shared_path(spark, "req"), shared_path(spark, "act")
    out, chk = shared_path(spark, "out"), shared_path(spark, "chk")
    day = dt.timedelta(days=1)
    spark.createDataFrame([("a", T0), ("b", T0), ("c", T0)], "token string, created_at timestamp").write.parquet(req)
    spark.createDataFrame([("a", "confirm", T0 + 7 * day), ("b", "confirm", T0 + 8 * day), ("c", "cancel", T0 - day), ("x", "confirm", T0)],
                          "action_token string, action string, at timestamp").write.parquet(act)
    j = T.pending_approvals(T.file_feed(spark, req, "token string, created_at timestamp"),
                            T.file_feed(spark, act, "action_token string, action string, at timestamp"))
    T.drain(j.select("token", "action"), T.batch_writer(out), chk, state_partitions=2)
    assert rows(spark.read.schema("token string, action string").parquet(out), "token", "action") == [("a", "confirm")]


def outcomes(spark, path, out, chk, **options):
    stream = T.file_feed(spark, path, "token string, ts timestamp, action string, seq bigint")
    T.drain(S.approval_outcomes(stream, "10 days", **options), T.batch_writer(out), chk, "update", 2, S.STORE)
    return rows(spark.read.schema("token string, action string, seq bigint, outcome string").parquet(out), "token", "seq", "outcome")


def test_approval_outcomes_wait_for_the_watermark(spark):
    path, out, chk = (shared_path(spark, x) for x in ("feed", "out", "chk"))

    def put(*items):
        spark.createDataFrame([(t, T0 + dt.timedelta(days=d), a, s) for t, d, a, s in items],
                              "token string, ts timestamp, action string, seq bigint").coalesce(1).write.mode("append").parquet(path)
    put(("a", 3, "confirm", 1), ("b", 9, "confirm", 2), ("c", 2, "cancel", 3), ("c", 3, "confirm", 4), ("x", 1, "confirm", 5), (None, 1, "confirm", 6))
    assert outcomes(spark, path, out, chk) == []          # a request may still come
    put(("a", 1, None, None), ("b", 1, None, None), ("c", 1, None, None), ("a", 0, "confirm", 7), ("a", 2, "cancel", 8), ("a", 0.5, None, None))
    assert outcomes(spark, path, out, chk) == []
    put((None, 40, None, None))
    want = [("a", 7, "no-pending"), ("a", 8, "cancelled"), ("a", 1, "no-pending"), ("b", 2, "expired"), ("c", 3, "cancelled"),
            ("c", 4, "no-pending"), ("x", 5, "unknown-token"), (None, 6, "unknown-token")]
    assert outcomes(spark, path, out, chk) == sorted(want, key=repr)
    put(("b", 35, "confirm", 9), ("d", 35, None, None), ("d", 36, "confirm", 10))
    put((None, 80, None, None))
    want += [("b", 9, "no-pending"), ("d", 10, "executed")]
    assert outcomes(spark, path, out, chk) == sorted(want, key=repr)


def test_approvals_cost_store_calls_per_bucket_not_per_token(spark):
    day, store = S.DAY_MICROS, Store()
    p = S.Approval(7 * day, 20 * day, "bigint")
    p.init(store)

    def batch(rows, watermark):
        store.watermark = watermark
        rows = [dict(zip(("token", "at", "action", "seq"), r)) for r in rows]
        return sorted((r["token"], r["seq"], r["outcome"]) for r in p.handleInputRows((0,), iter(rows), store))
    assert batch([(i, day, None, None) for i in range(500)] + [(i, 2 * day, "confirm", i) for i in range(1000)], 0) == []
    assert batch([(i, 3 * day, "cancel", 1000 + i) for i in range(1000)], 0) == []
    assert store.calls <= 6
    store.watermark = 10 * day // 1000
    got = sorted((r["token"], r["seq"], r["outcome"]) for r in p.handleExpiredTimer((0,), store, None))
    assert got == sorted([(i, i, "executed") for i in range(500)] + [(i, 1000 + i, "no-pending") for i in range(500)]
                         + [(i, n + i, "unknown-token") for i in range(500, 1000) for n in (0, 1000)])
    store.watermark = 22 * day // 1000
    assert list(p.handleExpiredTimer((0,), store, None)) == []
    assert store.found is None and store.calls <= 12


def test_a_token_is_forgotten(spark):
    path, out, chk = (shared_path(spark, x) for x in ("feed", "out", "chk"))
    for batch in ([("a", 0, None, None), ("a", 1, "confirm", 1)], [(None, 60, None, None)], [("a", 61, "confirm", 2)], [(None, 90, None, None)]):
        spark.createDataFrame([(t, T0 + dt.timedelta(days=d), a, s) for t, d, a, s in batch],
                              "token string, ts timestamp, action string, seq bigint").write.mode("append").parquet(path)
        got = outcomes(spark, path, out, chk, keep_days=20)
    assert got == [("a", 1, "executed"), ("a", 2, "unknown-token")]


def test_closed_days_come_once(spark, feed):
    path, put = feed
    out, chk = shared_path(spark, "out"), shared_path(spark, "chk")
    day = dt.date(2024, 1, 1)
    found = []
    for batch in ([item(1, 1, 1), item(2, 1, 2), item(3, 2, 3)], [item(4, 1, 30), item(5, 1, 49), item(6, 1, 20)], [item(7, 1, 3), item(8, 1, 100)],
                  [item(9, None, 101), item(10, 1, 200)]):
        put(batch)
        stream = S.closed_day_deltas(T.file_feed(spark, path, SCHEMA), "ts", ["k"], "1 hour")
        T.drain(stream, T.batch_writer(out), chk, "append", 2, S.STORE)
        found.append(rows(spark.read.schema("day date, k bigint, rows bigint, rows_delta bigint").parquet(out), "day", "k", "rows", "rows_delta"))
    one = dt.timedelta(days=1)
    closed = [(day, 1, 3, 0), (day, 2, 1, 0), (day + one, 1, 1, -2)]
    assert found[0] == [] and found[1] == found[2][:3] == closed
    assert found[3] == closed + [(day + 2 * one, 1, 1, 0), (day + 4 * one, 1, 1, 0), (day + 4 * one, None, 1, 0)]
