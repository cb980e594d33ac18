import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from shelfmark.operators import aggregates as A
from shelfmark.operators import maintenance as M
from shelfmark.session import shared_path
from shelfmark.sources import journals, snapshots, tables


def keyed(spark, data, cols="k int, v string, w string"):
    return spark.createDataFrame(data, cols)


def test_upsert_keeps_absent_columns_and_is_idempotent(spark):
    t = keyed(spark, [(1, "a", "x"), (2, "b", "y")])
    s = keyed(spark, [(2, None), (3, "c")], "k int, v string")
    once = M.upsert_merge(t, s, "k")
    assert rows(once) == [(1, "a", "x"), (2, None, "y"), (3, "c", None)]
    assert rows(M.upsert_merge(once, s, "k")) == rows(once)


def test_partial_update_and_report(spark):
    t = keyed(spark, [(1, "a", "x"), (2, "b", "y")])
    p = keyed(spark, [(2, "B", None), (9, "z", "z")])
    assert rows(M.partial_update(t, p, "k")) == [(1, "a", "x"), (2, "B", "y")]
    assert rows(M.partial_update_report(t, p, "k")) == [(2, 1, "ok")]
    assert rows(M.partial_update_report(t, p.filter("k = 9"), "k")) == [(1, 0, "failed")]


def test_repeated_source_keys_give_one_row(spark):
    t = keyed(spark, [(1, "a", "x"), (2, "b", "y")])
    s = keyed(spark, [(2, "c", 1), (2, "d", 2), (3, "e", 2), (3, "f", 1)], "k int, v string, seq int")
    assert rows(M.upsert_merge(t, s, "k", [F.desc("seq")]), "k", "v") == [(1, "a"), (2, "d"), (3, "e")]
    assert rows(M.upsert_merge(t, s.drop("seq"), "k"), "k", "v") == [(1, "a"), (2, "d"), (3, "f")]
    assert rows(M.partial_update(t, s.drop("seq"), "k", [F.asc("v")])) == [(1, "a", "x"), (2, "c", "y")]


def test_prune_counts_keys_not_rows(spark):
    stored, scanned = sources(spark, {"s": [1, 2, 3, 3, 3]}, {"s": [1, 2]})       # 1 stale key in 3 rows
    assert [(r.stale, r.action) for r in M.prune_plan(stored, scanned, "k", "src").collect()] == [(1, "prune")]
    assert rows(M.guarded_prune(stored, scanned, "k", "src"), "k") == [(1,), (2,)]


def test_insert_ignore_twice_changes_nothing(spark):
    t = keyed(spark, [(1, "a")], "k int, v string")
    b = keyed(spark, [(1, "z", "n", 1), (2, "b", "n", 1), (2, "c", "n", 2)], "k int, v string, note string, seq int")
    once = M.insert_ignore(t, b, "k", [F.asc("seq")], ["note"])
    assert rows(once, "k", "v") == [(1, "a"), (2, "b")] and "note" not in once.columns
    assert rows(M.insert_ignore(once, b, "k", [F.asc("seq")], ["note"])) == rows(once)


def sources(spark, stored, scanned):
    f = lambda ks: spark.createDataFrame([(s, k) for s, ks_ in ks.items() for k in ks_], "src string, k int")
    return f(stored), f(scanned)


def test_prune_guard_edges(spark):
    # half: stale 2 of 4 scanned; over: stale 3 of 5; absent from the scan; clean
    stored, scanned = sources(spark, {"half": range(6), "over": range(8), "absent": range(3), "clean": range(2)},
                              {"half": range(4), "over": range(5), "clean": range(5)})
    plan = {r.src: (r.scanned, r.stored, r.stale, r.action) for r in M.prune_plan(stored, scanned, "k", "src").collect()}
    assert plan == {"half": (4, 6, 2, "prune"), "over": (5, 8, 3, "skip"), "clean": (5, 2, 0, "clean")}
    kept = M.guarded_prune(stored, scanned, "k", "src")
    count = {r.src: r["count"] for r in kept.groupBy("src").count().collect()}
    assert count == {"half": 4, "over": 8, "absent": 3, "clean": 2}
    assert rows(M.guarded_prune(kept, scanned, "k", "src")) == rows(kept)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.sets(st.integers(0, 30)), st.sets(st.integers(0, 30)))
def test_prune_never_removes_more_than_half(spark, stored, scanned):
    a, b = sources(spark, {"s": stored}, {"s": scanned})
    kept = {r.k for r in M.guarded_prune(a, b, "k", "src").collect()}
    stale = stored - scanned
    assert kept == (stored if not scanned or len(stale) > 0.5 * len(scanned) else stored - stale)


def test_bulk_update_chunks(spark):
    df = spark.createDataFrame([(i, "A" if i < 205 else "B") for i in range(210)], "k int, city string")
    got = M.grouped_bulk_update(df, "k", ["city"])
    assert sorted((r.city, r.chunk, len(r["keys"])) for r in got.collect()) == [("A", 0, 100), ("A", 1, 100), ("A", 2, 5), ("B", 0, 5)]


def test_migration_is_idempotent_and_last_wins(spark):
    data = [("/old/a", "1", 1), ("\\old\\a", "2", 2), ("v1:a", "0", 0), ("/else/x", "3", 3), ("v9:z", "4", 4), ("/old2/a", "5", 5)]
    df = spark.createDataFrame(data, "key string, value string, seq int")
    pre = [("/old/", "v1"), ("/old2/", "v2")]
    once = M.migrate_keys(df, "key", "value", "seq", pre, ["v1", "v2"])
    assert rows(once, "key", "value", "converted") == [("/else/x", "3", 0), ("v1:a", "2", 2), ("v2:a", "5", 1), ("v9:z", "4", 0)]
    again = M.migrate_keys(once.withColumn("seq", F.lit(1)).drop("converted"), "key", "value", "seq", pre, ["v1", "v2"])
    assert rows(again, "key", "value") == rows(once, "key", "value") and again.agg(F.sum("converted")).first()[0] == 0


def test_retention_partitions_the_input(spark):
    t0 = dt.datetime(2024, 1, 31)
    df = spark.createDataFrame([(i, t0 - dt.timedelta(days=i), "p" if i % 2 else "q") for i in range(30)], "i int, ts timestamp, n string")
    split = M.retention_split(df, "ts", F.lit(t0), 14, "n", "p")
    assert {r.i for r in split.filter("pruned").collect()} == {i for i in range(15, 30) if i % 2}
    assert split.count() == 30


def test_full_refresh_and_journal_runs(spark):
    path = shared_path(spark, "refresh")
    M.full_refresh(spark.range(10), path)
    assert M.full_refresh(spark.range(3), path).count() == 3
    j = shared_path(spark, "runs")
    for run in ("a", "b", "b"):
        M.journal_append(spark.createDataFrame([("ok",), ("bad",)], "status string"), run, j)
    led = M.ledger(spark.read.schema("status string, run_id string").parquet(j), F.col("status") == "ok")
    assert rows(led) == [("a", 2, 1), ("b", 2, 1)]


def test_export_restore_round_trip(spark):
    df = spark.createDataFrame([(i, {"a": i}) for i in range(50)], "k int, j map<string,int>").repartition(3)
    path = shared_path(spark, "export")
    M.export_table(df, ["k"], path)
    back = spark.read.schema(df.schema).json(path)
    assert rows(back) == rows(df)
    counts = back.agg(F.count(F.lit(1)).alias("got")).select(F.lit("t").alias("name"), "got")
    rules = spark.createDataFrame([("t", 50), ("u", 1)], "name string, expected bigint")
    assert rows(M.restore_verify(counts, rules)) == [("t", 50, 50, True), ("u", 1, 0, False)]


def test_an_export_is_compressed(spark):
    df, path = spark.range(2000).withColumn("text", F.lit("the same words again")), shared_path(spark, "export")
    assert M.export_table(df, ["id"], path) == 2000
    files = [f.split("file:")[-1] for f in spark.read.text(path).inputFiles()]
    assert files and all(f.endswith(".json.gz") for f in files)
    assert rows(spark.read.schema(df.schema).json(path)) == rows(df)


def test_journal_reader(spark):
    good, bad = '{"status":"tag","fid":"a"}', '{"status": "tag", "fid"' + "x" * 600
    lines = spark.createDataFrame([(good,), (bad,), ("  ",), ('{"status":"odd"}',), ("not json",)], "line string")
    got = journals.parse_tolerant(lines, "line", "status string, fid string")
    assert rows(got, "status", "fid") == sorted([("tag", "a"), ("mv-fail", None), ("odd", None), ("mv-fail", None)], key=repr)
    assert {len(r.raw) for r in got.filter("raw is not null").collect()} == {500 + len("...<truncated>"), 8}
    path = shared_path(spark, "lines")
    lines.write.text(path)
    assert rows(journals.read_dropping(spark, path, "status string, fid string", "tag", ("fid",))) == [("tag", "a")]
    assert rows(journals.read_tolerant(spark, path, "status string, fid string"), "status") == [("mv-fail",), ("mv-fail",), ("odd",), ("tag",)]


def test_journal_values_of_another_type_are_no_failure(spark):
    lines = spark.createDataFrame([(x,) for x in (
        '{"id":"abc","status":"tag"}', '{"id":1.5,"status":"tag"}', '{"id":7,"status":"tag","bbox":{"x":1,"y":2},"cost":1.25}',
        '{"id":8,"status":"tag","bbox":"none"}', '[1]', '17', '{"id":')], "line string")
    schema = "status string, id bigint, bbox struct<x:int,y:int>, cost decimal(10,2)"
    got = [(r.status, r.id, r.bbox and tuple(r.bbox), r.cost and float(r.cost)) for r in
           journals.parse_tolerant(lines, "line", schema).collect()]
    assert got == [("tag", None, None, None), ("tag", None, None, None), ("tag", 7, (1, 2), 1.25), ("tag", 8, None, None),
                   *[("mv-fail", None, None, None)] * 3]
    path = shared_path(spark, "lines")
    lines.write.text(path)
    assert journals.read_dropping(spark, path, schema, "tag").count() == 4


def test_envelopes(spark):
    path = shared_path(spark, "env")
    snapshots.write_envelopes(spark.range(25).withColumnRenamed("id", "k"), "k", path, F.lit("now"), 10)
    got = snapshots.read_envelopes(spark, path, "k:bigint")
    assert got.count() == 25 and rows(got.select("count_ok").distinct()) == [(True,)]
    broken = shared_path(spark, "env")
    spark.createDataFrame([('{"scanned_at":"t","count":3,"rows":[{"k":1}]}',)], "value string").write.text(broken)
    assert rows(snapshots.read_envelopes(spark, broken, "k:bigint")) == [("t", False, 1)]


def test_dict_and_grid(spark):
    d = spark.createDataFrame([('{"_說明":"x","案":"林口","空":""}',)], "t string")
    assert rows(snapshots.dict_entries(d, "t", "string", ["_說明"])) == [("案", "林口")]
    g = spark.createDataFrame([(0, "a,b,c"), (1, "d"), (2, "")], "r int, line string")
    got = tables.grid_long(g, "r", F.split("line", ","))
    assert rows(got) == [(0, 0, "a"), (0, 1, "b"), (0, 2, "c"), (1, 0, "d"), (1, 1, ""), (1, 2, ""), (2, 0, ""), (2, 1, ""), (2, 2, "")]


def test_keyset_pages_cover_everything(spark):
    df = spark.range(0, 2500, 1, 7).withColumnRenamed("id", "k")
    seen, after = [], None
    while True:
        page = [r.k for r in tables.keyset_page(df, "k", after, 1000).collect()]
        if not page:
            break
        seen += page
        after = page[-1]
    assert seen == list(range(2500))
    assert rows(tables.keyset_pages(df, "k", 1000)) == [(1, 0, 999, 1000), (2, 1000, 1999, 1000), (3, 2000, 2499, 500)]


def test_health_and_progress(spark):
    rules = spark.createDataFrame(
        [("disk", 80.0, 90.0, True, "warn"), ("backup", 26.0, 30.0, False, "critical"), ("gone", 1.0, 2.0, False, "critical")],
        "name string, warn double, critical double, inclusive boolean, missing string")
    m = lambda d, b: spark.createDataFrame([("disk", d), ("backup", b)], "name string, value double")
    got = {r.name: r.status for r in A.scorecard(m(90.0, 30.0), rules).collect()}
    assert got == {"disk": "critical", "backup": "warn", "gone": "critical"}
    assert rows(A.overall(A.scorecard(m(79.0, 26.0), rules.filter("name <> 'gone'")))) == [("ok", 0)]
    df = spark.createDataFrame([(i < 60, i < 45) for i in range(70)], "p boolean, h boolean")
    r = A.progress(df, F.col("p"), F.col("h"), 4).first()
    assert (r.processed, r.hits, r.remaining, r.days_left, r.expected_hits) == (60, 45, 10, 3, 8.0)     # 7.5 to even
    few = A.progress(df.filter("p").limit(49), F.col("p"), F.col("h"), 4).first()
    assert few.expected_hits is None and few.days_left == 0


@pytest.mark.parametrize("null_key", [True, False])
def test_duplicate_groups_reject_null_parts(spark, null_key):
    df = spark.createDataFrame([(1, "a", 1), (2, "a", 1), (3, "a", None if null_key else 1), (4, "b", 1)], "id int, n string, w int")
    assert rows(A.duplicate_groups(df, ["n", "w"], "id")) == [("a", 1, 2 if null_key else 3, 1)]
    assert rows(A.rejected_rows(df, ["n", "w"])) == [(int(null_key), 4)]
