"""Skew-proof blocks against brute force, with one key holding a third of the rows."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from shelfmark.operators import lanes as L


@pytest.fixture(scope="module")
def data():
    rnd = random.Random(7)
    out = []
    for i in range(3000):
        key = "hot" if i % 3 == 0 else (None if i % 50 == 1 else f"k{rnd.randrange(400)}")
        out.append((i, key, rnd.randrange(1, 13), rnd.randrange(100)))
    rnd.shuffle(out)
    return out


@pytest.fixture(scope="module")
def df(spark, data):
    return spark.createDataFrame(data, "id bigint, k string, m int, v int").repartition(5)


def by_key(data):
    groups = defaultdict(list)
    for r in sorted(data):
        groups[r[1]].append(r)
    return groups


def test_attach_group(df, data):
    got = L.attach_group(df, ["k"], ["id"], {"n": ("count", F.lit(1)), "top": ("max", F.struct("v", "id")),
                                             "low": ("min", F.col("v")), "s": ("sum", F.col("v")), "all5": ("all", F.col("v") > 5)})
    g = by_key(data)
    assert got.count() == len(data)
    for r in got.collect():
        rows = g[r.k]
        assert (r.n, r.low, r.s) == (len(rows), min(x[3] for x in rows), sum(x[3] for x in rows))
        assert tuple(r.top) == max((x[3], x[0]) for x in rows) and r.all5 == all(x[3] > 5 for x in rows)


def test_attach_lookup_keeps_unmatched(df, data):
    got = L.attach_lookup(df, ["k"], ["id"], lambda d: d.filter("k = 'hot'").withColumn("z", F.lit(1)), ["z"])
    assert sorted((r.id, r.z) for r in got.collect()) == sorted((x[0], 1 if x[1] == "hot" else None) for x in data)


@pytest.mark.parametrize("buckets", [1, 7, 300])
def test_numbered_and_running(df, data, buckets):
    whole = {r.id: r.rn for r in L.numbered(df, ["id"], buckets=buckets).collect()}
    assert whole == {i: i + 1 for i in range(3000)}
    got = L.running_sum(df, ["k"], ["id"], {"rn": F.lit(1), "tot": F.col("v")}, buckets)
    want = {}
    for rows in by_key(data).values():
        t = 0
        for n, x in enumerate(rows, 1):
            t += x[3]
            want[x[0]] = (n, t)
    assert {r.id: (r.rn, r.tot) for r in got.collect()} == want


@pytest.mark.parametrize("buckets", [1, 9, 200])
def test_lagged(df, data, buckets):
    got = {r.id: r.prev for r in L.lagged(df, ["id"], "m", "prev", ["k"], buckets).collect()}
    want = {}
    for rows in by_key(data).values():
        for a, b in zip([None, *rows], rows):
            want[b[0]] = a and a[2]
    assert got == want


def test_buckets_grow_with_multi_column_order(df):
    rows = L.range_bucket(df, ["v", "id"], 150).select("v", "id", "_bucket").collect()
    ordered = [r._bucket for r in sorted(rows, key=lambda r: (r.v, r.id))]
    assert ordered == sorted(ordered) and len(set(ordered)) > 100


def test_keep_ranked_limits_before_the_shuffle(df, data):
    top = L.keep_ranked(df, ["k"], [F.desc("v"), F.asc("id")], 2)
    want = sorted(x[0] for rows in by_key(data).values() for x in sorted(rows, key=lambda x: (-x[3], x[0]))[:2])
    assert sorted(r.id for r in top.collect()) == want
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_keep_ranked_beyond_the_group_limit(spark, df, data):
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", 10)
    try:
        got = L.keep_ranked(df, ["k"], [F.asc("v"), F.asc("id")], 50)
        want = sorted(x[0] for rows in by_key(data).values() for x in sorted(rows, key=lambda x: (x[3], x[0]))[:50])
        assert sorted(r.id for r in got.collect()) == want
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")


def test_keep_ranked_goes_through_lanes_above_a_few_rows(df, data):
    got = L.keep_ranked(df, ["k"], [F.asc("v"), F.asc("id")], 1000)
    want = sorted(x[0] for rows in by_key(data).values() for x in sorted(rows, key=lambda x: (x[3], x[0]))[:1000])
    assert sorted(r.id for r in got.collect()) == want
    assert "_lane" in got._jdf.queryExecution().executedPlan().toString()


def test_numbered_over_text_and_dates(spark):
    import datetime as dt
    items = [(f"n{i % 13}-{i}", dt.date(2024, 1, 1) + dt.timedelta(days=i % 40), i) for i in range(500)]
    t = spark.createDataFrame(items, "s string, d date, i int")
    by_text = {r.s: r.rn for r in L.numbered(t, ["s"], buckets=20).collect()}
    assert by_text == {s: n for n, s in enumerate(sorted(x[0] for x in items), 1)}
    got = {r.i: r.rn for r in L.numbered(t, ["d", "i"], buckets=90).collect()}
    assert got == {x[2]: n for n, x in enumerate(sorted(items, key=lambda x: (x[1], x[2])), 1)}


@pytest.mark.parametrize("size", [40, 700])
def test_buckets_follow_the_row_count(df, data, monkeypatch, size):
    monkeypatch.setattr(L, "ROWS_PER_BUCKET", size)
    assert {r.id: r.rn for r in L.numbered(df, ["id"]).collect()} == {i: i + 1 for i in range(3000)}
    n = L.range_bucket(df, ["id"]).select("_bucket").distinct().count()
    assert abs(n - 3000 / size) <= 2
    by = L.numbered(df.filter("k is not null"), ["id"], ["k"])
    want = {x[0]: n for key, rows in by_key(data).items() if key for n, x in enumerate(rows, 1)}
    assert {r.id: r.rn for r in by.collect()} == want


def test_staged_folders_are_cleared(spark):
    from shelfmark import session
    session.clear_staged(spark)
    kept = session.stage(spark.range(5), "gone")
    assert kept.count() == 5 and session.clear_staged(spark) == 1
    path = kept.inputFiles()[0].removeprefix("file://")
    from pathlib import Path
    assert not Path(path).parent.exists() and session.clear_staged(spark) == 0


def test_a_bucket_of_a_task_has_about_a_million_rows(spark):
    got = L.range_bucket(spark.range(2_500_000).select((F.col("id") * 7 % 2_500_003).alias("i")), ["i"]).groupBy("_bucket").agg(
        F.count("*").alias("n"), F.min("i").alias("lo"), F.max("i").alias("hi")).orderBy("_bucket").collect()
    assert len(got) == 3 and sum(r["n"] for r in got) == 2_500_000 and max(r["n"] for r in got) < 1_300_000
    assert all(a["hi"] < b["lo"] for a, b in zip(got, got[1:]))
