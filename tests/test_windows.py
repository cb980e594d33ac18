import datetime as dt

from pyspark.sql import functions as F

from conftest import rows
from shelfmark.operators import aggregates as A
from shelfmark.operators import lanes as L
from shelfmark.operators import ranking as R
from shelfmark.operators import schedule as S
from shelfmark.operators import search as Q
from shelfmark.operators import windows as W

T0 = dt.datetime(2024, 1, 1)


def test_version_flags(spark):
    df = spark.createDataFrame(
        [(0, "g", 2, False, True), (1, "g", 3, False, True), (2, "g", 3, False, True), (3, "g", 1, True, True), (4, "g", 9, False, False),
         (5, "h", 1, True, True), (6, None, 1, False, True), (7, None, 2, None, True)],
        "seq int, g string, v int, is_old boolean, scope boolean")
    got = W.latest_version_flag(df, ["g"], "v", "seq", F.col("scope"))
    assert rows(got, "seq", "is_old", "newly_marked") == [
        (0, True, True), (1, False, False), (2, True, True), (3, True, False), (4, False, False), (5, True, False), (6, True, True), (7, False, False)]


def test_keeper_plan(spark):
    t = lambda d: T0 + dt.timedelta(days=d)
    df = spark.createDataFrame(
        [("a", 1, t(3), False, "h", "c1"), ("a", 2, t(2), True, "h", "c2"), ("a", 3, t(2), True, "h", "c3"), ("a", 4, t(1), True, "x", "c4"),
         ("a", 5, t(0), True, "x", "c2"), ("b", 6, t(0), False, "h", "c6"), ("b", 7, t(0), False, "h", "c7"), ("s", 8, t(0), True, "h", "c8")],
        "g string, id int, ts timestamp, ok boolean, hash string, canon string")
    got = W.keeper_plan(df, ["g"], "id", "ts", F.col("ok"), "hash", "canon")
    assert {r.id: r.plan for r in got.collect()} == {
        1: "move", 2: "keeper", 3: "move", 4: "hash-mismatch", 5: "row-only", 6: "no-keeper", 7: "no-keeper", 8: "single"}


def test_all_members_old(spark):
    df = spark.createDataFrame([("a", T0), ("a", T0), ("b", T0 + dt.timedelta(seconds=1)), ("b", T0), ("c", None)], "k string, ts timestamp")
    assert rows(A.all_older(df, "k", "ts", F.lit(T0))) == [("a", 2)]


def test_streaks(spark):
    out = []
    for key, marks in {"a": "nnhn", "b": "nnn", "c": "hnnn", "d": "nnnh", "e": "h", "f": "nnnn"}.items():
        out += [(key, i, m == "n", T0 + dt.timedelta(days=i)) for i, m in enumerate(marks)]
    df = spark.createDataFrame(out, "k string, i int, n boolean, ts timestamp")
    got = W.null_streak(df, "k", ["i"], F.col("n"), "ts", asof_day=F.lit(dt.date(2024, 1, 3)))
    assert {r.k: (r.streak, r.permanent, r.newly_permanent) for r in got.collect()} == {
        "a": (1, False, False), "b": (3, True, True), "c": (3, True, False), "d": (0, False, False), "e": (0, False, False), "f": (4, True, False)}


def test_run_delta_hides_quiet_days(spark):
    df = spark.createDataFrame([("a", 1, 5, 1), ("a", 2, 5, 1), ("a", 3, 7, 0), ("b", 1, 9, 9)], "p string, d int, x int, y int")
    assert rows(W.run_delta(df, ["p"], "d", ["x", "y"])) == [("a", 3, 7, 0, 2, -1)]


def test_order_kind(spark):
    df = spark.createDataFrame([(1, "a", False), (2, "b", False), (3, "b", True), (4, "c", False), (5, "c", False)], "id int, f string, old boolean")
    assert rows(W.order_kind(df, ["f"], "id", F.col("old")), "id", "kind") == [(1, "complete"), (2, "revised"), (4, "revised"), (5, "revised")]


def test_latest_period(spark):
    f = lambda *t: rows(R.latest_named_period(spark.createDataFrame([(x,) for x in t], "t string"), "t"))
    assert f("2025年12月", "2025年", "2024年", "雜", "2025年13") == [("2025年", 2025, 13)]
    assert f("2025年", "2026年1月", "2026年01月x") == [("2026年1月", 2026, 1)]


def grid(spark, lines):
    out = [("s", r, c, x) for r, line in enumerate(lines) for c, x in enumerate(line)]
    return spark.createDataFrame(out, "sheet string, row_idx int, col_idx int, cell string")


LINES = [
    ["", "12/30", "12/31", "1/1(四)", "2/30"],
    ["x", "Nora 甲案短影（林）", "乙案 (王)", "off (林)", "丙案(林)"],
    ["", "甲案(林)", "no editor", "nan", ""],
    ["", "1/5", "2/6", "3/1", ""],
    ["", "", "丁案*2(王)", "(林)", "z(林)"],
    ["only", "4/1", "text", "", ""],
    ["", "遠(林)", "", "", ""],
    ["", "", "", "", ""],
    ["", "太遠(林)", "", "", ""],
]


def parse(spark, year_only):
    return S.parse_schedule(grid(spark, LINES), "sheet", F.lit(2026), F.lit(year_only), ["off"], ["林", "王"], ["Nora"], ["短影"], [])


def test_schedule_grid(spark):
    # the fourth date of row 0 is no plain m/d and is not counted; 2/30 does not exist but counts as February
    got = rows(parse(spark, False), "date", "case_name", "editor")
    d = dt.date
    assert got == sorted([(d(2026, 12, 30), "甲案", "林"), (d(2026, 12, 31), "乙案", "王"), (d(2028, 2, 6), "丁案", "王"), (d(2028, 1, 5), "遠", "林")], key=repr)


def test_schedule_year_only_counts_back(spark):
    years = {r.date.year for r in parse(spark, True).collect()}
    assert years == {2024, 2026}


def test_unreadable_day_counts_for_the_total_only(spark, monkeypatch):
    for rows_per_bucket in (100, 1):
        monkeypatch.setattr(L, "ROWS_PER_BUCKET", rows_per_bucket)
        df = spark.createDataFrame([("s", 0, 12, 1, 12), ("s", 1, None, None, 1), ("s", 2, 12, 2, 12), ("s", 3, 3, 3, 3), ("t", 0, 2, 30, 2), ("t", 1, 1, 1, 1)],
                                   "sheet string, i int, mo int, da int, am int")
        got = S.year_rollover(df, "sheet", ["i"], "mo", "da", F.lit(2026), F.col("sheet") == "s", "am")
        assert rows(got, "sheet", "i", "date") == sorted([
            ("s", 0, dt.date(2024, 12, 1)), ("s", 1, None), ("s", 2, dt.date(2024, 12, 2)), ("s", 3, dt.date(2025, 3, 3)), ("t", 0, None),
            ("t", 1, dt.date(2027, 1, 1))], key=repr)


def test_header_rows_keep_seven_columns(spark):
    g = grid(spark, [[f"1/{i}" for i in range(1, 10)], [str(i) for i in range(9)], ["1/1", "1/2", "x"]])
    heads = S.header_cells(g, "sheet")
    assert rows(heads, "row_idx", "col_idx") == [(0, i) for i in range(7)]
    assert S.assign_headers(g, heads, "sheet").filter("row_idx = 1").count() == 7


def test_priority_blocks_leave_out_unknown_district(spark):
    df = spark.createDataFrame(
        [(1, "台北", "松山", 1), (2, "台北", None, 2), (3, "台北", "大安", 3), (4, None, None, 4), (5, "新北", "松山", 5), (6, "台北", "大安,松山", 6)],
        "id int, city string, d string, t int")
    got = Q.priority_partition(df, "city", "d", "台北", ["松山"], "t", "id")
    assert [(r.id, r.block) for r in got.collect()] == [(6, 0), (1, 0), (5, 1), (4, 1), (3, 1)]
    page = Q.priority_partition(df, "city", "d", "台北", ["松山"], "t", "id", 1, 2)
    assert [r.id for r in page.collect()] == [1, 5]


def test_relaxed_search_and_primary_place(spark):
    df = spark.createDataFrame([(1, "青山樂章 A", "青山樂章", "台北", "松山, 大安"), (2, "其他", "青山樂章二", "新北", None), (3, "x", "青山樂章二", "新北", None)],
                               "id int, t string, case string, city string, d string")
    assert rows(Q.relaxed_search(df, "t", "青山樂章第二篇", r"第[一二三]+篇$", "\u4e00-\u9fff"), "id") == [(1,)]
    assert rows(Q.relaxed_search(df, "t", "其", "x$", "\u4e00-\u9fff"), "id") == [(2,)]
    got = Q.primary_location(df, "case", "city", "d", "id", "青山樂章").first()
    assert (got.city, got.districts) == ("台北", ["松山", "大安"])
    assert Q.primary_location(df, "case", "city", "d", "id", "樂章").first().city == "新北"
    assert Q.primary_location(df, "case", "city", "d", "id", "無").count() == 0


def test_like_patterns_are_literal(spark):
    df = spark.createDataFrame([(1, "100% a_b"), (2, "100x aXb")], "id int, t string")
    assert rows(df.filter(F.col("t").ilike(Q.like_pattern("0% A_B"))), "id") == [(1,)]


def test_fuzzy_limit_is_alphabetical(spark):
    df = spark.createDataFrame([("zz red",), ("aa red",), ("mm red",), ("red",), ("red",), ("none",), (None,)], "n string")
    assert [r.case_name for r in Q.fuzzy_case_search(df, "n", "red", 0.03, 2).collect()] == ["aa red", "mm red"]
    assert [r.case_name for r in Q.fuzzy_case_search(df, "n", "red", 0.03, 1, "similarity").collect()] == ["red"]
    df.createOrReplaceTempView("fuzzy_names")
    Q.register_sql_functions(spark, "fuzzy_names", "n")
    got = spark.sql("select * from fuzzy_search_cases('red')").collect()
    want = Q.fuzzy_case_search(df, "n", "red").collect()
    assert [(r.case_name, round(r.sim, 6)) for r in got] == [(r.case_name, round(r.sim, 6)) for r in want]


def test_keeper_needs_a_time_to_win(spark):
    from pyspark.sql import functions as F
    from shelfmark.operators.windows import keeper_plan
    df = spark.createDataFrame([("g", "a", None, "h", "c1"), ("g", "b", "2024-01-01 00:00:00", "h", "c2")],
                               "grp string, id string, mtime string, hash string, canon string")
    plan = {r["id"]: r["plan"] for r in keeper_plan(df, ["grp"], "id", "mtime", F.lit(True), "hash", "canon").collect()}
    assert plan == {"a": "move", "b": "keeper"}


def test_pages_of_any_depth(spark):
    data = [(i * 37 % 500, i % 7 if i % 11 else None) for i in range(500)]
    df = spark.createDataFrame(data, "id int, v int").repartition(3)
    order = [F.desc_nulls_last("v"), F.asc("id")]
    want = sorted(data, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))
    for offset, n in ((0, 10), (95, 20), (490, 50), (500, 5), (7, 0)):
        for buckets in (1, 9):
            got = [tuple(r) for r in R.page_slice(df, order, offset, n, buckets).collect()]
            assert got == [(*r, 500) for r in want[offset:offset + n]]
    assert R.page_slice(df.limit(0), order, 0, 5).count() == 0


def test_a_page_reads_its_buckets_alone(spark, monkeypatch):
    kept, write = [], R.range_bucket
    monkeypatch.setattr(R, "range_bucket", lambda *a: kept.append(write(*a)) or kept[0])
    page = R.page_slice(spark.range(10000), [F.asc("id")], 5000, 10, 20)
    wanted = page._jdf.queryExecution().optimizedPlan().toString()
    assert [r[0] for r in page.collect()] == list(range(5000, 5010))
    sizes = {r["_bucket"]: r["count"] for r in kept[0].groupBy("_bucket").count().collect()}
    assert len(sizes) == 20 and wanted.count("_bucket") and "IN (" not in wanted.replace("_bucket", "").split("Window")[0]
    read = kept[0].filter(F.col("id").between(5000, 5009)).select("_bucket").distinct().count()
    assert read <= 2
