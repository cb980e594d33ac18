"""The combined jobs on a tiny catalog."""

from pyspark.sql import functions as F

from conftest import rows
from shelfmark import catalog as G
from shelfmark.operators.dictionary import gazetteer_match

RULES = G.NamingRules(layers=["1_專案"], stop_names=["成品"], channel_categories={"風景": "view"},
                      category_rules=[("drone", "aerial"), ("成品", "output")], default_category="tape", old_marker="舊")
RAW = "seq int, drive_file_id string, source string, channel_folder string, case_folder string, subpath string, filename string"


def listing(spark):
    return spark.createDataFrame([
        (0, "a1", "nas", "2_頻道", "1_專案", "成品/海風", "片 V1.mp4"), (1, "a2", "nas", "2_頻道", "1_專案", "成品/海風", "片 V2.MP4"),
        (2, "a3", "nas", "2_頻道", "星河", "舊/成品", "x.mp4"), (3, "a4", "drive", "風景", "星河", "成品", "片 V1.mp4"),
        (4, "a5", "drive", "3_乙", "甲案", "Drone/成品", "._y.mp4"), (5, "a6", "drive", "3_乙", "甲案", "Drone/成品", "y.mp4")], RAW)


def test_refine(spark):
    got = {r.drive_file_id: r for r in G.refine_listing(listing(spark), RULES).collect()}
    assert sorted(got) == ["a1", "a2", "a3", "a4", "a6"]          # the sidecar is gone
    assert [(got[k].case_name, got[k].category, got[k].is_old) for k in sorted(got)] == [
        ("海風", "output", True), ("海風", "output", False), ("星河", "output", True), ("星河", "view", False), ("甲案", "aerial", False)]
    assert (got["a1"].channel_order, got["a1"].channel_name, got["a1"].category_folder) == (2, "頻道", "1_專案")
    assert got["a1"].tags == sorted(["海風", "頻道", "片 V1"]) and got["a3"].tags == sorted(["舊", "星河", "頻道", "x"])


def stored(spark, ids):
    df = spark.createDataFrame(
        [(i, src, "c", "k", "", "f", ["keep", "drop"], "old text", False, "台北", None) for i, src in ids],
        "drive_file_id string, source string, channel_name string, case_name string, subpath string, filename string, tags array<string>, "
        "search_text string, is_old boolean, city string, district string")
    return df


def test_publish_twice_is_stable(spark):
    new = G.refine_listing(listing(spark), RULES)
    cat = stored(spark, [("a1", "nas"), ("gone", "nas"), ("d1", "drive"), ("d2", "drive"), ("other", "tape")])
    once = G.publish(cat, new, ["keep"])
    got = {r.drive_file_id: r for r in once.collect()}
    # one stale nas row of three scanned goes, two stale drive rows of two scanned stay, unscanned sources stay
    assert sorted(got) == ["a1", "a2", "a3", "a4", "a6", "d1", "d2", "other"]
    assert got["a1"].tags == sorted(["keep", "海風", "頻道", "片 V1"]) and got["a1"].city == "台北"
    assert got["a1"].search_text == "頻道 海風 成品/海風 片 V1.mp4 " + " ".join(got["a1"].tags)
    assert rows(G.publish(once, new, ["keep"])) == rows(once)


def test_places_follow_names_and_overrides(spark):
    cat = spark.createDataFrame(
        [("1", "台北大安案", "t", None, None), ("2", "甲", "t 桃園", "X", "y"), ("3", "非樓", "t", "台北", "z"), ("4", "無", "t", "Q", "q"), ("5", None, "t", "R", None)],
        "drive_file_id string, case_name string, search_text string, city string, district string")
    manual = spark.createDataFrame([("甲", "桃園", None, "七期 水岸")], "case_name string, city string, district string, area string")
    existing = manual.filter("false").withColumn("auto_area", F.lit(False)).withColumn("manual", F.lit(False))
    admin = spark.createDataFrame([("非樓", None, None, True, "admin-ui")], "case_name string, city string, district string, is_non_building boolean, source string")
    places = G.expected_places(cat, lambda c: gazetteer_match(c, ["台北"], {}, {"台北": ["大安"]}, {}, {}), existing, manual, admin)
    once = G.apply_places(cat, places)
    assert rows(once, "drive_file_id", "city", "district", "search_text") == [
        ("1", "台北", "大安", "t 台北 大安 台北 大安"), ("2", "桃園", None, "t 桃園 七期 水岸"), ("3", None, None, "t"), ("4", "Q", "q", "t"), ("5", "R", None, "t")]
    assert rows(G.apply_places(once, places)) == rows(once)
    plan = spark.createDataFrame([(1, "甲"), (2, "無")], "id int, case_name string")
    assert rows(G.place_schedule(plan, places, ["id"]), "id", "city") == [(1, "桃園"), (2, None)]


def test_cases_that_need_scripts(spark):
    cat = spark.createDataFrame([("台北大安案", None), ("台北案", None), ("手動", None), ("已定", "X"), (" 甲 ", None), ("甲", None), ("", None)], "case_name string, city string")
    manual = spark.createDataFrame([("手動", "桃園"), ("甲", "")], "case_name string, city string")
    got = G.cases_for_scripts(cat, manual, lambda c: gazetteer_match(c, ["台北"], {}, {"台北": ["大安"]}, {}, {}))
    assert rows(got) == sorted([("台北大安案", "台北", "大安"), ("台北案", None, None), ("甲", None, None)], key=repr)


def test_rollback_takes_places_back_once(spark):
    cat = spark.createDataFrame([("a", ["x", "市", "y"], "title 市 more"), ("b", None, None), ("c", ["z"], "nothing"), ("d", ["q", "r"], "q r s")],
                                "drive_file_id string, tags array<string>, search_text string")
    journal = [("a", "市", 1), ("a", "市", 2), ("a", "y", 3), ("b", "市", 4), ("gone", "市", 5), ("c", "市", 6), ("d", "r", 7), ("d", "q", 8)]
    j = spark.createDataFrame(journal, "fid string, place string, seq int")
    patches, report = G.rollback_places(cat, j, "fid", "place", "seq")
    assert rows(patches) == [("a", ["x"], "title more"), ("d", [], "s")]
    status = {r["seq"]: r["status"] for r in report.collect()}
    assert status == {1: "reverted", 2: "no-change", 3: "reverted", 4: "no-change", 5: "row-missing", 6: "no-change", 7: "reverted", 8: "reverted"}
    after = cat.filter("drive_file_id not in ('a', 'd')").unionByName(patches)
    again, report = G.rollback_places(after, j, "fid", "place", "seq")
    assert again.count() == 0 and {r["status"] for r in report.collect()} == {"no-change", "row-missing"}


def test_nothing_of_an_unhealthy_volume_is_missing(spark):
    cat = spark.createDataFrame([(1, "v", "a"), (2, "v", "b"), (3, "w", "c"), (4, "w", "d"), (5, "u", "e"), (6, "v", ""), (7, "v", None)],
                                "id int, volume string, path string")
    listing = spark.createDataFrame([("v", "a"), ("v", "a"), ("w", "d"), ("u", "e")], "volume string, path string")
    assert rows(G.missing_files(cat, listing, "id", "volume", "path", ["v", "w"])) == [(2, "missing"), (3, "skipped")]
    assert rows(G.missing_files(cat, listing.filter("volume = 'v'"), "id", "volume", "path", ["w"])) == [
        (2, "skipped"), (3, "skipped"), (4, "skipped"), (5, "skipped")]


def test_schedule_is_replaced_as_a_whole(spark):
    import datetime as dt
    from shelfmark.session import shared_path
    day = dt.date(2024, 3, 1)
    week = [("s", day + dt.timedelta(days=i), f"case {i}", "ab") for i in range(-1, 9)]
    schedule = spark.createDataFrame(week, "sheet string, date date, case_name string, editor string")
    places = spark.createDataFrame([("case 0", "A", ""), ("case 3", "B", "x")], "case_name string, city string, district string")
    path = shared_path(spark, "schedule")
    for asof in (day - dt.timedelta(days=9), day):
        got = G.sync_schedule(schedule, places, F.lit(asof), 7, path)
    assert rows(got, "case_name", "city", "district") == [(f"case {i}", {0: "A", 3: "B"}.get(i), {3: "x"}.get(i)) for i in range(7)]


def test_search_starts_with_the_place_of_the_query(spark):
    import datetime as dt
    at = dt.datetime(2024, 1, 1)
    data = [(f"f{i}", "tower part" if i % 2 else "other", "North" if i % 3 else "South", "d1" if i % 3 else None, f"tower {i}" if i < 8 else "none",
             i == 6, "out", at + dt.timedelta(days=i)) for i in range(10)]
    cat = spark.createDataFrame(data, "drive_file_id string, case_name string, city string, district string, search_text string, is_old boolean, "
                                      "category string, mtime timestamp")
    got = G.search(cat, "tower - 3", "x$", "a-z", n=20)
    assert [(r["drive_file_id"], r["block"]) for r in got.collect()] == [("f7", 0), ("f5", 0), ("f4", 0), ("f2", 0), ("f1", 0), ("f3", 1), ("f0", 1)]
    assert [r["drive_file_id"] for r in G.search(cat, "tower - 3", "x$", "a-z", category="out", offset=4, n=2).collect()] == ["f1", "f3"]
    assert G.search(cat, "tower - 3", "x$", "a-z", category="none").count() == 0
    assert [r["block"] for r in G.search(cat.withColumn("city", F.lit(None).cast("string")), "none", "x$", "a-z").collect()] == [0, 0]
