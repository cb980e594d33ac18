import datetime as dt

from pyspark.sql import functions as F

from conftest import rows
from shelfmark.functions import names as N
from shelfmark.operators import joins as J

T0 = dt.datetime(2024, 1, 1)


def test_override_levels(spark):
    guess = spark.createDataFrame(
        [("a", "台北", "大安", "七期", True), ("b", "新北", None, None, False), ("c", "桃園", "x", "A", True), ("d", "台中", "y", "B", False), ("h", "h", "h", "h", False)],
        "k string, city string, district string, area string, auto_area boolean")
    existing = spark.createDataFrame(
        [("b", "E", "e", None, False, False), ("d", "E", "e", "EE", False, True), ("e", "E", "e", None, False, False)],
        "k string, city string, district string, area string, auto_area boolean, manual boolean")
    manual = spark.createDataFrame([("a", "M", "m", None), ("d", "M", "m", None), ("f", "M", None, "MA")], "k string, city string, district string, area string")
    admin = spark.createDataFrame(
        [("a", "臺北市", "松山區", False, "admin-ui"), ("b", "", "zzz", False, "admin-ui"), ("c", None, None, True, "admin-ui"),
         ("d", "Q", "q", False, "import"), ("g", "新竹市", "北區", False, "admin-ui"), ("x", "", None, False, "admin-ui")],
        "k string, city string, district string, is_non_building boolean, source string")
    got = J.override_merge(guess, existing, manual, admin, "k", city_variants={"臺": "台"}, city_units="市縣", district_units="區鎮鄉市", keep_districts=["北區"])
    assert rows(got) == sorted([
        ("a", "台北", "松山", "七期"),      # manual keeps the automatic area, the admin changes city and district
        ("b", "新北", None, None),         # empty admin city changes nothing; unflagged existing loses to the guess
        ("c", None, None, None),          # non-building clears everything
        ("d", "M", "m", None),            # flagged existing, then manual without area; imports never override
        ("e", "E", "e", None), ("f", "M", None, "MA"), ("g", "新竹", "北區", None), ("h", "h", "h", "h")], key=repr)


def test_mismatch_treats_blank_as_null(spark):
    df = spark.createDataFrame([(1, "a", None, ""), (2, "a", "x", None), (3, "b", "x", "y"), (4, "z", "q", "q")], "id int, k string, city string, d string")
    exp = spark.createDataFrame([("a", "", None), ("b", "x", "y")], "k string, city string, d string")
    assert rows(J.mismatches(df, "k", exp, ["city", "d"], ["id"]), "id") == [(2,)]


def norm(c):
    return N.normalize_case(c, "下載連結")


def test_tiers(spark):
    scripts = spark.createDataFrame(
        [(1, "甲案", "", "甲.docx", 5), (2, "甲案", "sub", "x.docx", 9), (3, "乙  案", "", "乙.docx", 1), (4, "丙案大樓", "", "丙.docx", 1),
         (5, "案大", "", "五.docx", 1), (6, "別", "", "腳本丁案v2.docx", 1), (7, "甲案", "", "z.docx", 7), (8, "甲案", "", "w.docx", 1), (9, "", "甲案", "s.docx", 8)],
        "id int, folder string, sub string, name string, size int")
    cases = spark.createDataFrame([(x,) for x in ["甲案", "乙 案", "丙案", "丁案", "戊", "sub", "大"]], "case string")
    got = J.tiered_match(cases, "case", scripts, norm, "id", "folder", "sub", "name", [F.desc("size"), F.asc("id")])
    assert rows(got) == sorted([
        ("甲案", 1, 2, 1), ("甲案", 1, 9, 2), ("甲案", 1, 7, 3), ("sub", 1, 2, 1), ("乙 案", 2, 3, 1), ("丙案", 3, 4, 1), ("丁案", 4, 6, 1),
        ("大", 3, 4, 1)], key=repr)       # of 丙案大樓 and 案大 the first in script order


def test_renames_merge_only_protected_tags(spark):
    cat = spark.createDataFrame([("old1", ["p", "x"]), ("new1", ["n"]), ("old2", ["p"]), ("stay", ["q"]), ("m1", ["p"]), ("m2", ["p2", "z"])], "k string, tags array<string>")
    ren = spark.createDataFrame([("old1", "new1"), ("old2", "new2"), ("m1", "both"), ("m2", "both")], "k string, new_key string")
    got = J.apply_renames(cat, "k", "tags", ren, ["p", "p2"])
    assert rows(got) == sorted([("new1", ["n", "p"]), ("new2", ["p"]), ("stay", ["q"]), ("both", ["p", "p2"])], key=repr)


def test_preserve_tags(spark):
    new = spark.createDataFrame([("a", ["n"]), ("b", [])], "k string, tags array<string>")
    old = spark.createDataFrame([("a", ["p", "x"]), ("b", ["x"])], "k string, tags array<string>")
    assert rows(J.preserve_tags(new, old, "k", "tags", ["p"])) == [("a", ["n", "p"]), ("b", [])]


def test_reconcile(spark):
    j = spark.createDataFrame([(1, "n", True), (2, "n", False), (3, "n", True), (4, "n", True)], "fid int, np string, disk boolean")
    cat = spark.createDataFrame([(1, "old"), (2, "old"), (3, "n")], "id int, path string")
    got = J.journal_reconcile(j, "fid", "np", F.col("disk"), cat, "id", "path")
    assert rows(got, "fid", "status") == [(1, "patched"), (2, "disk-missing"), (3, "already-new"), (4, "row-missing")]


def test_ancestors_and_output_folder(spark):
    folders = spark.createDataFrame([("r", "root", None), ("a", "案", "r"), ("o", "成品", "a"), ("z", "成品", None)], "folder_id string, name string, parent_id string")
    assert rows(J.ancestor_chains(folders, 5)) == sorted([("r", ["root"]), ("a", ["案", "root"]), ("o", ["成品", "案", "root"]), ("z", ["成品"])], key=repr)
    assert {r[0]: len(r[1]) for r in rows(J.ancestor_chains(folders, 2))} == {"r": 1, "a": 2, "o": 2, "z": 1}
    files = spark.createDataFrame([(1, "o"), (2, "a"), (3, "z"), (4, None)], "id int, parent string")
    assert rows(J.output_case(files, "parent", folders, "成品", ["id"]), "id", "case_name") == [(1, "案")]


def test_approvals(spark):
    day = dt.timedelta(days=1)
    pend = spark.createDataFrame([("a", T0), ("b", T0), ("c", T0), ("d", T0)], "token string, created_at timestamp")
    acts = spark.createDataFrame(
        [("a", "confirm", T0 + day, 1), ("a", "confirm", T0 + 2 * day, 2), ("b", "cancel", T0 + day, 3), ("b", "confirm", T0 + 2 * day, 4),
         ("c", "confirm", T0 + 7 * day, 5), ("d", "confirm", T0 + 7 * day + dt.timedelta(seconds=1), 6), ("x", "confirm", T0, 7), ("a", "confirm", T0 - day, 8)],
        "token string, action string, at timestamp, seq int")
    out = J.approvals(pend, acts)
    assert {r.seq: r.outcome for r in out.collect()} == {
        1: "executed", 2: "no-pending", 3: "cancelled", 4: "no-pending", 5: "executed", 6: "expired", 7: "unknown-token", 8: "no-pending"}
    ids = spark.createDataFrame([("a", i) for i in range(7)] + [("b", 1)], "token string, id int")
    got = J.approved_deletes(ids, out, cap=5)
    assert rows(got) == [("a", i, i < 5) for i in range(7)]


def test_exclusions_first_reason_wins(spark):
    f = lambda *k: spark.createDataFrame([(x,) for x in k], "k string")
    nulls = spark.createDataFrame([("a", 9), ("c", 3), ("d", 2)], "k string, count int")
    got = J.exclusion_reasons(f("a", "b", "c", "d", "e"), "k", f("a"), f("a", "b"), nulls)
    assert rows(got) == [("a", "manual"), ("b", "table"), ("c", "null-limit"), ("d", "todo"), ("e", "todo")]


def test_deep_ancestors_and_cycles(spark):
    n = 300
    tree = [(f"f{i}", f"n{i}", f"f{i - 1}" if i else None) for i in range(n)] + [("a", "A", "b"), ("b", "B", "a"), ("x", "X", "gone")]
    folders = spark.createDataFrame(tree, "folder_id string, name string, parent_id string")
    for levels in (1, 7, 64, 1000):
        got = {r[0]: r[1] for r in rows(J.ancestor_chains(folders, levels))}
        assert len(got) == len(tree)
        assert all(got[f"f{i}"] == [f"n{k}" for k in range(i, max(i - levels, -1), -1)] for i in range(0, n, 17))
        assert got["x"] == ["X"] and got["a"][:2] == ["A", "B"][:levels] and len(got["a"]) == levels


def test_only_open_chains_join(spark, monkeypatch):
    seen, write = [], J.stage
    monkeypatch.setattr(J, "stage", lambda df, label: seen.append(df._jdf.queryExecution().optimizedPlan().toString()) or write(df, label))
    folders = spark.createDataFrame([(i, f"n{i}", i // 3 if i else None) for i in range(40)], "folder_id int, name string, parent_id int")
    J.ancestor_chains(folders, 8).collect()
    assert all("isnotnull(_next" in plan for plan in seen[1:]) and len(seen) == 4
