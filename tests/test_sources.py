"""Volume listings, sheets, file samples, and the restore drill."""

import datetime as dt
import hashlib
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import rows
from shelfmark.functions.values import content_fingerprint
from shelfmark.operators import maintenance as M
from shelfmark.session import shared_path
from shelfmark.sources import grids, inventory, walk


@pytest.fixture
def tree(tmp_path):
    for name in ("a.mp4", "b.TXT", "._a.mp4", "x/c.mp4", "x/y/d.mov", "x/y/z/e.mp4", "#recycle/f.mp4", "x/@eaDir/g.mp4", "x/skip/h.mp4",
                 "x/y/skip/deep/i.mp4", "noext", "x/has space, 台北.mp4"):
        p = tmp_path / name
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_bytes(b"x" * len(name))
        os.utime(p, (1_700_000_000, 1_700_000_000.25))
    os.symlink(tmp_path / "x", tmp_path / "loop")
    return tmp_path


def listed(df):
    return sorted(r["rel_path"] for r in df.collect())


@pytest.mark.parametrize("deal", [256, 2, 1])
def test_volume_is_pruned_while_it_is_walked(spark, tree, monkeypatch, deal):
    monkeypatch.setattr(walk, "FOLDERS_TO_DEAL", deal)
    for closed in ("#recycle", "x/skip", "x/@eaDir"):       # opening one would fail for other users than root
        (tree / closed).chmod(0)
    try:
        got = inventory.file_inventory(spark, str(tree), "v1", ["mp4", "mov"], 8, ["skip"], ["#", "@"])
        assert listed(got) == sorted(["a.mp4", "x/c.mp4", "x/y/d.mov", "x/y/z/e.mp4", "x/has space, 台北.mp4"])
        assert listed(inventory.file_inventory(spark, str(tree), "v1", None, 2, ["skip"], ["#", "@"])) == sorted(
            ["a.mp4", "b.TXT", "noext", "x/c.mp4", "x/has space, 台北.mp4"])
        r = got.filter("rel_path = 'x/y/d.mov'").first()
        assert (r.filename, r.ext, r.size_bytes, r.volume) == ("d.mov", "mov", 9, "v1")
        assert r.mtime == dt.datetime.fromtimestamp(1_700_000_000.25)
    finally:
        for closed in ("#recycle", "x/skip", "x/@eaDir"):
            (tree / closed).chmod(0o755)


def test_pruned_folders_are_never_opened(tree):
    options = {"path": str(tree), "volume": "v", "max_depth": "8", "prune_names": '["skip"]', "prune_prefixes": '["#", "@"]', "extensions": "[]"}
    reader = walk._Walk(options)
    opened, scan = [], os.scandir
    walk.os.scandir = lambda p: opened.append(os.path.relpath(p, tree)) or scan(p)
    try:
        found = [r for part in reader.partitions() for r in reader.read(part)]
    finally:
        walk.os.scandir = scan
    assert not [p for p in opened if "skip" in p or "#" in p or "@" in p or "loop" in p]
    assert len(found) == len({r[0] for r in found}) == 7


def test_both_listings_agree(spark, tree):
    local = inventory.file_inventory(spark, str(tree), "v", ["mp4"], 3, ["skip"], ["#", "@"])
    remote = inventory.file_inventory(spark, f"file://{tree}", "v", ["mp4"], 3, ["skip"], ["#", "@"])
    cols = ["rel_path", "filename", "ext", "size_bytes", "mtime", "volume"]
    want = [r for r in rows(remote, *cols) if "%20" not in r[0] and "loop" not in r[0]]
    assert [r for r in rows(local, *cols) if " " not in r[0]] == [r for r in want if " " not in r[0]]


def test_sheets_are_read_as_they_were_written(spark):
    sheets = {"Plan 1": [["a", "b,c", None], ["d"], [""], ['say "x"', "two\nlines", "three\r\nlines", "end"]], "台北": [["only"]], "e": [["", ""], ["x", "y"]]}
    path = shared_path(spark, "grids")
    df = spark.createDataFrame([(s, i, c) for s, grid in sheets.items() for i, c in enumerate(grid)], "s string, i int, c array<string>")
    grids.write_grids(df.repartition(3), "s", "i", "c", path)
    want = []
    for s, grid in sheets.items():
        width = max(map(len, grid))
        want += [(s, i, j, (cells + [""] * width)[j] or "") for i, cells in enumerate(grid) for j in range(width)]
    assert rows(grids.read_grids(spark, path), "sheet", "row_idx", "col_idx", "cell") == sorted(want, key=repr)


def test_a_long_sheet_is_many_files_read_in_order(spark):
    path = shared_path(spark, "grids")
    sheets = {"a": 2500, "b": 3, None: 40}
    grid = {s: [[f"{i}", 'x\n"y"'] if i % 2 else ([f"{i}"] if i else [""]) for i in range(n)] for s, n in sheets.items()}
    grid["a"][2499] = ["2499", "", "wide"]
    df = spark.createDataFrame([(s, i, c) for s, g in grid.items() for i, c in enumerate(g)], "s string, i int, c array<string>")
    grids.write_grids(df.repartition(3), "s", "i", "c", path, rows_per_file=100)
    files = spark.read.text(path, wholetext=True).groupBy("sheet").count().collect()
    assert {r["sheet"]: r["count"] for r in files}["a"] >= 25
    got = {}
    for sheet, i, j, cell in rows(grids.read_grids(spark, path), "sheet", "row_idx", "col_idx", "cell"):
        got.setdefault(sheet, {})[i, j] = cell
    for sheet, g in grid.items():
        width = max(map(len, g))
        assert got[sheet] == {(i, j): (c + [""] * width)[j] for i, c in enumerate(g) for j in range(width)}


def test_file_fingerprints_read_three_ranges(spark, tmp_path):
    contents = {"empty": b"", "small": b"ab" * 10, "edge": bytes(range(30)), "big": bytes(range(256)) * 4}
    for name, data in contents.items():
        (tmp_path / name).write_bytes(data)
    huge = tmp_path / "huge"
    with open(huge, "wb") as f:         # more than 2 GiB, sparse
        f.truncate((1 << 31) + 12345)
        f.write(b"head")
        f.seek((1 << 31) + 12340)
        f.write(b"tail!")
    files = spark.createDataFrame([(str(tmp_path / n),) for n in [*contents, "huge", "absent"]] + [(None,)], "p string")
    got = {os.path.basename(r["path"]): r for r in walk.file_fingerprints(files, "p", 10).collect()}
    df = spark.createDataFrame([(n, bytearray(d), len(d)) for n, d in contents.items()], "n string, b binary, size bigint")
    for n, fp in df.select("n", content_fingerprint(F.col("b"), F.col("size"), 10)).collect():
        assert (got[n]["fingerprint"], got[n]["size_bytes"], got[n]["error"]) == (fp, len(contents[n]), None)
    assert got["huge"]["size_bytes"] == (1 << 31) + 12345
    assert got["huge"]["fingerprint"] == hashlib.sha256(b"head" + bytes(16) + bytes(5) + b"tail!").hexdigest()
    assert (got["absent"]["fingerprint"], got["absent"]["error"]) == (None, "FileNotFoundError")


def test_restore_drill(spark):
    root, path, target = (shared_path(spark, x) for x in ("backup", "table", "restored"))
    at = dt.datetime(2024, 1, 2, 3, 4, 5, 678901)
    schema = "id bigint, name string, at timestamp_ntz, ts timestamp, day date, n decimal(10,3), b binary, tags array<string>"
    data = [(1, 'quote " and\nline', at, at, at.date(), Decimal("1.250"), bytearray(b"\x00\xff"), ["x", None]), (2, None, None, None, None, None, None, None),
            (3, "", at, at, at.date(), Decimal("-0.001"), bytearray(), [])]
    spark.createDataFrame(data, schema).write.parquet(path)
    spark.range(5).write.parquet(f"{path}-other")
    out = M.export_all(spark, {"t": (path, ["id"]), "other": (f"{path}-other", ["id"]), "gone": (f"{path}-gone", ["id"])}, root)
    assert rows(out, "name", "rows", "error") == [("gone", None, "AnalysisException"), ("other", 5, None), ("t", 3, None)]
    assert out.filter("name = 'gone'").first()["message"]
    for _ in range(2):
        got = M.restore_all(spark, root, {"t": ["id"], "other": ["id"], "gone": ["id"]}, target)
        assert rows(got, "name", "rows") == [("gone", None), ("other", 5), ("t", 3)]
    back = spark.read.parquet(f"{target}/t")
    assert back.schema == spark.read.parquet(path).schema
    assert rows(back) == rows(spark.read.parquet(path))
    # a broken restore is continued, rows that are there stay as they are
    spark.createDataFrame([(2, "changed")], "id bigint, name string").join(back.drop("name").filter("id = 2"), "id").select(back.columns).write.mode(
        "overwrite").parquet(f"{target}2/t")
    M.restore_all(spark, root, {"t": ["id"]}, f"{target}2")
    assert rows(spark.read.parquet(f"{target}2/t"), "id", "name") == sorted([(1, 'quote " and\nline'), (2, "changed"), (3, "")], key=repr)
