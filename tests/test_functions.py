import datetime as dt
import hashlib
import zlib

from pyspark.sql import functions as F

from shelfmark.functions import entries as E
from shelfmark.functions import names as N
from shelfmark.functions import paths as P
from shelfmark.functions import text as X
from shelfmark.functions import values as V
from shelfmark.operators import predicates as R

HAN = r"\u4e00-\u9fff"


def test_synthetic_id_depends_on_volume(ev):
    sha = lambda k: "nas:" + hashlib.sha1(k.encode()).hexdigest()[:16]
    assert ev(lambda c: P.synthetic_id(c, F.lit("v1")), ["a/影片.mp4"]) == [sha("a/影片.mp4")]
    assert ev(lambda c: P.synthetic_id(c, F.lit("v2")), ["a/影片.mp4"]) == [sha("v2/a/影片.mp4")]


def test_path_translate_edges(ev):
    roots = [{"volume": "v1", "prefixes": {"linux": "/vol/homes", "win": "Y:\\home\\"}},
             {"volume": "v2", "prefixes": {"linux": "/vol/homes2", "win": "Z:/home"}}]
    got = ev(lambda c: P.path_translate(c, roots, "linux"),
             ["y:\\HOME\\a\\b.mp4", "/vol/homes2/x/", "/vol/homes", "/vol/homesX/a", "", None])
    assert [g and tuple(g) for g in got] == [
        ("v1", "a/b.mp4", "/vol/homes/a/b.mp4"), ("v2", "x", "/vol/homes2/x"), ("v1", "", "/vol/homes/"), None, None, None]


def test_parse_ordered_name(ev):
    got = ev(P.parse_ordered_name, ["2_甲", "03 Name ", "12", "Name", "7_"])
    # a pure number splits into its leading digits and the last one, as the pattern demands
    assert [tuple(g) for g in got] == [(2, "甲"), (3, "Name"), (1, "2"), (None, "Name"), (7, "_")]


def test_parse_mmdd_prefix(ev):
    got = ev(lambda c: P.parse_mmdd_prefix(c, F.lit(2026)), ["0421海風", "0230 x", "1301 x", "0000x", "0101", "x0101y"])
    assert [tuple(g) for g in got] == [
        (dt.date(2026, 4, 21), "海風"), (None, "x"), (None, "1301 x"), (None, "0000x"), (None, "0101"), (None, "x0101y")]


def test_extract_version(ev):
    got = ev(P.extract_version, ["a.mp4", "a V2.MP4", "a  v10 b.mov", "a V2 V3.mp4", "aV2.mp4", "x V2_送稿.mp4", "noext V4", "a.b V2.mp4"])
    assert [tuple(g) for g in got] == [
        ("a", 1, "mp4"), ("a", 2, "mp4"), ("a b", 10, "mov"), ("a V2", 3, "mp4"), ("aV2", 1, "mp4"), ("x V2_送稿", 1, "mp4"),
        ("noext", 4, ""), ("a.b", 2, "mp4")]


def test_case_name_skips_layers(spark):
    df = spark.createDataFrame([("0_專案", "成品//北部/案甲/x"), ("案乙", "a"), ("0_專案", ""), ("0_專案", None)], "f string, s string")
    got = df.select(P.derive_case_name(F.col("f"), F.col("s"), ["0_專案", "北部"], ["成品"]).alias("n")).collect()
    assert [r.n for r in got] == ["案甲", "案乙", "0_專案", "0_專案"]


def test_category_override_then_first_rule(spark):
    df = spark.createDataFrame([("風景", "x/raw"), ("ch", "a/Drone/A cam"), ("ch", "CAM/b"), ("ch", "none")], "c string, p string")
    rules = [("drone", "aerial"), ("cam", "tape")]
    got = df.select(P.derive_category(F.col("c"), F.col("p"), {"風景": "view"}, rules, "tape?").alias("n")).collect()
    assert [r.n for r in got] == ["view", "aerial", "tape", "tape?"]


def test_derive_tags_sorted_distinct(spark):
    df = spark.createDataFrame([("成品/ 北部 /b//b", "案", "頻", "f.x.mp4"), (None, "", None, ".mp4")], "s string, c string, h string, n string")
    got = df.select(P.derive_tags(F.col("s"), F.col("c"), F.col("h"), F.col("n"), ["北部"], ["成品"]).alias("t")).collect()
    assert got[0].t == sorted(["b", "案", "頻", "f.x"]) and got[1].t == []


def test_safe_path_and_rename(ev, spark):
    assert ev(P.safe_path_reason, [None, "", "/a", "a//b", "a/../b", "./a", "a\u0000b", "a/b.mp4"]) == [
        "no-path", "no-path", "absolute-path", "dot-segment", "dot-segment",
        "dot-segment", "nul-in-path", None]
    df = spark.createDataFrame([("d/IMG.MOV", " 中正/國中 "), ("d/.hidden", "x"), ("a_x.mp4", "x"), ("a.mp4", ".."), ("a.mp4", None)],
                               "p string, w string")
    got = [r.r for r in df.select(P.derive_rename(F.col("p"), F.col("w"), F.lit("v1")).alias("r")).collect()]
    assert [(g.status, g.reason, g.new_rel_path) for g in got] == [
        ("rename", None, "d/IMG_中正_國中.MOV"), ("rename", None, "d/.hidden_x"), ("already", None, "a_x_x.mp4"),
        ("invalid", "no-usable-place", None), ("invalid", "no-place", None)]


def test_sanitize(ev):
    assert ev(P.sanitize_place, [" a/b\\c ", "..", " / ", ""]) == ["a_b_c", "", "_", ""]
    assert ev(P.sanitize_tag, [' a/b:c*"<>|? ', "x" * 40]) == ["abc", "x" * 30]


def test_normalize_city_and_district(ev):
    assert ev(lambda c: N.normalize_city(c, {"臺": "台"}, "市縣"), ["臺北市", " 新竹縣 ", "市", "", None]) == ["台北", "新竹", None, None, None]
    keep = ["北區", "東區"]
    assert ev(lambda c: N.normalize_district(c, "區鎮鄉市", keep), ["松山區", "北區", "松山區, 東區,", " ", None]) == [
        "松山", "北區", "松山,東區", None, None]


def test_detect_labels_first_seen(spark):
    df = spark.createDataFrame([("案七期14期", "河濱/7期"), (None, "x")], "a string, b string")
    labels = {"7": "七期", "14": "十四期", "七": "七期"}
    got = df.select(N.detect_labels([F.col("a"), F.col("b")], "(14|七|7)期", labels, ["河濱"]).alias("l")).collect()
    assert [r.l for r in got] == ["七期 十四期 河濱", None]


def test_clean_title(ev):
    clean = lambda c: N.clean_title(c, ["Nora", "Zoe"], ["短影", "雙機"], ["即賞屋", "雙機"])
    assert ev(clean, ["Nora 4/21 海風短影 雙機", "0422 星河灣 (林)\n下載連結", "甲案 - 即賞屋雙機", "甲*3", "", None]) == [
        "海風", "星河灣", "甲案", "甲", "", None]


def test_search_key_cascade(ev):
    part = r"\s*第[一二三四五六七八九十百\d]+(篇|段|集)\s*$"
    got = ev(lambda c: N.search_key_cascade(c, part, HAN), ["青山樂章第二篇", "星河灣_直式", "案", "", "好案abc"])
    assert got == [["青山樂章第二篇", "青山樂章"], ["星河灣_直式", "星河灣"], ["案"], [], ["好案abc", "好案"]]


def test_editor_tags(ev):
    assert ev(lambda c: N.editor_tag(c, ["林", "王"]), ["案（王林）", "案(王)", "案", None, "(x)(王)"]) == ["林", "王", None, None, None]
    assert ev(N.remove_editor_tag, ["案 （王）", "a (x) b (y) "]) == ["案", "a (x) b"]
    got = ev(N.parse_schedule_entry, ["4/8海風-A(王)", "海風 (x) y"])
    assert [tuple(g) for g in got] == [("海風-A", "王"), ("海風 (x) y", None)]


def test_is_non_case(ev):
    pats = ["vlog", r"^99_", "拍帶$"]
    got = ev(lambda c: N.is_non_case(c, pats, "路街"), [None, "a", "1234案", "1234中正路", "my VLOG", "好案", "x拍帶"])
    assert got == [True, True, True, False, True, False, True]


def test_place_suffix_and_script(ev):
    assert ev(lambda c: N.has_place_suffix(c, HAN), ["IMG_1010_中正.MOV", "IMG_10.中_文", "中正.mov"]) == [True, False, False]
    assert ev(lambda c: N.has_script_chars(c, HAN), ["abc", "a中"]) == [False, True]


def test_similarity_accept(spark):
    df = spark.createDataFrame([("海風-A", "海風a棟"), ("abc", "xyz"), ("abcde", "abcxy"), ("[甲]", "甲乙")], "a string, b string")
    got = df.select(N.name_similarity_accept(F.col("a"), F.col("b")).alias("y")).collect()
    assert [r.y for r in got] == [True, False, True, True]


def test_append_tokens_original_vs_sequential(spark):
    df = spark.createDataFrame([("x 台北", "台北", "松山"), ("", "台北", None)], "t string, c string, d string")
    pair = F.concat_ws(" ", "c", "d")
    got = df.select(X.append_missing_tokens(F.col("t"), [F.col("c"), F.col("d"), pair]).alias("a"),
                    X.append_missing_tokens(F.col("t"), [F.col("c"), F.col("d"), pair], True).alias("b")).collect()
    assert (got[0].a, got[0].b) == ("x 台北 松山 台北 松山", "x 台北 松山")
    assert (got[1].a, got[1].b) == ("台北 台北", "台北")


def test_remove_token(ev):
    assert ev(lambda c: X.remove_token(c, F.lit("ab")), ["x ab y", "ab x", "cabd", "ab"]) == ["x y", "x", "cd", ""]
    assert ev(lambda c: X.remove_token(c, F.lit("ab"), True), ["x ab cab"]) == ["x cab"]


def test_trigram_similarity(spark):
    df = spark.createDataFrame([("word", "two words"), ("same", "same"), ("", ""), ("青山樂章", "青山"), ("é a", "é")], "a string, b string")
    got = [round(r.y, 4) for r in df.select(X.trigram_similarity(F.col("a"), F.col("b")).alias("y")).collect()]
    # han: {"  青"," 青山","青山如","山樂藝","樂章 "} and {"  青"," 青山","青山 "} share two of six
    assert got == [0.3636, 1.0, 0.0, 0.3333, 0.5]


def test_vicinity_and_truncate(ev):
    text = "x" * 10 + "林口" + "y" * 400 + "NAME" + "z" * 10 + "板橋"
    assert ev(lambda c: X.token_vicinity_find(c, "name", ["林口", "板橋"]), [text, "none"]) == ["板橋", None]
    assert ev(lambda c: X.truncate_with_marker(c, 3), [None, "abc", "abcd"]) == ["", "abc", "abc...<truncated>"]


def test_values(spark, ev):
    df = spark.createDataFrame([(1, 2, 90, True, None), (1, 2, 0, True, None), (1, 2, 0, False, None), (1, 2, 0, True, "x")],
                               "w bigint, h bigint, r int, s boolean, e string")
    got = df.select(V.rotation_swap(F.col("w"), F.col("h"), F.col("r"), F.col("s"), F.col("e")).alias("d")).collect()
    assert [r.d and tuple(r.d) for r in got] == [(2, 1), (1, 2), (0, 0), None]
    assert ev(lambda c: V.codec_normalize(c, {"avc1": "h264"}), [" AVC1", "ProRes", "", None]) == ["h264", "prores", "UNKNOWN", "UNKNOWN"]
    assert ev(lambda c: V.is_date_cell(c), [" 4/21 ", "4/21（一）", "4/21 long text", "421", None]) == [True, True, False, False, False]
    assert ev(lambda c: V.short_flag(c, F.lit(30.0)), [89, 90, 0, None], "int") == [True, False, None, None]
    sq = spark.createDataFrame([(1, 2), (2, 1), (2, 2), (None, 1)], "w int, h int")
    assert [r.y for r in sq.select(V.is_vertical(F.col("w"), F.col("h")).alias("y")).collect()] == [True, False, None, None]


def test_fingerprint_samples_or_whole(ev):
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    long = "".join(chr(65 + i % 26) for i in range(31))
    mid = 31 // 2 - 5 // 2
    assert ev(lambda c: V.content_fingerprint(c, F.length(c), 5), ["short", long]) == [
        sha("short"), sha(long[:5] + long[mid:mid + 5] + long[-5:])]


def test_gates(spark):
    df = spark.createDataFrame([(0.85, "林口", 1), (0.84, "林口", 1), (0.9, "", 1), (0.9, "十二個字的地名十二個字的", 1), (0.9, "十三個字的地名十三個字的名", 1),
                                (0.9, "a/b", 1), (0.9, "林口", 2), (None, "林口", 1)], "c double, p string, n int")
    got = [r.y for r in df.select(V.auto_apply_reason(F.col("c"), F.col("p"), F.lit(False), F.col("n")).alias("y")).collect()]
    assert got == ["ok", "unsure", "no-place", "ok", "long-place", "odd-place",
                   "many-cities", "unsure"]
    st = spark.createDataFrame([(0.70, "x", None), (0.69, "x", None), (0.9, "", None), (0.9, "x", "桃園"), (0.9, "x", "台北")], "c double, p string, pc string")
    t = F.lit(True)
    got = [r.y for r in st.select(V.model_status(F.lit(False), t, t, t, t, F.col("p"), F.col("c"), F.col("pc"), F.array(F.lit("台北"))).alias("y")).collect()]
    assert got == ["tag", "low-conf", "low-conf", "out-of-area", "tag"]


def test_noisy_json_and_entries(ev, spark):
    texts = ['ok ```json\n{"a": 1}\n``` {x}', 'pre {"a": 2} post', "nothing", '{"a": ']
    assert [g and g["a"] for g in ev(lambda c: V.json_from_noisy_text(c, "a bigint"), texts)] == [1, 2, None, None]
    got = ev(lambda c: E.validate_entry(c, F.lit(None).cast("string"), ["台北"], "auto"), ["台北", "火星", "", None])
    assert [g and (g.city, g.district, g.stamp) for g in got] == [("台北", "", "auto"), None, None, None]
    got = ev(lambda c: E.resolve_dataset(c, ["台北"], {"林口": "新北"}, ["區"]), ["台北", "林口", "林口區", "x"])
    assert [g and tuple(g) for g in got] == [("台北", None), ("新北", "林口"), ("新北", "林口"), None]


def test_verdict_and_iso(ev):
    v = lambda c: V.verdict_by_tags(c, ["done"], ["h"], ["n"], "yes", "no")
    assert ev(v, [None, [], ["done", "h"], ["n", "h"], ["n"], ["x"]], "array<string>") == [None, None, None, "yes", "no", None]
    got = ev(lambda c: F.unix_seconds(V.parse_iso_ts(c)), ["2024-01-01T00:00:00Z", "2024-01-01T02:00:00+02:00", "bad", None])
    assert got == [1704067200, 1704067200, None, None]


def test_full_width_blanks_count_as_white_space(ev):
    assert ev(P.strip, ["\u3000案\u3000甲\u00a0", "\t x\n"]) == ["案\u3000甲", "x"]
    assert ev(N.normalize_for_match, ["海\u3000風 A"]) == ["海風a"]
    assert ev(lambda c: N.normalize_case(c, "link"), ["海\u3000\u3000風 ( 3 - x"]) == ["海 風"]


def test_leading_words_go_once_and_in_order(ev):
    clean = lambda c: N.clean_title(c, ["Nora", "Zoe外", "Zoe"], [], [])
    assert ev(clean, ["Nora_Zoe外、案", "Zoe Nora 案", "NoraNora 案", "Zoe外案"]) == ["案", "Nora 案", "Nora 案", "案"]


def test_version_after_a_full_width_blank(ev):
    from shelfmark.functions.paths import extract_version
    got = ev(lambda c: extract_version(c), ["case\u3000V2", "case\u00a0v3"])
    plain = ev(lambda c: extract_version(c), ["case V2", "case v3"])
    assert got[:2] == plain


def test_shard_is_the_crc32_of_the_key_as_text(spark):
    got = spark.range(500).withColumn("shard", R.shard_of(F.col("id"), 7)).collect()
    assert [r.shard for r in got] == [zlib.crc32(str(r.id).encode()) % 7 for r in got]


def test_full_width_digits_are_digits(ev):
    from shelfmark.functions import values as V
    from shelfmark.functions.names import clean_title
    got = ev(P.extract_version, ["案名 V２.mp4", "案名 Ｖ2.mp4", "x v１０ y.mov", "x V٣.mov", "x V２a.mov"])
    assert [(g.base, g.version) for g in got] == [("案名", 2), ("案名 Ｖ2", 1), ("x y", 10), ("x", 3), ("x V２a", 1)]
    assert ev(V.is_date_cell, ["１/２", "１２/３１", "1/2", "x/1"]) == [True, True, True, False]
    plain, wide = ev(lambda c: clean_title(c, [], [], []), ["3/4 1203 海風"]), ev(lambda c: clean_title(c, [], [], []), ["３/４ １２０３ 海風"])
    assert plain == wide
