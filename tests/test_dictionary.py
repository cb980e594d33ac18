import random

from pyspark.sql import functions as F

from conftest import rows
from shelfmark.functions import names as N
from shelfmark.operators import dictionary as D


def test_containment_pairs_is_exact(spark):
    rnd = random.Random(3)
    word = lambda lo, hi: "".join(rnd.choice("ab中 ") for _ in range(rnd.randint(lo, hi)))
    texts = {word(0, 40) for _ in range(200)} | {""}
    terms = {word(1, 12) for _ in range(150)} | {""}
    t = spark.createDataFrame([(x,) for x in texts], "t string")
    k = spark.createDataFrame([(x,) for x in terms], "k string")
    got = set(rows(D.containment_pairs(t, "t", k, "k", gram=4)))
    assert got == {(a, b) for a in texts for b in terms if b and b in a}


def test_first_keyword_order_beats_position(spark, ev):
    rules = spark.createDataFrame([(1, "林口", "新北"), (0, "口", "x"), (2, "台北", "台北")], "ord int, kw string, city string")
    names = spark.createDataFrame([("台北林口案",), ("台北案",), ("無",)], "n string")
    assert rows(D.first_keyword_join(names, "n", rules, "kw", "ord", ["city"])) == [("台北林口案", "口", "x"), ("台北案", "台北", "台北")]
    got = ev(lambda c: D.first_keyword(c, [("林口", "新北"), ("林", "y")], 1), ["台北林口", "林x", "無"])
    assert [g and g.v1 for g in got] == ["新北", "y", None]


def test_gazetteer(ev):
    def place(c):
        return D.gazetteer_match(c, ["台北", "新北", "臺北市"], {"臺北市": "台北"}, {"台北": ["大安", "大安森"], "新北": ["林口"]},
                                 {"林口": "新北"}, {"星港灣": ("海城", "東渡")})
    got = ev(place, ["台北大安森林", "臺北市", "林口案", "台中星港灣", "無", "大安台北", "星港灣林口"])
    assert [g and tuple(g) for g in got] == [("台北", "大安森"), ("台北", ""), ("新北", "林口"), ("海城", "東渡"), None, ("台北", "大安"), ("新北", "林口")]


def test_progressive_prefix(spark):
    lookup = spark.createDataFrame([("海風", "林口"), ("海風莊", "八里"), ("安", "x")], "key string, value string")
    df = spark.createDataFrame([(1, "海風莊園"), (2, "海風x"), (3, "安樂"), (4, "在桃園林口台北新竹"), (5, None)], "id int, n string")
    got = D.progressive_prefix_lookup(df, "n", lookup, ["台北", "林口", "桃園", "新竹"], "台北", row_key=["id"])
    assert rows(got, "id", "found") == [(1, "八里"), (2, "林口"), (3, "台北"), (4, "台北,林口,桃園"), (5, "台北")]


PART = r"\s*第[一二三四五六七八九十百\d]+(篇|段|集)\s*$"


def keys(c):
    return N.search_key_cascade(c, PART, r"\u4e00-\u9fff")


def test_fallback_vote_first_key_decides(spark):
    catalog = spark.createDataFrame(
        [(1, "青山樂章A", "台北", "松山"), (2, "青山樂章B", "台北", None), (3, "青山樂章B", "台北", None), (4, "星河灣_直式", None, None),
         (5, "星河灣", "桃園", "x"), (6, "ABC莊", "台中", "y")], "id int, case string, city string, district string")
    names = spark.createDataFrame([("青山樂章第二篇",), ("星河灣_直式",), ("abc",), ("無此案",)], "n string")
    got = D.fallback_vote(names, "n", keys(F.col("n")), catalog, "case", "id", "city", "district")
    assert rows(got) == sorted([("青山樂章第二篇", 1, "台北", ""), ("星河灣_直式", 1, "桃園", "x"), ("abc", 0, "台中", "y")], key=repr)


def test_fallback_vote_counts_twenty_rows_per_key(spark):
    data = [(i, "案甲", "A" if i < 11 else "B", "") for i in range(40)]
    catalog = spark.createDataFrame(data, "id int, case string, city string, district string")
    names = spark.createDataFrame([("案甲",)], "n string")
    got = D.fallback_vote(names, "n", keys(F.col("n")), catalog, "case", "id", "city", "district")
    assert rows(got, "city") == [("A",)]        # 11 of the first 20 rows, although B leads overall


def test_resolve_location_order(spark):
    curated = spark.createDataFrame([("案一", "台北", None, False), ("案二", None, None, True), ("案三", "", None, False)],
                                    "case_name string, city string, district string, is_non_building boolean")
    manual = spark.createDataFrame([("案一", "X", "x"), ("案三", "桃園", "中壢"), ("Mansion 五", "台南", ""), ("長長案名六號", "嘉義", "z")],
                                   "case_name string, city string, district string")
    catalog = spark.createDataFrame([(1, "案四大樓", "新竹", None), (2, "Tower 七 A", "花蓮", "q")], "id int, case string, city string, district string")
    names = spark.createDataFrame([(n,) for n in ["案一", "案二", "案三", "案四大樓", "mansion五", "案名六號", "tower七a棟", "無"]], "n string")
    got = D.resolve_location(names, "n", keys(F.col("n")), curated, manual, catalog, "case", "id", "city", "district")
    assert {r.n: (r.stage, r.city, r.district) for r in got.collect()} == {
        "案一": (0, "台北", ""), "案二": (0, None, None), "案三": (1, "桃園", "中壢"), "mansion五": (2, "台南", ""), "案四大樓": (3, "新竹", ""),
        "tower七a棟": (4, "花蓮", "q"), "案名六號": (5, "嘉義", "z"), "無": (None, None, None)}


def test_render_batches(spark):
    df = spark.createDataFrame([(i, f"n{i}") for i in range(1, 6)], "rn bigint, n string")
    got = D.render_batches(df, "rn", F.concat_ws(" | ", "n", F.lit("ch")), 2, "extra")
    assert rows(got) == [(1, "1. n1 | ch\n2. n2 | ch\nextra"), (2, "1. n3 | ch\n2. n4 | ch\nextra"), (3, "1. n5 | ch\nextra")]


def test_blank_value_does_not_end_the_prefix_search(spark):
    from shelfmark.operators.dictionary import progressive_prefix_lookup
    names = spark.createDataFrame([("abcdef",), ("abzz",)], "name string")
    lookup = spark.createDataFrame([("abcd", None), ("abcde", " "), ("abc", "X")], "key string, value string")
    got = {r["name"]: r["found"] for r in progressive_prefix_lookup(names, "name", lookup, default="none", min_len=2).collect()}
    assert got == {"abcdef": "X", "abzz": "none"}


def test_contained_terms_finds_every_place(spark):
    rnd = random.Random(5)
    word = lambda lo, hi: "".join(rnd.choice("ab中 é") for _ in range(rnd.randint(lo, hi)))
    texts = [(i, word(0, 60)) for i in range(150)] + [(900, None), (901, ""), (902, "ab" * 40000 + "needle, 中é" + "ba" * 30000)]
    terms = {word(1, 14) for _ in range(80)} | {"", "needle, 中é", "never to be found", "中", "abab", "ababababababab"}
    t = spark.createDataFrame(texts, "i long, t string")
    k = spark.createDataFrame([(x,) for x in terms] + [(None,)], "k string")
    want = set()
    for i, text in texts:
        data = (text or "").encode()
        for term in filter(None, terms):
            if i == 902 and set(term) <= {"a", "b"}:
                continue        # tens of thousands of places
            at = data.find(term.encode())
            while at >= 0:
                want.add((i, term, at))
                at = data.find(term.encode(), at + 1)
    found = D.contained_terms(t, "i", "t", k, "k", gram=4)
    got = [tuple(r) for r in found.collect()]
    assert len(got) == len(set(got))
    assert {g for g in got if g[0] != 902 or set(g[1]) - {"a", "b"}} == want
    assert sum(g[:2] == (902, "abab") for g in got) == 39999 + 29998
    assert D.contained_terms(t, "i", "t", k.filter("k = ''"), "k").count() == 0


def test_no_text_travels_with_the_grams(spark):
    t = spark.createDataFrame([(1, "one two three")], "i long, t string")
    k = spark.createDataFrame([("two",)], "k string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = D.contained_terms(t, "i", "t", k, "k")._jdf.queryExecution().sparkPlan().toString()
        grams = [x for x in plan.split("\n") if "_gram" in x and ("Join" in x or "Exchange" in x)]
        assert grams and not any("_text" in x for x in grams)
        assert "BroadcastNestedLoop" not in plan and "Cartesian" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_first_term_join(spark):
    rules = spark.createDataFrame([(1, "林口", "新北"), (0, "口", "x"), (2, "台北", "台北")], "ord int, kw string, city string")
    texts = spark.createDataFrame([(1, "台北林口案" * 50), (2, "台北案"), (3, "無"), (4, None)], "i int, t string")
    assert rows(D.first_term_join(texts, "i", "t", rules, "kw", "ord", ["city"])) == [(1, "口", "x"), (2, "台北", "台北")]
