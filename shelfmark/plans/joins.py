"""Join rows (J)."""

from pyspark.sql import functions as F

from shelfmark.functions import names as N
from shelfmark.operators import dictionary as D
from shelfmark.operators import joins as J
from shelfmark.operators.lanes import keep_ranked
from shelfmark.plans.bindings import CUSTOMER_GEO, customer_geo
from shelfmark.plans.columns import PART_TITLE, part_title
from shelfmark.plans.registry import query, table

c, lit = F.col, F.lit


@query("J1", "lookup_left_join", f"""with {CUSTOMER_GEO} select o_orderkey, o_custkey, city, nullif(case when district = 'NATION_3' then '' else district end, '') as district
  from orders left join (select * from cg where c_mktsegment <> 'FURNITURE') on o_custkey = c_custkey""")
def _(s, sf):
    geo = customer_geo(s, sf).filter(c("c_mktsegment") != "FURNITURE").withColumn(
        "district", F.when(c("district") == "NATION_3", "").otherwise(c("district")))
    o = table(s, sf, "orders").select("o_orderkey", "o_custkey")
    return J.lookup_left_join(o, "o_custkey", geo, "c_custkey", ["city", "district"], ["o_orderkey"])


@query("J2", "anti_join_unknown", """select source, min(doc_id) as sample, count(*) as rows from documents where doc_id not in (select doc_id from labels) group by 1""")
def _(s, sf):
    return J.unknown_names(table(s, sf, "documents"), "doc_id", table(s, sf, "labels"), "source", "doc_id")


EXCLUDED = """ex as (select c_custkey, case when c_mktsegment = 'BUILDING' then 'manual' when c_nationkey in (1, 2, 3) then 'table'
  when coalesce(n, 0) >= 3 then 'null-limit' else 'todo' end as reason from customer left join
  (select o_custkey, count(*) as n from orders where o_orderstatus = 'P' group by 1) on o_custkey = c_custkey)"""


def excluded(s, sf):
    cu = table(s, sf, "customer")
    nulls = table(s, sf, "orders").filter(c("o_orderstatus") == "P").groupBy(c("o_custkey").alias("c_custkey")).agg(
        F.count(lit(1)).alias("count"))
    return J.exclusion_reasons(cu.select("c_custkey"), "c_custkey", cu.filter(c("c_mktsegment") == "BUILDING"),
                               cu.filter(c("c_nationkey").isin(1, 2, 3)), nulls)


@query("J3", "multi_exclusion_todo", f"with {EXCLUDED} select c_custkey, reason from ex")
def _(s, sf):
    return excluded(s, sf)


@query("J3", "multi_exclusion_counts", f"with {EXCLUDED} select reason, count(*) as rows from ex group by 1")
def _(s, sf):
    return excluded(s, sf).groupBy("reason").agg(F.count(lit(1)).alias("rows"))


@query("J4", "semi_join_scope", "select c_custkey, c_name from customer where c_custkey in (select o_custkey from orders where o_totalprice > 450000)")
def _(s, sf):
    big = table(s, sf, "orders").filter(c("o_totalprice") > 450000).select(c("o_custkey").alias("c_custkey"))
    return table(s, sf, "customer").select("c_custkey", "c_name").join(big, "c_custkey", "left_semi")


@query("J5", "snapshot_diff", """with a as (select distinct l_orderkey as k from lineitem where l_returnflag = 'A'), b as (select distinct l_orderkey as k from lineitem where l_linestatus = 'O')
select coalesce(a.k, b.k) as k, case when a.k is null then 'new' when b.k is null then 'stale' else 'kept' end as status from a full join b on a.k = b.k""")
def _(s, sf):
    li = table(s, sf, "lineitem").select(c("l_orderkey").alias("k"), "l_returnflag", "l_linestatus")
    return J.snapshot_diff(li.filter(c("l_returnflag") == "A"), li.filter(c("l_linestatus") == "O"), ["k"])


@query("J6", "priority_override_merge", f"""with {CUSTOMER_GEO},
g as (select c_custkey as k, city, district, case when c_acctbal > 5000 then 'A1' end as area, c_acctbal > 5000 as auto_area from cg where c_mktsegment <> 'HOUSEHOLD'),
e as (select c_custkey as k, 'E' || city as city, district, 'EX' as area, false as auto_area, c_acctbal > 3000 as man from cg where c_mktsegment in ('HOUSEHOLD', 'MACHINERY')),
m as (select s_suppkey as k, 'M' as city, s_name as district, case when s_acctbal > 4000 then 'MA' end as area from supplier),
ad as (select o_custkey as k, case when min(o_totalprice) < 200000 then 'ADM' else '' end as city, 'D' as district, max(o_totalprice) > 480000 as nb from orders where o_orderpriority = '1-URGENT' group by 1),
j1 as (select coalesce(g.k, e.k) as k, case when e.k is not null and (g.k is null or e.man) then 'e' else 'g' end as w, g.city gc, g.district gd, g.area ga, g.auto_area gaa, e.city ec, e.district ed, e.area ea
  from g full join e on g.k = e.k),
j2 as (select k, case w when 'e' then ec else gc end as city, case w when 'e' then ed else gd end as district, case w when 'e' then ea else ga end as area, case w when 'e' then false else gaa end as aa from j1),
j3 as (select coalesce(j2.k, m.k) as k, case when m.k is not null then m.city else j2.city end as city, case when m.k is not null then m.district else j2.district end as district,
  case when m.k is null or (aa and m.area is null) then j2.area else m.area end as area from j2 full join m on j2.k = m.k),
j4 as (select coalesce(j3.k, ad.k) as k, j3.k as known, j3.city, j3.district, j3.area, ad.city as ac, ad.district as adi, coalesce(nb, false) as nb from j3 full join ad on j3.k = ad.k)
select k, case when nb then null when ac <> '' then ac else city end as city, case when nb then null when ac <> '' then adi else district end as district,
  case when nb then null else area end as area from j4 where known is not null or nb or ac <> ''""")
def _(s, sf):
    geo = customer_geo(s, sf).withColumnRenamed("c_custkey", "k")
    rich = c("c_acctbal") > 5000
    guess = geo.filter(c("c_mktsegment") != "HOUSEHOLD").select("k", "city", "district", F.when(rich, "A1").alias("area"), rich.alias("auto_area"))
    existing = geo.filter(c("c_mktsegment").isin("HOUSEHOLD", "MACHINERY")).select(
        "k", F.concat(lit("E"), c("city")).alias("city"), "district", lit("EX").alias("area"), lit(False).alias("auto_area"),
        (c("c_acctbal") > 3000).alias("manual"))
    manual = table(s, sf, "supplier").select(c("s_suppkey").alias("k"), lit("M").alias("city"), c("s_name").alias("district"),
                                             F.when(c("s_acctbal") > 4000, "MA").alias("area"))
    admin = table(s, sf, "orders").groupBy(c("o_custkey").alias("k"), c("o_orderpriority").alias("p")).agg(
        F.when(F.min("o_totalprice") < 200000, "ADM").otherwise("").alias("city"), lit("D").alias("district"),
        (F.max("o_totalprice") > 480000).alias("is_non_building"))
    admin = admin.withColumn("source", F.when(c("p") == "1-URGENT", "admin-ui").otherwise("import"))
    return J.override_merge(guess, existing, manual, admin, "k")


def script_tables(s, sf):
    p = table(s, sf, "part")
    case = (F.when(c("p_size") < 20, c("p_name")).when(c("p_size") < 30, F.replace(c("p_name"), lit(" "), lit("  ")))
            .when(c("p_size") < 40, F.concat(F.substring_index("p_name", " ", 1), lit("  "), F.left(F.substring_index("p_name", " ", -1), lit(2))))
            .otherwise(F.concat(c("p_name"), lit("_"), c("p_type"))))
    scripts = p.filter(c("p_type").isin("PROMO", "SMALL")).select(
        c("p_partkey").alias("script_id"), c("p_name").alias("folder"), F.concat_ws(" ", "p_name", "p_brand").alias("subfolder"),
        F.concat(c("p_name"), lit("_"), c("p_type"), lit(".docx")).alias("name"), c("p_size").alias("size"))
    return p.select(case.alias("case_name")), scripts


@query("J7", "tiered_match_join", r"""with ca as (select distinct case when p_size < 20 then p_name when p_size < 30 then replace(p_name, ' ', '  ')
    when p_size < 40 then split_part(p_name, ' ', 1) || '  ' || left(split_part(p_name, ' ', 2), 2) else p_name || '_' || p_type end as case_name from part),
cn as (select case_name, trim(regexp_replace(case_name, '\s+', ' ', 'g')) as n from ca),
sc as (select p_partkey as script_id, p_name as folder, p_name || ' ' || p_brand as subfolder, p_name || '_' || p_type || '.docx' as name, p_size as size from part where p_type in ('PROMO', 'SMALL')),
fo as (select script_id, size, folder as f from sc union select script_id, size, subfolder from sc),
ff as (select f, min(script_id) as first_id from fo group by 1),
t1 as (select case_name, 1 as tier, script_id, size from cn join fo on case_name = f),
t2 as (select case_name, 2 as tier, script_id, size from cn join fo on n = f where case_name not in (select case_name from t1)),
l3 as (select * from cn where case_name not in (select case_name from t1 union all select case_name from t2)),
n3 as (select case_name, arg_min(f, (first_id, f)) as f from l3 join ff on contains(f, n) or contains(n, f) group by 1),
t3 as (select case_name, 3 as tier, script_id, size from n3 join fo using (f)),
t4 as (select case_name, 4 as tier, script_id, size from l3 join sc on contains(name, n) where case_name not in (select case_name from t3)),
u as (select * from t1 union all select * from t2 union all select * from t3 union all select * from t4),
r as (select case_name, tier, script_id, row_number() over (partition by case_name order by size desc, script_id)::int as pick from u)
select * from r where pick <= 3""")
def _(s, sf):
    cases, scripts = script_tables(s, sf)
    return J.tiered_match(cases, "case_name", scripts, lambda x: N.normalize_case(x, "link"), "script_id", "folder", "subfolder",
                          "name", [F.desc("size"), F.asc("script_id")])


@query("J8", "fallback_vote_join", rf"""with {PART_TITLE}, nm as (select distinct title from pt),
h as (select title, trim(regexp_extract(title, '^([^_\-]*)', 1)) as head from nm),
b as (select *, trim(regexp_replace(head, '\s*part \d+\s*$', '')) as bare from h),
k as (select title, unnest([title, head, bare, regexp_extract(bare, '^([a-z]+)', 1)]) as key, unnest([1, 2, 3, 4]) as tier from b),
kk as (select key, min(tier) as t0 from k group by 1),
v as (select key, p_type as city, p_brand as district from kk join part on contains(p_name, lower(key)) and p_name not like '%gear' and length(key) >= 2
   qualify row_number() over (partition by key order by p_partkey) <= 20),
w as (select key, city, district, count(*) as n from v group by all),
ww as (select * from w qualify row_number() over (partition by key order by n desc, city, district) = 1)
select title, arg_min(city, tier) as city, arg_min(district, tier) as district from k join ww using (key) group by 1""")
def _(s, sf):
    p = table(s, sf, "part")
    names = p.select(part_title().alias("title")).distinct()
    cat = p.select("p_partkey", c("p_name").alias("case_name"), F.when(~c("p_name").like("%gear"), c("p_type")).alias("city"),
                   c("p_brand").alias("district"))
    keys = N.search_key_cascade(c("title"), r"\s*part \d+\s*$", "a-z")
    return D.fallback_vote(names, "title", keys, cat, "case_name", "p_partkey", "city", "district").select("title", "city", "district")


FOLD = "lower(regexp_replace({}, '\\s+', '', 'g'))"


def fold(x):
    return FOLD.format(x)


@query("J8", "resolve_location", rf"""with {PART_TITLE}, nm as (select distinct title from pt),
cat as (select p_partkey, p_name as case_name, p_type as city, p_brand as district from part where p_name not like '%gear'),
cur as (select p_name as case_name, max(p_type) as city, max(p_brand) as district, count(*) > 1 as nb from part where p_size = 50 group by 1),
man as (select p_name as case_name, min(p_type) as city, min(p_brand) as district from part where p_name like '%gear' group by 1),
s0 as (select title, 0 as stage, case when not nb then city end as city, case when not nb then district end as district from nm join cur on title = case_name),
s1 as (select title, 1 as stage, city, district from nm join man on title = case_name),
s2 as (select title, 2 as stage, city, district from nm join man on {fold("title")} = {fold("case_name")} where length({fold("title")}) >= 3),
h as (select title, trim(regexp_extract(title, '^([^_\-]*)', 1)) as head from nm),
b as (select *, trim(regexp_replace(head, '\s*part \d+\s*$', '')) as bare from h),
k as (select title, unnest([title, head, bare, regexp_extract(bare, '^([a-z]+)', 1)]) as key, unnest([1, 2, 3, 4]) as tier from b),
v as (select key, city, district from (select distinct key from k) join cat on contains(case_name, lower(key)) where length(key) >= 2
   qualify row_number() over (partition by key order by p_partkey) <= 20),
w as (select key, city, district from v group by 1, 2, 3 qualify row_number() over (partition by key order by count(*) desc, city, district) = 1),
s3 as (select title, 3 as stage, arg_min(city, tier) as city, arg_min(district, tier) as district from k join w using (key) group by 1),
loc as (select case_name, min((city, district)) as p from cat group by 1),
q4 as (select title, p[1] as city, p[2] as district from nm join loc on contains({fold("case_name")}, {fold("title")}) or contains({fold("title")}, {fold("case_name")})),
s4 as (select title, 4 as stage, city, district from q4 group by 1, 2, 3, 4 qualify row_number() over (partition by title order by count(*) desc, city, district) = 1),
q5 as (select title, city, district from nm join man on contains({fold("case_name")}, {fold("title")}) or contains({fold("title")}, {fold("case_name")})),
s5 as (select title, 5 as stage, city, district from q5 group by 1, 2, 3, 4 qualify row_number() over (partition by title order by count(*) desc, city, district) = 1),
u as (select * from s0 union all select * from s1 union all select * from s2 union all select * from s3 union all select * from s4 union all select * from s5),
f as (select * from u qualify row_number() over (partition by title order by stage) = 1)
select title, stage::int as stage, city, district from nm left join f using (title)""")
def _(s, sf):
    p = table(s, sf, "part")
    names = p.select(part_title().alias("title"))
    cat = p.select("p_partkey", c("p_name").alias("case_name"), F.when(~c("p_name").like("%gear"), c("p_type")).alias("city"),
                   c("p_brand").alias("district"))
    curated = p.filter(c("p_size") == 50).groupBy(c("p_name").alias("case_name")).agg(
        F.max("p_type").alias("city"), F.max("p_brand").alias("district"), (F.count(lit(1)) > 1).alias("is_non_building"))
    manual = p.filter(c("p_name").like("%gear")).groupBy(c("p_name").alias("case_name")).agg(
        F.min("p_type").alias("city"), F.min("p_brand").alias("district"))
    keys = N.search_key_cascade(c("title"), r"\s*part \d+\s*$", "a-z")
    return D.resolve_location(names, "title", keys, curated, manual, cat, "case_name", "p_partkey", "city", "district")


RULES = [("thwhst", "W", "x/y"), ("reth", "R", "n"), ("ounder the", "U", "z"), ("eaux", "F", "a/b"), ("ing", "G", "")]
RULES_SQL = "ru(ord, kw, v1, v2) as (values " + ", ".join(f"({i}, '{k}', '{a}', '{b}')" for i, (k, a, b) in enumerate(RULES)) + ")"


@query("J9", "keyword_theta_join", f"""with {RULES_SQL} select doc_id, arg_min(kw, ord) as keyword, arg_min(v1, ord) as city, arg_min(v2, ord) as district
from documents left join ru on contains(text, kw) group by doc_id""")
def _(s, sf):
    hit = D.first_keyword(c("text"), RULES, 2)
    return table(s, sf, "documents").select("doc_id", hit["keyword"].alias("keyword"), hit["v1"].alias("city"), hit["v2"].alias("district"))


@query("J9", "keyword_dictionary_join", """with d as (select p_partkey as ord, p_type as v1, case when p_size < 10 then split_part(p_name, ' ', 2) else p_name end as kw from part where p_size < 12),
u as (select kw, min(ord) as ord, arg_min(v1, ord) as v1 from d group by 1),
o as (select distinct p_name || '_' || p_type as title from part)
select title, arg_min(kw, ord) as kw, arg_min(v1, ord) as city from o join u on contains(title, kw) group by 1""")
def _(s, sf):
    p = table(s, sf, "part")
    kw = F.when(c("p_size") < 10, F.substring_index("p_name", " ", -1)).otherwise(c("p_name"))
    rules = keep_ranked(p.filter(c("p_size") < 12).select(kw.alias("kw"), c("p_partkey").alias("ord"), c("p_type").alias("city")),
                        ["kw"], [F.asc("ord")])
    names = p.select(F.concat_ws("_", "p_name", "p_type").alias("title"))
    return D.first_keyword_join(names, "title", rules, "kw", "ord", ["city"])


@query("J9", "document_dictionary_join", """with w as (select w as kw, min(doc_id) as ord from (select doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Z][a-zé]{7,}')) as w from documents) group by 1),
h as (select doc_id, kw, ord from documents join w on contains(text, kw))
select doc_id, arg_min(kw, (ord, kw)) as keyword, count(*) as keywords from h group by 1""")
def _(s, sf):
    d = table(s, sf, "documents").select("doc_id", "text")
    found = d.select("doc_id", F.explode(F.regexp_extract_all("text", lit("[A-Z][a-zé]{7,}"), lit(0))).alias("kw"))
    terms = found.groupBy("kw").agg(F.min("doc_id").alias("ord"))
    pairs = D.contained_terms(d, "doc_id", "text", terms, "kw").select("doc_id", "kw").distinct().join(terms, "kw")
    return pairs.groupBy("doc_id").agg(F.min_by("kw", F.struct("ord", "kw")).alias("keyword"), F.count(lit(1)).alias("keywords"))


@query("J9", "gazetteer_match", """select doc_id, case when contains(text, 'ounder') then 'under' when contains(text, 'then') then 'then' when contains(text, 'thanen') then 'north'
   when contains(text, 'eaux') then 'sud' when contains(text, 'steinsch') then 'berg' end as city,
  case when contains(text, 'ounder') then '' when contains(text, 'then') then case when contains(text, 'ingness') then 'ingness' when contains(text, 'tioned') then 'tioned' when contains(text, 'est') then 'est' else '' end
   when contains(text, 'thanen') then 'thanen' when contains(text, 'eaux') then 'eaux' when contains(text, 'steinsch') then 'stein' end as district from documents""")
def _(s, sf):
    hit = D.gazetteer_match(c("text"), ["then", "ounder"], {"ounder": "under"}, {"then": ["est", "tioned", "ingness"]},
                            {"thanen": "north", "eaux": "sud"}, {"steinsch": ("berg", "stein")})
    return table(s, sf, "documents").select("doc_id", hit["city"].alias("city"), hit["district"].alias("district"))


@query("J10", "journal_reconcile", """select event_id, case when event_type = 'error' then 'disk-missing' when o_orderkey is null then 'row-missing'
  when o_orderpriority = '5-LOW' then 'already-new' else 'patched' end as status from events left join orders on event_id * 2 = o_orderkey""")
def _(s, sf):
    j = table(s, sf, "events").select("event_id", (c("event_id") * 2).alias("fid"), lit("5-LOW").alias("new_path"), "event_type")
    return J.journal_reconcile(j, "fid", "new_path", c("event_type") != "error", table(s, sf, "orders"), "o_orderkey",
                               "o_orderpriority").select("event_id", "status")


@query("J11", "conflict_merge_preserve", """with r as (select p_partkey as old, case when p_size = 49 then p_partkey + 1000000 else p_partkey + 1 end as new from part where p_size >= 49),
cat as (select p_partkey as key, list_concat(string_split(p_name, ' '), [p_type]) as tags, coalesce(new, p_partkey) as k, old from part left join r on old = p_partkey),
x as (select distinct k, unnest(list_filter(tags, lambda t: t in ('red', 'PROMO', 'ring'))) as t from cat),
f as (select * from cat qualify row_number() over (partition by k order by old is not null, key) = 1)
select f.k as key, array_to_string(list_sort(list_distinct(list_concat(any_value(tags), coalesce(list(t) filter (where t is not null), [])))), ',') as tags
from f left join x using (k) group by f.k""")
def _(s, sf):
    p = table(s, sf, "part")
    cat = p.select(c("p_partkey").alias("key"), F.array_append(F.split("p_name", " "), c("p_type")).alias("tags"))
    new = F.when(c("p_size") == 49, c("p_partkey") + 1000000).otherwise(c("p_partkey") + 1)
    ren = p.filter(c("p_size") >= 49).select(c("p_partkey").alias("key"), new.alias("new_key"))
    return J.apply_renames(cat, "key", "tags", ren, ["red", "PROMO", "ring"]).withColumn("tags", F.array_join("tags", ","))


@query("J11", "upsert_preserve_tags", """select p_partkey as key, array_to_string(list_sort(list_distinct(list_concat([p_type, 'new'],
  list_filter(string_split(p_name, ' '), lambda t: t in ('red', 'ring'))))), ',') as tags from part""")
def _(s, sf):
    p = table(s, sf, "part")
    new = p.select(c("p_partkey").alias("key"), F.array(c("p_type"), lit("new")).alias("tags"))
    old = p.select(c("p_partkey").alias("key"), F.split("p_name", " ").alias("tags"))
    return J.preserve_tags(new, old, "key", "tags", ["red", "ring"]).withColumn("tags", F.array_join("tags", ","))


@query("J12", "mismatch_detect", """with e(st, want) as (values ('F', '1-URGENT'), ('O', null), ('P', '2-HIGH'))
select o_orderstatus as st, count(distinct o_custkey) as cases, count(*) as rows from orders join e on st = o_orderstatus
where nullif(case when o_orderpriority = '5-LOW' then '' else o_orderpriority end, '') is distinct from want group by 1""")
def _(s, sf):
    e = s.createDataFrame([("F", "1-URGENT"), ("O", None), ("P", "2-HIGH")], "st string, prio string")
    o = table(s, sf, "orders").select("o_orderkey", c("o_orderstatus").alias("st"), "o_custkey", F.when(
        c("o_orderpriority") == "5-LOW", "").otherwise(c("o_orderpriority")).alias("prio"))
    return J.mismatches(o, "st", e, ["prio"], ["o_orderkey"]).groupBy("st").agg(F.count_distinct("o_custkey").alias("cases"), F.count(lit(1)).alias("rows"))


def folder_tree(s, sf):
    r = table(s, sf, "region").select(F.concat(lit("r"), c("r_regionkey").cast("string")).alias("folder_id"), c("r_name").alias("name"), lit("root").alias("parent_id"))
    n = table(s, sf, "nation").select(F.concat(lit("n"), c("n_nationkey").cast("string")).alias("folder_id"), c("n_name").alias("name"),
                                      F.concat(lit("r"), c("n_regionkey").cast("string")).alias("parent_id"))
    cu = table(s, sf, "customer").select(F.concat(lit("c"), c("c_custkey").cast("string")).alias("folder_id"), c("c_mktsegment").alias("name"),
                                         F.concat(lit("n"), c("c_nationkey").cast("string")).alias("parent_id"))
    return r.unionByName(n).unionByName(cu)


@query("J13", "ancestor_lookup", f"""with {CUSTOMER_GEO} select o_orderkey, c_mktsegment || '/' || district || '/' || city as chain from orders join cg on o_custkey = c_custkey""")
def _(s, sf):
    chains = J.ancestor_chains(folder_tree(s, sf), 5)
    o = table(s, sf, "orders").select("o_orderkey", F.concat(lit("c"), c("o_custkey").cast("string")).alias("parent"))
    found = o.join(chains, c("parent") == c("folder_id"), "left")
    return found.select("o_orderkey", F.array_join("chain", "/").alias("chain"))


@query("J13", "output_case_lookup", f"""with {CUSTOMER_GEO} select o_orderkey, district as case_name from orders join cg on o_custkey = c_custkey where c_mktsegment = 'MACHINERY'""")
def _(s, sf):
    o = table(s, sf, "orders").select("o_orderkey", F.concat(lit("c"), c("o_custkey").cast("string")).alias("parent"))
    return J.output_case(o, "parent", folder_tree(s, sf), "MACHINERY", ["o_orderkey"]).select("o_orderkey", "case_name")


@query("J14", "place_area_check", """select p_partkey, case when contains(p_name, 'ring') then 'PROMO' when contains(p_name, 'bolt') then 'SMALL' end as place_city,
  coalesce(not (case when contains(p_name, 'ring') then 'PROMO' when contains(p_name, 'bolt') then 'SMALL' end in (p_type, 'SMALL')), false) as rejected from part""")
def _(s, sf):
    city = D.first_keyword(c("p_name"), [("ring", "PROMO"), ("bolt", "SMALL")], 1)["v1"]
    out = city.isNotNull() & ~F.array_contains(F.array(c("p_type"), lit("SMALL")), city)
    return table(s, sf, "part").select("p_partkey", city.alias("place_city"), F.coalesce(out, lit(False)).alias("rejected"))


@query("J15", "duplicate_row_path_match", """select doc_id, min(doc_id) over (partition by md5(text)) as keeper, count(*) over (partition by md5(text)) as copies,
  doc_id <> min(doc_id) over (partition by md5(text)) as row_only from documents""")
def _(s, sf):
    d = table(s, sf, "documents").select("doc_id", F.md5("text").alias("canonical"))
    return J.same_path_rows(d, "doc_id", "canonical").select("doc_id", "keeper", "copies", "row_only")


APPROVALS = """pe as (select user_id as token, min(ts) as created_at from events where event_type = 'signup' and value > 80 group by 1),
ac as (select user_id as token, case event_type when 'purchase' then 'confirm' else 'cancel' end as action, ts as tm, event_id as seq from events where event_type = 'purchase' or (event_type = 'error' and value > 60)),
fi as (select token, min((tm, seq)) as f from ac join pe using (token) where tm >= created_at group by 1),
oc as (select ac.token, action, seq, case when pe.token is null then 'unknown-token' when f is null or (tm, seq) <> f then 'no-pending' when action = 'cancel' then 'cancelled'
   when epoch_us(tm) - epoch_us(created_at) > 7 * 86400000000 then 'expired' else 'executed' end as outcome
  from ac left join pe on ac.token = pe.token left join fi on ac.token = fi.token)"""


def approval_tables(s, sf):
    e = table(s, sf, "events")
    pend = e.filter((c("event_type") == "signup") & (c("value") > 80)).groupBy(c("user_id").alias("token")).agg(F.min("ts").alias("created_at"))
    act = e.filter((c("event_type") == "purchase") | ((c("event_type") == "error") & (c("value") > 60))).select(
        c("user_id").alias("token"), F.when(c("event_type") == "purchase", "confirm").otherwise("cancel").alias("action"),
        c("ts").alias("at"), c("event_id").alias("seq"))
    ids = e.filter(c("event_type") == "view").select(c("user_id").alias("token"), c("event_id").alias("id"))
    return pend, act, ids


@query("J16", "approval_join", f"with {APPROVALS} select token, action, seq, outcome from oc")
def _(s, sf):
    pend, act, _ids = approval_tables(s, sf)
    return J.approvals(pend, act).select("token", "action", "seq", "outcome")


@query("J16", "approval_execute", f"""with {APPROVALS}, ids as (select user_id as token, event_id, row_number() over (partition by user_id order by event_id) as rn from events where event_type = 'view')
select token, count(*) filter (where rn <= 5) as executed, count(*) filter (where rn > 5) as remaining from ids where token in (select token from oc where outcome = 'executed') group by 1""")
def _(s, sf):
    pend, act, ids = approval_tables(s, sf)
    return J.approved_deletes(ids, J.approvals(pend, act), cap=5).groupBy("token").agg(
        F.count_if("execute").alias("executed"), F.count_if(~c("execute")).alias("remaining"))
