"""The combined catalog jobs over the part table."""

from pyspark.sql import functions as F

from shelfmark import catalog as G
from shelfmark.operators.dictionary import gazetteer_match
from shelfmark.operators.schedule import parse_schedule
from shelfmark.plans.bindings import CUSTOMER_GEO, customer_geo
from shelfmark.plans.columns import VERSIONED, versioned_name
from shelfmark.plans.registry import query, table
from shelfmark.plans.windows import SCHEDULE, order_grid
from shelfmark.session import shared_path, stage

c, lit = F.col, F.lit

RULES = G.NamingRules(layers=["0_layer"], stop_names=["raw", "Brand#7"], channel_categories={"PROMO": "promo"},
                      category_rules=[("old ", "archive"), ("RAW", "tape")], default_category="output", old_marker="prev")


def listing(s, sf):
    p = table(s, sf, "part")
    small = c("p_type") == "SMALL"
    return p.select(
        c("p_partkey").alias("seq"), F.concat(lit("f"), c("p_partkey").cast("string")).alias("drive_file_id"),
        F.when(c("p_brand").isin("Brand#1", "Brand#2"), "drive").otherwise("nas").alias("source"),
        F.concat(F.when(c("p_size") < 3, lit("1_")).otherwise(lit("2_")), c("p_type")).alias("channel_folder"),
        F.when(small, "0_layer").otherwise(c("p_name")).alias("case_folder"),
        F.when(small, F.concat_ws("/", lit("raw"), "p_name", "p_brand")).when(c("p_size") > 45, F.concat(c("p_brand"), lit("/ prev ")))
        .otherwise(c("p_brand")).alias("subpath"), versioned_name().alias("filename"), c("p_size").cast("bigint").alias("size_bytes"))


LISTING = f"""{VERSIONED},
li as (select p_partkey as seq, 'f' || p_partkey as drive_file_id, case when p_brand in ('Brand#1', 'Brand#2') then 'drive' else 'nas' end as source,
  case when p_size < 3 then '1_' else '2_' end || p_type as channel_folder, case when p_type = 'SMALL' then '0_layer' else p_name end as case_folder,
  case when p_type = 'SMALL' then 'raw/' || p_name || '/' || p_brand when p_size > 45 then p_brand || '/ prev ' else p_brand end as subpath,
  fname as filename, p_size::bigint as size_bytes, base, version, ext, p_name, p_type, p_brand, p_size from v),
re as (select *, left(channel_folder, 1)::bigint as channel_order, p_type as channel_name, p_name as case_name,
  case when p_type = 'PROMO' then 'promo' when contains(lower(channel_folder || '/' || case_folder || '/' || subpath || '/' || filename), 'old ') then 'archive'
    when contains(lower(channel_folder || '/' || case_folder || '/' || subpath || '/' || filename), 'raw') then 'tape' else 'output' end as category,
  p_type <> 'SMALL' and p_size > 45 as marked,
  list_sort(list_distinct(list_filter([p_name, p_type, p_brand, case when p_type <> 'SMALL' and p_size > 45 then 'prev' else '' end, regexp_replace(filename, '\\.[^.]*$', '')],
    lambda x: x <> '' and x <> 'Brand#7'))) as tags from li),
rf as (select *, marked or (source = 'nas' and category = 'output' and row_number() over (partition by source = 'nas' and category = 'output', channel_folder, case_folder, subpath, base, ext
  order by version desc, seq) > 1) as is_old from re)""".replace("\\\\", "\\")


@query("W1", "catalog_refined", f"""with {LISTING} select drive_file_id, channel_order, channel_name, case_name, category, is_old, array_to_string(tags, ',') as tags from rf""")
def _(s, sf):
    out = G.refine_listing(listing(s, sf), RULES)
    return out.select("drive_file_id", "channel_order", "channel_name", "case_name", "category", "is_old", F.array_join("tags", ",").alias("tags"))


def stored(s, sf, refined):
    """An earlier snapshot: refined parts with tags given by hand, and rows of files that are gone."""
    old = refined.filter(c("size_bytes") <= 40)
    old = old.withColumn("tags", F.array(c("channel_name"), F.when(c("size_bytes") > 20, "keep").otherwise("host"), lit("x")))
    old = old.withColumn("city", lit("C")).withColumn("search_text", lit("stale"))
    gone = table(s, sf, "supplier").select(
        F.concat(lit("s"), c("s_suppkey").cast("string")).alias("drive_file_id"), c("s_name").alias("filename"),
        F.when(c("s_acctbal") > 5000, "nas").otherwise("drive").alias("source"), lit("gone").alias("search_text"))
    return old.unionByName(gone, allowMissingColumns=True).select(
        "drive_file_id", "source", "channel_name", "case_name", "subpath", "filename", "tags", "search_text", "is_old", "city")


PUBLISHED = f"""{LISTING},
ls as (select * from rf where p_type <> 'MEDIUM' or source = 'drive'),
st as (select drive_file_id, source, [channel_name, case when size_bytes > 20 then 'keep' else 'host' end, 'x'] as tags, 'stale' as search_text, is_old, 'C' as city from rf where size_bytes <= 40
  union all select 's' || s_suppkey, case when s_acctbal > 5000 then 'nas' else 'drive' end, null, 'gone', null, null from supplier),
up as (select coalesce(l.drive_file_id, st.drive_file_id) as drive_file_id, coalesce(l.source, st.source) as source, l.drive_file_id is not null as hit,
  case when l.drive_file_id is null then st.tags when list_contains(st.tags, 'keep') then list_sort(list_distinct(list_concat(l.tags, ['keep']))) else l.tags end as tags,
  case when l.drive_file_id is null then st.search_text end as old_text, l.channel_name, l.case_name, l.subpath, l.filename,
  case when l.drive_file_id is null then st.is_old else l.is_old end as is_old, st.city from ls l full join st on l.drive_file_id = st.drive_file_id),
gd as (select source, count(*) filter (where hit) as scanned, count(*) filter (where not hit) as stale from up group by 1),
pu as (select up.* from up left join gd using (source) where hit or not (scanned > 0 and stale > 0 and stale <= scanned * 0.5)),
pc as (select drive_file_id, source, case_name, array_to_string(tags, ',') as tags, is_old, city,
  coalesce(old_text, concat_ws(' ', channel_name, case_name, subpath, filename, array_to_string(tags, ' '))) as search_text, hit from pu)"""


def published(s, sf):
    refined = stage(G.refine_listing(listing(s, sf), RULES), "listing")
    new = refined.filter((c("channel_name") != "MEDIUM") | (c("source") == "drive"))
    return G.publish(stored(s, sf, refined), new, ["keep"])


@query("K5", "catalog_published", f"with {PUBLISHED} select drive_file_id, source, tags, search_text, is_old, city from pc")
def _(s, sf):
    return published(s, sf).select("drive_file_id", "source", F.array_join("tags", ",").alias("tags"), "search_text", "is_old", "city")


@query("J12", "catalog_placed", f"""with {PUBLISHED},
gu as (select distinct case_name, case when contains(case_name, 'large') then 'big' when contains(case_name, 'red') then 'red' end as city,
  case when contains(case_name, 'large') then case when contains(case_name, 'ring') then 'ring' else '' end when contains(case_name, 'red') then case when contains(case_name, 'gear') then 'gear' else '' end end as district
  from pc where coalesce(case_name, '') <> ''),
ma as (select p_name as case_name, max(p_type) as city, min(p_brand) as district from part where p_size = 50 group by 1),
ex as (select coalesce(g.case_name, ma.case_name) as case_name, case when ma.case_name is not null then ma.city else g.city end as city,
  nullif(case when ma.case_name is not null then ma.district else g.district end, '') as district, case when ma.case_name is not null then 'A1 ' || ma.city end as area
  from (select * from gu where city is not null) g full join ma on g.case_name = ma.case_name),
j as (select pc.*, ex.case_name is not null as known, ex.city as ec, ex.district as ed, ex.area as ea from pc left join ex using (case_name)),
w as (select *, concat_ws(' ', search_text, case when not contains(search_text, ec) then ec end, case when not contains(search_text, ed) then ed end,
  case when not contains(search_text, ec || ' ' || ed) then ec || ' ' || ed end, case when not contains(search_text, 'A1') and ea is not null then 'A1' end,
  case when ea is not null and not contains(search_text, split_part(ea, ' ', 2)) then split_part(ea, ' ', 2) end) as new_text from j)
select drive_file_id, case when known then ec else city end as city, case when known then ed end as district, case when known then new_text else search_text end as search_text from w""")
def _(s, sf):
    cat = stage(published(s, sf).withColumn("district", lit(None).cast("string")), "catalog")
    manual = table(s, sf, "part").filter(c("p_size") == 50).groupBy(c("p_name").alias("case_name")).agg(
        F.max("p_type").alias("city"), F.min("p_brand").alias("district")).withColumn("area", F.concat(lit("A1 "), c("city")))
    none = manual.filter(lit(False))
    existing = none.withColumn("auto_area", lit(False)).withColumn("manual", lit(False))
    admin = none.withColumn("is_non_building", lit(False)).withColumn("source", lit(""))
    places = G.expected_places(
        cat, lambda x: gazetteer_match(x, ["red", "large"], {"large": "big"}, {"big": ["ring"], "red": ["gear"]}, {}, {}),
        existing, manual, admin)
    return G.apply_places(cat, places).select("drive_file_id", "city", "district", "search_text")


SEARCHED = f"""with {CUSTOMER_GEO}, ca as (select o_orderkey as id, o_orderdate as mtime, o_orderstatus = 'P' as is_old, o_orderpriority as category, c_mktsegment as case_name,
  case when city <> 'ASIA' then city end as city, case when city <> 'ASIA' then district end as district, o_orderpriority || ' ' || c_mktsegment as search_text from orders join cg on o_custkey = c_custkey),
e as (select * from ca where city is not null and case_name ilike '%machinery%' order by id limit 100),
v as (select city, district, count(*) as votes from e group by 1, 2 order by 3 desc, 1, 2 limit 1),
h as (select ca.*, case when ca.city = v.city and ca.district ilike '%' || v.district || '%' then 0
  when ca.city <> v.city or ca.city is null or not (ca.district ilike '%' || v.district || '%') then 1 end as block from ca, v where search_text ilike '%machinery%' and not is_old)"""


@query("Q3", "search_page", f"""{SEARCHED} select id, block, city, district from h where block is not null order by block, mtime desc, id limit 40 offset 10""")
def _(s, sf):
    g = customer_geo(s, sf)
    placed = c("city") != "ASIA"
    cat = table(s, sf, "orders").join(g, c("o_custkey") == c("c_custkey")).select(
        c("o_orderkey").alias("drive_file_id"), c("o_orderdate").alias("mtime"), (c("o_orderstatus") == "P").alias("is_old"),
        c("o_orderpriority").alias("category"), c("c_mktsegment").alias("case_name"), F.when(placed, c("city")).alias("city"),
        F.when(placed, c("district")).alias("district"), F.concat_ws(" ", "o_orderpriority", "c_mktsegment").alias("search_text"))
    out = G.search(cat, "machinery - part 3", r"\s*part \d+\s*$", "a-z", offset=10, n=40)
    return out.select(c("drive_file_id").alias("id"), "block", "city", "district")


@query("K6", "schedule_synced", f"""with {SCHEDULE},
sc as (select sheet, dt as date, case_name, editor from ti where case_name <> '' group by all),
pl as (select distinct o_orderpriority as case_name, left(o_orderpriority, 1) as city, nullif(substr(o_orderpriority, 3), 'LOW') as district from orders)
select sheet, date, case_name, editor, city, district from sc left join pl using (case_name) where date between date '2000-03-01' and date '2000-03-06' + 180""")
def _(s, sf):
    p = c("o_orderpriority")
    places = table(s, sf, "orders").select(p.alias("case_name"), F.left(p, lit(1)).alias("city"),
                                           F.nullif(F.substr(p, lit(3)), lit("LOW")).alias("district")).distinct()
    parsed = parse_schedule(order_grid(s, sf), "sheet", lit(2000), lit(False), ["off"], ["ab", "cd"], [], [], [])
    return G.sync_schedule(parsed, places, F.to_date(lit("2000-03-01")), 186, shared_path(s, "schedule"))


ROLLBACK = """ca as (select c_custkey as id, [c_mktsegment, 'keep', c_name] as tags, c_name || ' ' || c_mktsegment || ' view end' as text from customer where c_acctbal > 500),
jo as (select event_id as seq, user_id as fid, case event_type when 'click' then 'MACHINERY' when 'signup' then 'view' else event_type end as place from events where event_type <> 'error'),
fi as (select fid, place, min(seq) as first from jo group by 1, 2),
st as (select fid, list(place order by first) as places from fi group by 1),
rm as (select id, tags, places, text as t0, trim(replace(replace(replace(text, ' ' || places[1], ''), places[1] || ' ', ''), places[1], '')) as t1 from ca join st on id = fid),
r2 as (select *, case when len(places) < 2 then t1 else trim(replace(replace(replace(t1, ' ' || places[2], ''), places[2] || ' ', ''), places[2], '')) end as t2 from rm),
r3 as (select *, case when len(places) < 3 then t2 else trim(replace(replace(replace(t2, ' ' || places[3], ''), places[3] || ' ', ''), places[3], '')) end as t3 from r2)"""


def rolled_back(s, sf):
    cu = table(s, sf, "customer").filter(c("c_acctbal") > 500)
    cat = cu.select(c("c_custkey").alias("drive_file_id"), F.array(c("c_mktsegment"), lit("keep"), c("c_name")).alias("tags"),
                    F.concat_ws(" ", "c_name", "c_mktsegment", lit("view end")).alias("search_text"))
    kind = F.when(c("event_type") == "click", "MACHINERY").when(c("event_type") == "signup", "view").otherwise(c("event_type"))
    e = table(s, sf, "events").filter(c("event_type") != "error").select(c("event_id").alias("seq"), c("user_id").alias("fid"), kind.alias("place"))
    return G.rollback_places(cat, e, "fid", "place", "seq")


@query("K2", "rollback_patches", f"""with {ROLLBACK}
select id as drive_file_id, array_to_string(list_filter(tags, lambda t: not list_contains(places, t)), ',') as tags, t3 as search_text from r3
where t3 <> t0 or list_has_any(tags, places)""")
def _(s, sf):
    return rolled_back(s, sf)[0].withColumn("tags", F.array_join("tags", ","))


@query("K2", "rollback_report", f"""with {ROLLBACK},
ch as (select id, unnest(places) as place, unnest([t1 <> t0, t2 <> t1, t3 <> t2]) as moved, tags from r3)
select fid, jo.place, seq, case when id is null then 'row-missing' when seq = first and (moved or list_contains(tags, jo.place)) then 'reverted' else 'no-change' end as status
from jo join fi using (fid, place) left join ch on fid = id and jo.place = ch.place""")
def _(s, sf):
    return rolled_back(s, sf)[1]


@query("J2", "missing_files_guarded", """with ca as (select o_orderkey as id, o_orderpriority as volume, case when o_orderstatus = 'P' then '' else 'p/' || o_orderkey end as path from orders),
li as (select distinct o_orderpriority as volume, 'p/' || o_orderkey as path from orders join lineitem on o_orderkey = l_orderkey where l_linenumber = 1 and (l_returnflag <> 'R' or o_orderpriority = '2-HIGH')
  and not (o_orderpriority = '3-MEDIUM' and o_orderkey < 200)),
r as (select * from ca where path <> ''), sa as (select volume, arg_min(path, id) as path from r group by 1),
h as (select volume from sa where volume <> '5-LOW' and (volume, path) in (select volume, path from li))
select id, case when volume in (select volume from h) then 'missing' else 'skipped' end as status from r where (volume, path) not in (select volume, path from li)""")
def _(s, sf):
    o = table(s, sf, "orders").select(c("o_orderkey").alias("id"), c("o_orderpriority").alias("volume"), "o_orderstatus",
                                      F.concat(lit("p/"), c("o_orderkey").cast("string")).alias("path"))
    li = table(s, sf, "lineitem").filter(c("l_linenumber") == 1).join(o, c("l_orderkey") == c("id"))
    li = li.filter(((c("l_returnflag") != "R") | (c("volume") == "2-HIGH")) & ~((c("volume") == "3-MEDIUM") & (c("id") < 200)))
    cat = o.withColumn("path", F.when(c("o_orderstatus") == "P", "").otherwise(c("path")))
    return G.missing_files(cat, li.select("volume", "path"), "id", "volume", "path", ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED"])
