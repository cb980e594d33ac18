"""Column functions applied to whole tables (F, M, D, R rows)."""

from pyspark.sql import functions as F

from shelfmark.functions import names as N
from shelfmark.functions.entries import resolve_dataset, validate_entry
from shelfmark.functions import paths as P
from shelfmark.functions import text as X
from shelfmark.functions import values as V
from shelfmark.operators import dictionary as D
from shelfmark.operators.lanes import numbered
from shelfmark.plans.bindings import CUSTOMER_GEO, PAGE_PATHS, customer_geo, page_paths
from shelfmark.plans.registry import query, table
from shelfmark.sources.tables import spread

c, lit = F.col, F.lit


@query("F1", "synthetic_id", f"""with {PAGE_PATHS}
select page_id, 'nas:' || left(sha1(case when scheme = 'https' then rel else 'v2/' || rel end), 16) as asset_id from pp""")
def _(s, sf):
    vol = F.when(c("scheme") == "https", "v1").otherwise("v2")
    return page_paths(s, sf).select("page_id", P.synthetic_id(c("rel"), vol).alias("asset_id"))


ROOTS = [
    {"volume": "v1", "prefixes": {"linux": "/https", "win": "S:/Sites/", "docker": "/data/sites"}},
    {"volume": "v2", "prefixes": {"linux": "/http/en", "win": "E:\\English", "docker": "/data/en/"}},
]


@query("F2", "path_translate", rf"""with {PAGE_PATHS},
a as (select page_id, case when contains(url, '?') then replace(upper('/' || scheme || '/' || path), '/', '\')
             else '/' || scheme || '/' || path end as p from pp),
b as (select page_id, regexp_replace(replace(p, '\', '/'), '/+$', '') as p from a),
d as (select page_id, p, case when lower(p) = '/https' or starts_with(lower(p), '/https/') then 'v1'
             when lower(p) = '/http/en' or starts_with(lower(p), '/http/en/') then 'v2' end as volume from b),
e as (select *, case volume when 'v1' then substr(p, 8) when 'v2' then substr(p, 10) end as rel_path from d)
select page_id, volume, rel_path, case volume when 'v1' then 'S:/Sites/' || rel_path when 'v2' then 'E:/English/' || rel_path end
  as translated from e""")
def _(s, sf):
    p = F.concat(lit("/"), c("scheme"), lit("/"), c("path"))
    p = F.when(c("url").contains("?"), F.translate(F.upper(p), "/", "\\")).otherwise(p)
    return page_paths(s, sf).select("page_id", P.path_translate(p, ROOTS, "win").alias("t")).select("page_id", "t.*")


@query("F3", "parse_ordered_name", r"""with a as (select p_partkey,
  case when p_size < 10 then p_name else p_size || '_ ' || p_name || ' ' end as f from part)
select p_partkey, try_cast(nullif(regexp_extract(f, '^(\d+)_?\s*(.+)$', 1), '') as bigint) as ord,
  case when regexp_matches(f, '^(\d+)_?\s*(.+)$') then trim(regexp_extract(f, '^(\d+)_?\s*(.+)$', 2)) else f end as name from a""")
def _(s, sf):
    f = F.when(c("p_size") < 10, c("p_name")).otherwise(F.concat(c("p_size").cast("string"), lit("_ "), c("p_name"), lit(" ")))
    return table(s, sf, "part").select("p_partkey", P.parse_ordered_name(f).alias("x")).select("p_partkey", "x.*")


@query("F4", "parse_mmdd_prefix", r"""with a as (select o_orderkey, case o_orderstatus
    when 'F' then strftime(o_orderdate, '%m') || '31 ' || o_orderpriority
    when 'P' then strftime(o_orderdate, '%d%m') || o_orderpriority
    else strftime(o_orderdate, '%m%d') || ' ' || o_orderpriority end as f from orders),
b as (select o_orderkey, f, regexp_matches(f, '^(\d{4})(.+)$') and try_cast(substr(f, 1, 2) as int) between 1 and 12
       and try_cast(substr(f, 3, 2) as int) between 1 and 31 as hit from a)
select o_orderkey, case when hit then try_cast('2023-' || substr(f, 1, 2) || '-' || substr(f, 3, 2) as date) end as case_date,
  case when hit then trim(substr(f, 5)) else f end as case_name from b""")
def _(s, sf):
    d, p = c("o_orderdate"), c("o_orderpriority")
    f = (F.when(c("o_orderstatus") == "F", F.concat(F.date_format(d, "MM"), lit("31 "), p))
         .when(c("o_orderstatus") == "P", F.concat(F.date_format(d, "ddMM"), p))
         .otherwise(F.concat(F.date_format(d, "MMdd"), lit(" "), p)))
    return table(s, sf, "orders").select("o_orderkey", P.parse_mmdd_prefix(f, lit(2023)).alias("x")).select("o_orderkey", "x.*")


@query("F5", "classify_keywords", """select p_partkey, case when contains(lower(p_name), 'ring') then 'jewel'
  when contains(lower(p_name), 'bolt') then 'fastener' when contains(lower(p_name), 'red') then 'colour' else 'other' end as label from part""")
def _(s, sf):
    rules = [("ring", "jewel"), ("BOLT", "fastener"), ("red", "colour")]
    return table(s, sf, "part").select("p_partkey", P.classify_keywords(c("p_name"), rules, "other").alias("label"))


@query("F6", "derive_category", """select doc_id, case when source = 'src0' then 'fixed' when contains(lower(text), '###') then 'marked'
  when contains(lower(text), 'the ') then 'english' when contains(lower(text), 'que') then 'romance' else 'raw' end as category from documents""")
def _(s, sf):
    rules = [("###", "marked"), ("the ", "english"), ("que", "romance")]
    return table(s, sf, "documents").select(
        "doc_id", P.derive_category(c("source"), c("text"), {"src0": "fixed"}, rules, "raw").alias("category"))


@query("F7", "derive_case_name", rf"""with {PAGE_PATHS},
a as (select page_id, split_part(path, '/', 1) as folder, regexp_replace(path, '^[^/]*/?', '') as sub from pp)
select page_id, case when folder not in ('en', 'de') then folder else coalesce(
  list_filter(string_split(sub, '/'), lambda x: x <> '' and x not in ('en', 'de', '25', '369'))[1], folder) end as case_name from a""")
def _(s, sf):
    sub = F.regexp_replace("path", r"^[^/]*/?", "")
    return page_paths(s, sf).select("page_id", P.derive_case_name(
        F.substring_index("path", "/", 1), sub, ["en", "de"], ["25", "369"]).alias("case_name"))


def versioned_name():
    n = c("p_size").cast("string")
    return (F.when(c("p_size") < 10, F.concat(c("p_name"), lit(".mp4")))
            .when(c("p_size") < 25, F.concat(c("p_name"), lit(" v"), n, lit("  V"), (c("p_size") + 1).cast("string"), lit(".Mov")))
            .when(c("p_size") < 40, F.concat(c("p_name"), lit(" V"), n, lit("_x.mp4")))
            .otherwise(F.concat(c("p_name"), lit(" V"), n, lit(" cut"))))


VERSIONED = r"""v0 as (select *, case when p_size < 10 then p_name || '.mp4'
    when p_size < 25 then p_name || ' v' || p_size || '  V' || (p_size + 1) || '.Mov'
    when p_size < 40 then p_name || ' V' || p_size || '_x.mp4' else p_name || ' V' || p_size || ' cut' end as fname from part),
v1 as (select *, regexp_replace(fname, '\.[^.]*$', '') as stem,
    case when contains(fname, '.') then lower(regexp_extract(fname, '\.([^.]*)$', 1)) else '' end as ext from v0),
v as (select * exclude (stem), case when regexp_matches(stem, '(?is)^(.*)\s+V(\d+)\b(.*)$')
      then trim(rtrim(regexp_extract(stem, '(?is)^(.*)\s+V(\d+)\b(.*)$', 1)) || regexp_extract(stem, '(?is)^(.*)\s+V(\d+)\b(.*)$', 3))
      else trim(stem) end as base,
    coalesce(try_cast(nullif(regexp_extract(stem, '(?is)^(.*)\s+V(\d+)\b(.*)$', 2), '') as bigint), 1) as version from v1)"""


@query("F8", "extract_version", f"with {VERSIONED} select p_partkey, base, version, ext from v")
def _(s, sf):
    return table(s, sf, "part").select("p_partkey", P.extract_version(versioned_name()).alias("x")).select("p_partkey", "x.*")


@query("F9", "build_search_text", f"""with {CUSTOMER_GEO},
a as (select o_orderkey, o_orderpriority, c_name, o_orderstatus, c_mktsegment, city, nullif(district, 'NATION_3') as district
      from orders join cg on o_custkey = c_custkey)
select o_orderkey, concat_ws(' ', o_orderpriority, c_name, o_orderstatus || ' ' || c_mktsegment, city, district,
  case when district is not null then city || ' ' || district end) as search_text from a""")
def _(s, sf):
    o = table(s, sf, "orders").join(customer_geo(s, sf), c("o_custkey") == c("c_custkey"))
    return o.select("o_orderkey", X.build_search_text(
        c("o_orderpriority"), c("c_name"), lit(""), lit(None).cast("string"), F.array("o_orderstatus", "c_mktsegment"),
        c("city"), F.nullif(c("district"), lit("NATION_3"))).alias("search_text"))


@query("F10", "append_missing_tokens", """with a as (select *, lang || ' ' || source as pair from documents),
b as (select doc_id, text, concat_ws(' ', text, case when not contains(text, lang) then lang end,
    case when not contains(text, source) then source end, case when not contains(text, pair) then pair end) as t1 from a)
select doc_id, md5(trim(t1)) as text_md5, length(trim(t1)) as n_chars from b where t1 <> text""")
def _(s, sf):
    new = X.append_missing_tokens(c("text"), [c("lang"), c("source"), F.concat_ws(" ", "lang", "source")])
    d = spread(table(s, sf, "documents")).withColumn("new", new).filter(c("new") != F.trim("text"))
    return d.select("doc_id", F.md5("new").alias("text_md5"), F.length("new").cast("bigint").alias("n_chars"))


@query("F10", "append_missing_tokens_sequential", """with a as (select doc_id, text,
  case when contains(text, lang) then text else text || ' ' || lang end as t1, lang, source from documents),
b as (select doc_id, case when contains(t1, source) then t1 else t1 || ' ' || source end as t2, lang from a),
d as (select doc_id, case when contains(t2, lang || ' s') then t2 else t2 || ' ' || lang || ' s' end as t3 from b)
select doc_id, md5(trim(t3)) as text_md5 from d""")
def _(s, sf):
    toks = [c("lang"), c("source"), F.concat(c("lang"), lit(" s"))]
    return table(s, sf, "documents").select(
        "doc_id", F.md5(X.append_missing_tokens(c("text"), toks, sequential=True)).alias("text_md5"))


@query("F11", "remove_token", """with a as (select doc_id, trim(replace(replace(replace(text, ' the', ''), 'the ', ''), 'the', '')) as t from documents)
select doc_id, md5(t) as text_md5, length(t) as n_chars from a""")
def _(s, sf):
    t = X.remove_token(c("text"), lit("the"))
    return spread(table(s, sf, "documents")).select("doc_id", F.md5(t).alias("text_md5"), F.length(t).cast("bigint").alias("n_chars"))


@query("F12", "tail_token", r"""select c_custkey,
  list_extract(string_split_regex(trim(replace(c_name, '#', ')') || '_' || c_mktsegment), '[_\s\)]+'), -1) as tail,
  list_extract(string_split_regex(trim(replace(c_name, '#', ') ')), '[_\s\)]+'), -1) as number from customer""")
def _(s, sf):
    return table(s, sf, "customer").select(
        "c_custkey", N.tail_token(F.concat(F.translate("c_name", "#", ")"), lit("_"), c("c_mktsegment"))).alias("tail"),
        N.tail_token(F.replace(c("c_name"), lit("#"), lit(") "))).alias("number"))


@query("F13", "normalize_city", """select n_nationkey, nullif(regexp_replace(case when starts_with(n_name, 'NA') then 'LA' || substr(n_name, 3) else n_name end,
  '[1234]$', ''), '') as city from nation""")
def _(s, sf):
    return table(s, sf, "nation").select("n_nationkey", N.normalize_city(c("n_name"), {"NA": "LA"}, "1234").alias("city"))


@query("F13", "normalize_district", """select n_nationkey, n_name || ',' || case when r_name = 'ASIA' then 'ASIAY' else regexp_replace(r_name, '[XYA]$', '') end as district
  from nation join region on n_regionkey = r_regionkey""")
def _(s, sf):
    n = table(s, sf, "nation").join(table(s, sf, "region"), c("n_regionkey") == c("r_regionkey"))
    raw = F.concat(c("n_name"), lit("X, ,"), F.when(c("r_name") == "ASIA", "ASIAY").otherwise(c("r_name")))
    return n.select("n_nationkey", N.normalize_district(raw, "XYA", ["ASIAY"]).alias("district"))


@query("F14", "detect_labels", r"""with a as (select p_partkey, list_concat(list_transform(regexp_extract_all(p_brand || ' ' || p_size, '(\d+)', 1),
    lambda h: case h when '1' then 'one' when '2' then 'two' when '12' then 'twelve' else h end),
    case when contains(p_type, 'PROMO') then ['PROMO'] else [] end) as l from part)
select p_partkey, nullif(array_to_string(list_filter(l, lambda x, i: list_position(l, x) = i), ' '), '') as labels from a""")
def _(s, sf):
    cands = [F.concat_ws(" ", "p_brand", c("p_size").cast("string")), c("p_type")]
    return table(s, sf, "part").select("p_partkey", N.detect_labels(
        cands, r"(\d+)", {"1": "one", "2": "two", "12": "twelve"}, ["PROMO"]).alias("labels"))


@query("F15", "clean_title", r"""with a as (select doc_id, trim(regexp_extract(text, '^([^\n\r]*)', 1)) as s from documents),
b as (select doc_id, trim(regexp_replace(s, '\s*[（(][^）)]+[）)]\s*', ' ', 'g')) as s from a),
d as (select doc_id, case when starts_with(s, 'The') then regexp_replace(substr(s, 4), '^[ 、_-]+', '') else s end as s from b),
e as (select doc_id, case when starts_with(s, 'Es') then regexp_replace(substr(s, 3), '^[ 、_-]+', '') else s end as s from d),
f as (select doc_id, regexp_replace(regexp_replace(s, '^\s*\d{1,2}\s*[/／]\s*\d{1,2}\s*', ''), '^\s*\d{3,4}\s*', '') as s from e),
g as (select doc_id, trim(regexp_replace(s, '(?s)(?:###|!!|\|).*$', '')) as s from f),
h as (select doc_id, regexp_replace(regexp_replace(s, '\s*\*\s*\d+\s*$', ''), '(?:[ 、_-]*(?:the|of|en|\.))+$', '') as s from g)
select doc_id, trim(regexp_replace(s, '\s+', ' ', 'g')) as title from h""")
def _(s, sf):
    return spread(table(s, sf, "documents")).select("doc_id", N.clean_title(
        c("text"), ["The", "Es"], ["###", "!!", "|"], ["the", "of", "en", "."]).alias("title"))


def part_title():
    return (F.when(c("p_size") < 20, F.concat(c("p_name"), lit("_"), c("p_type")))
            .when(c("p_size") < 35, F.concat(c("p_name"), lit(" part "), c("p_size").cast("string"))).otherwise(c("p_name")))


PART_TITLE = """pt as (select *, case when p_size < 20 then p_name || '_' || p_type
  when p_size < 35 then p_name || ' part ' || p_size else p_name end as title from part)"""


@query("F16", "search_key_cascade", rf"""with {PART_TITLE},
a as (select p_partkey, title, trim(regexp_extract(title, '^([^_\-]*)', 1)) as head from pt),
b as (select *, trim(regexp_replace(head, '\s*part \d+\s*$', '')) as bare from a),
d as (select p_partkey, [title, case when head <> title then head end, case when bare <> head then bare end,
        case when length(regexp_extract(bare, '^([a-z]+)', 1)) >= 2 then regexp_extract(bare, '^([a-z]+)', 1) end] as k from b)
select p_partkey, array_to_string(list_filter(k, lambda x, i: x is not null and list_position(k, x) = i), '|') as keys from d""")
def _(s, sf):
    return table(s, sf, "part").select(
        "p_partkey", F.array_join(N.search_key_cascade(part_title(), r"\s*part \d+\s*$", "a-z"), "|").alias("keys"))


@query("F17", "normalize_for_match", r"""select p_partkey, lower(regexp_replace(p_name || ' ' || p_brand, '\s+', '', 'g')) as folded,
  upper(regexp_replace(p_name || '-(' || p_type || ')', '[\s\-_()]', '', 'g')) as building,
  trim(regexp_replace(regexp_replace(p_name || '  x (' || p_size || '-2) tail', '(?s)\s*\(\s*\d+\s*[-/].*$', ''), '\s+', ' ', 'g')) as title from part""")
def _(s, sf):
    n, b = c("p_name"), c("p_brand")
    return table(s, sf, "part").select(
        "p_partkey", N.normalize_for_match(F.concat_ws(" ", n, b)).alias("folded"),
        N.normalize_building(F.concat(n, lit("-("), c("p_type"), lit(")"))).alias("building"),
        N.normalize_case(F.concat(n, lit("  x ("), c("p_size").cast("string"), lit("-2) tail")), "link").alias("title"))


@query("F18", "clean_noise_tokens", r"""with a as (select doc_id, regexp_replace(regexp_replace(text, '^\d+%3A\d+\s*', ''), '^\d{4}\s*', '') as s from documents),
b as (select doc_id, regexp_replace(regexp_replace(s, '[（(].*?[)）]', '', 'g'), '\s*(?:the|of|!!|x\d)+\s*', '', 'g') as s from a)
select doc_id, md5(regexp_replace(regexp_replace(s, '\s*\d+$', ''), '^\s+|\s+$', '', 'g')) as text_md5 from b""")
def _(s, sf):
    return spread(table(s, sf, "documents")).select("doc_id", F.md5(N.clean_noise_tokens(c("text"), r"the|of|!!|x\d")).alias("text_md5"))


@query("F19", "name_similarity_accept", r"""with a as (select p_partkey, upper(regexp_replace(p_name, '[\s\-_()]', '', 'g')) as x,
   upper(regexp_replace(p_type || p_brand, '[\s\-_()]', '', 'g')) as y from part)
select p_partkey, contains(x, y) or contains(y, x)
    or len(list_distinct(list_intersect(string_split(x, ''), string_split(y, '')))) >= least(length(x), length(y)) * 0.6::double as accepted,
  contains(y, left(x, 3)) or contains(x, left(y, 3)) as prefix_accepted from a""")
def _(s, sf):
    a, b = c("p_name"), F.concat(c("p_type"), c("p_brand"))
    return table(s, sf, "part").select("p_partkey", N.name_similarity_accept(a, b).alias("accepted"),
                                       N.prefix_similarity_accept(a, b).alias("prefix_accepted"))


@query("F20", "editor_tag", """select p_partkey, case when contains(p_brand, 'Brand#2') then 'Brand#2' when contains(p_brand, '#1') then '#1' end as editor,
  p_name || ' x' as title, p_brand as last_editor, p_name || ' x' as entry from part""")
def _(s, sf):
    raw = F.concat(c("p_name"), lit(" x ("), c("p_brand"), lit(")"))
    e = N.parse_schedule_entry(F.concat(lit("4/8 "), raw))
    return table(s, sf, "part").select(
        "p_partkey", N.editor_tag(raw, ["Brand#2", "#1"]).alias("editor"), N.remove_editor_tag(raw).alias("title"),
        e["editor"].alias("last_editor"), e["title"].alias("entry"))


@query("F21", "sanitize_token", rf"""with {PAGE_PATHS} select page_id, replace(rel, '/', '_') as place,
  left(regexp_replace(url, '[\\/:*?"<>|]', '', 'g'), 30) as tag from pp""")
def _(s, sf):
    return page_paths(s, sf).select("page_id", P.sanitize_place(c("rel")).alias("place"), P.sanitize_tag(c("url")).alias("tag"))


@query("F22", "derive_rename", rf"""with {PAGE_PATHS},
a as (select page_id, path, scheme, case quality when 1 then 'html' when 0 then ' N/A ' end as place from pp left join labels on doc_id = page_id),
b as (select *, regexp_extract(path, '([^/]*)$', 1) as old, trim(place) as raw, replace(trim(place), '/', '_') as safe,
   len(list_filter(string_split(path, '/'), lambda x: x in ('', '.', '..'))) > 0 as unsafe from a),
d as (select *, case when place is null then 'no-place' when path = '' then 'no-path' when unsafe then 'dot-segment' end as reason,
   case when regexp_matches(old, '.\.[^.]+$') then regexp_extract(old, '(\.[^.]+)$', 1) else '' end as suffix from b),
e as (select *, case when reason is null then left(old, length(old) - length(suffix)) || '_' || safe || suffix end as new_filename from d),
f as (select *, case when reason is null then left(path, length(path) - length(old)) || new_filename end as new_rel_path from e)
select page_id, case when reason is not null then 'invalid' when contains(old, raw) or contains(old, safe) then 'already' else 'rename' end as status,
  reason, new_filename, new_rel_path,
  'nas:' || left(sha1(case when scheme = 'https' then new_rel_path else 'v2/' || new_rel_path end), 16) as new_id from f""")
def _(s, sf):
    lab = table(s, sf, "labels").select("doc_id", F.when(c("quality") == 1, "html").otherwise(" N/A ").alias("place"))
    p = page_paths(s, sf).join(lab, c("page_id") == c("doc_id"), "left")
    vol = F.when(c("scheme") == "https", "v1").otherwise("v2")
    return p.select("page_id", P.derive_rename(c("path"), c("place"), vol).alias("r")).select("page_id", "r.*")


@query("F23", "has_script_chars", "select doc_id, regexp_matches(text, '[éèüöß]') as has_script from documents")
def _(s, sf):
    return table(s, sf, "documents").select("doc_id", N.has_script_chars(c("text"), "éèüöß").alias("has_script"))


@query("F23", "has_place_suffix", rf"""with {PAGE_PATHS} select page_id,
  regexp_matches(regexp_replace(replace(path, '/', '_'), '\.[^.]*$', ''), '_[3-6]') as has_suffix from pp""")
def _(s, sf):
    return page_paths(s, sf).select("page_id", N.has_place_suffix(F.translate("path", "/", "_"), "3-6").alias("has_suffix"))


@query("F24", "token_vicinity_find", """with a as (select doc_id, text, instr(lower(text), 'that') as i from documents),
b as (select doc_id, case when i > 0 then substr(text, greatest(i - 300, 1), i + 304 - greatest(i - 300, 1)) end as v from a)
select doc_id, case when contains(v, 'reres') then 'reres' when contains(v, 'oned') then 'oned' when contains(v, 'ing') then 'ing' end as found from b""")
def _(s, sf):
    return table(s, sf, "documents").select(
        "doc_id", X.token_vicinity_find(c("text"), "That", ["reres", "oned", "ing"]).alias("found"))


@query("F25", "truncate_with_marker", """select doc_id, case when length(text) > 500 then left(text, 500) || '...<truncated>' else text end as shown from documents""")
def _(s, sf):
    return table(s, sf, "documents").select("doc_id", X.truncate_with_marker(c("text")).alias("shown"))


PREFIXES = [("re", "R"), ("red", "RED"), ("red a", "RED-A"), ("small bo", "SMALL"), ("co", "CO")]


@query("F26", "progressive_prefix_lookup", """with d(k, v) as (values ('re', 'R'), ('red', 'RED'), ('red a', 'RED-A'), ('small bo', 'SMALL'), ('co', 'CO'))
select p_partkey, case when contains(p_name, 'gear') then 'gear' else coalesce(arg_max(v, length(k)), 'none') end as place
from part left join d on starts_with(p_name, k) group by p_partkey, p_name""")
def _(s, sf):
    d = s.createDataFrame(PREFIXES, "key string, value string")
    p = table(s, sf, "part").select("p_partkey", "p_name")
    return D.progressive_prefix_lookup(p, "p_name", d, direct=["gear"], default="none").select("p_partkey", c("found").alias("place"))


@query("F27", "render_batch_prompt", """with a as (select *, row_number() over (order by p_partkey) - 1 as i from part)
select i // 15 + 1 as batch, string_agg((i % 15 + 1) || '. ' || p_name || ' | ' || p_type || ' | ' || p_brand, chr(10) order by i) as prompt from a group by 1""")
def _(s, sf):
    p = numbered(table(s, sf, "part"), ["p_partkey"])
    line = F.concat_ws(" | ", "p_name", "p_type", "p_brand")
    return D.render_batches(p, "rn", line, 15)


@query("M1", "rotation_swap", """select l_orderkey, l_linenumber, l_partkey, l_suppkey,
  case when l_linestatus = 'F' and l_returnflag = 'R' then null when l_linenumber = 7 then 0 when l_quantity < 20 then l_partkey else cast(l_quantity as bigint) end as w,
  case when l_linestatus = 'F' and l_returnflag = 'R' then null when l_linenumber = 7 then 0 when l_quantity < 20 then cast(l_quantity as bigint) else l_partkey end as h
from lineitem""")
def _(s, sf):
    rot = F.when(c("l_quantity") < 10, -90).when(c("l_quantity") < 20, 270).when(c("l_quantity") < 30, 180).otherwise(0)
    err = F.when((c("l_linestatus") == "F") & (c("l_returnflag") == "R"), lit("probe failed"))
    dims = V.rotation_swap(c("l_quantity").cast("bigint"), c("l_partkey"), rot, c("l_linenumber") != 7, err)
    return table(s, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", dims.alias("d")).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "d.w", "d.h")


@query("M2", "codec_normalize", """select o_orderkey, case o_orderpriority when '1-URGENT' then 'hevc' when '2-HIGH' then 'hevc'
  when '5-LOW' then 'UNKNOWN' else lower(o_orderpriority) end as codec from orders""")
def _(s, sf):
    raw = F.when(c("o_orderpriority") != "5-LOW", F.concat(lit(" "), c("o_orderpriority")))
    return table(s, sf, "orders").select(
        "o_orderkey", V.codec_normalize(raw, {"1-urgent": "hevc", "2-high": "hevc"}).alias("codec"))


@query("M3", "duration_flag", """select doc_id, case when n_chars > 250 then n_chars / 1000.0::double < 3.0 end as is_short,
  array_to_string(case when n_chars > 250 and n_chars / 1000.0::double < 3.0 then [lang, 'short'] else [lang] end, ',') as tags from documents""")
def _(s, sf):
    flag = V.short_flag(F.when(c("n_chars") > 250, c("n_chars")).otherwise(0), lit(1000.0))
    tags = F.when(flag, F.array_union(F.array("lang"), F.array(lit("short")))).otherwise(F.array("lang"))
    return table(s, sf, "documents").select("doc_id", flag.alias("is_short"), F.array_join(tags, ",").alias("tags"))


@query("M4", "content_fingerprint", """select doc_id, sha256(case when n_chars < 150 then text else substr(text, 1, 50)
  || substr(text, n_chars // 2 - 25 + 1, 50) || substr(text, n_chars - 50 + 1, 50) end) as fingerprint from documents""")
def _(s, sf):
    return table(s, sf, "documents").select("doc_id", V.content_fingerprint(c("text"), c("n_chars"), 50).alias("fingerprint"))


def sql_grams(text: str) -> str:
    return (f"list_distinct(flatten(list_transform(list_filter(string_split_regex(lower({text}), '[^a-z0-9]+'), lambda w: w <> ''), "
            "lambda w: list_transform(range(1, length(w) + 2), lambda i: substr('  ' || w || ' ', i, 3)))))")


@query("M5", "trigram_similarity", f"""with a as (select p_partkey, {sql_grams("p_name || ' ' || p_brand")} as x, {sql_grams("'red rings'")} as y from part)
select p_partkey, round(len(list_intersect(x, y)) / cast(len(x) + len(y) - len(list_intersect(x, y)) as double), 6) as sim from a""")
def _(s, sf):
    sim = X.trigram_similarity(F.concat_ws(" ", "p_name", "p_brand"), lit("red rings"))
    return table(s, sf, "part").select("p_partkey", F.round(sim, 6).alias("sim"))


@query("M6", "confidence_gate", """select l_orderkey, l_linenumber, l_partkey, l_suppkey, case when l_returnflag = 'N' and l_linestatus = 'O' and l_linenumber = 1 then 'excluded-folder'
  when p_size > 45 then 'no-context' when l_linenumber = 6 then 'file-missing' when l_linenumber = 7 then 'ffmpeg-fail' when l_linenumber = 5 then 'gemini-fail'
  when p_name like '%gear' or 10 * l_discount < 0.7::double then 'low-conf' when p_type not in ('PROMO', 'SMALL') then 'out-of-area' else 'tag' end as status
from lineitem join part on l_partkey = p_partkey""")
def _(s, sf):
    ln = c("l_linenumber")
    st = V.model_status(
        (c("l_returnflag") == "N") & (c("l_linestatus") == "O") & (ln == 1), c("p_size") <= 45, ln != 6, ln != 7, ln != 5,
        F.when(~c("p_name").like("%gear"), c("p_name")), c("l_discount") * 10, c("p_type"), F.array(lit("PROMO"), lit("SMALL")))
    return table(s, sf, "lineitem").join(table(s, sf, "part"), c("l_partkey") == c("p_partkey")).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", st.alias("status"))


@query("D1", "parse_iso_ts", """with a as (select event_id, case event_type when 'error' then 'bad ' || strftime(ts, '%Y-%m-%d')
   when 'view' then strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+02:00' else strftime(ts, '%Y-%m-%dT%H:%M:%SZ') end as raw, event_type, ts from events)
select event_id, case event_type when 'error' then null when 'view' then epoch(date_trunc('second', ts))::bigint - 7200 else epoch(date_trunc('second', ts))::bigint end as epoch_s from a""")
def _(s, sf):
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    raw = (F.when(c("event_type") == "error", F.concat(lit("bad "), F.date_format("ts", "yyyy-MM-dd")))
           .when(c("event_type") == "view", F.concat(iso, lit("+02:00"))).otherwise(F.concat(iso, lit("Z"))))
    return table(s, sf, "events").select("event_id", F.unix_seconds(V.parse_iso_ts(raw)).alias("epoch_s"))


@query("D2", "date_cell_test", """select o_orderkey, o_orderstatus in ('F', 'O') as is_date from orders""")
def _(s, sf):
    d = F.date_format("o_orderdate", "M/d")
    cell = (F.when(c("o_orderstatus") == "F", F.concat(lit(" "), d)).when(c("o_orderstatus") == "O", F.concat(d, lit("(x)")))
            .otherwise(F.concat(d, lit(" "), c("o_orderpriority"), lit(" long"))))
    return table(s, sf, "orders").select("o_orderkey", V.is_date_cell(cell).alias("is_date"))


@query("D3", "age_and_ttl", """with m as (select max(ts) as ref from events)
select event_id, round((epoch_us(ref) - epoch_us(ts)) / 3600000000.0::double, 4) as age_hours,
  (epoch_us(ref) - epoch_us(ts)) > 7 * 86400000000 as expired from events, m""")
def _(s, sf):
    e = table(s, sf, "events")
    age = V.hours_between(e.agg(F.max("ts")).scalar(), c("ts"))
    return e.select("event_id", F.round(age, 4).alias("age_hours"), (age > 7 * 24).alias("expired"))


@query("D4", "weekday_label", """select o_orderkey, month(o_orderdate) || '/' || day(o_orderdate) || '（' ||
  ['mo', 'tu', 'we', 'th', 'fr', 'sa', 'su'][isodow(o_orderdate)] || '）' as label from orders""")
def _(s, sf):
    return table(s, sf, "orders").select(
        "o_orderkey", V.weekday_label(c("o_orderdate"), ["mo", "tu", "we", "th", "fr", "sa", "su"]).alias("label"))


@query("R1", "tag_set_ops", """with a as (select p_partkey, string_split(p_name, ' ') as w, [lower(p_type), 'red', 'old'] as o from part)
select p_partkey, array_to_string(list_sort(list_distinct(list_concat(w, o))), ',') as merged,
  array_to_string(list_sort(list_filter(w, lambda x: not list_contains(o, x))), ',') as removed,
  array_to_string(list_sort(list_filter(w, lambda x: list_contains(o, x))), ',') as kept, list_contains(w, 'ring') as has_ring from a""")
def _(s, sf):
    w, o = F.split("p_name", " "), F.array(F.lower("p_type"), lit("red"), lit("old"))
    return table(s, sf, "part").select(
        "p_partkey", F.array_join(V.tag_set(F.array_union(w, o)), ",").alias("merged"),
        F.array_join(V.tag_set(F.array_except(w, o)), ",").alias("removed"),
        F.array_join(V.tag_set(F.array_intersect(w, o)), ",").alias("kept"), F.array_contains(w, "ring").alias("has_ring"))


@query("R2", "split_multi_value", """select p_partkey, case when p_name like lower(p_type) || ' %' then p_name else
  array_to_string([p_type] || [p_name], '|') end as parts from part""")
def _(s, sf):
    raw = F.concat(c("p_type"), lit(" / "), c("p_name"), lit(",, "), c("p_type"))
    return table(s, sf, "part").select("p_partkey", F.when(
        c("p_name").startswith(F.concat(F.lower("p_type"), lit(" "))), c("p_name")).otherwise(
        F.array_join(V.split_multi_value(raw), "|")).alias("parts"))


def noisy_props():
    return (F.when(c("event_type") == "error", F.concat(lit("no answer "), c("event_id").cast("string")))
            .when(c("event_type") == "view", F.concat(lit("Sure:\n```json\n"), c("props"), lit("\n```\nbye {x}")))
            .otherwise(F.concat(lit("text "), c("props"), lit(" end"))))


@query("R3", "json_from_noisy_text", """select event_id, case when event_type <> 'error' then (props->>'k')::bigint end as k from events""")
def _(s, sf):
    return table(s, sf, "events").select("event_id", V.json_from_noisy_text(noisy_props(), "k bigint")["k"].alias("k"))


@query("R4", "validate_entry", """with a as (select event_id, (props->>'k')::bigint as k from events)
select event_id, case when k between 10 and 40 then k end as k, case when k between 10 and 40 then 'auto-v1' end as stamp from a""")
def _(s, sf):
    allowed = [str(i) for i in range(10, 41)]
    e = validate_entry(F.from_json("props", "struct<k:string>")["k"], lit(None).cast("string"), allowed, "auto-v1")
    return table(s, sf, "events").select("event_id", e["city"].cast("bigint").alias("k"), e["stamp"].alias("stamp"))


@query("R5", "code_label_map", """select event_id, case (props->>'k')::int when 0 then 'clear' when 1 then 'mostly clear' when 45 then 'fog'
  else 'code ' || (props->>'k') end as label from events""")
def _(s, sf):
    k = F.get_json_object("props", "$.k").cast("int")
    return table(s, sf, "events").select("event_id", V.code_label(k, {0: "clear", 1: "mostly clear", 45: "fog"}).alias("label"))


@query("R5", "place_dataset", """select o_orderkey, case o_orderpriority when '1-URGENT' then '1-URGENT' when '2-HIGH' then 'C2' when '5-LOW' then 'C5' end as city,
  case o_orderpriority when '2-HIGH' then '2' when '5-LOW' then '5' end as township from orders""")
def _(s, sf):
    hit = resolve_dataset(c("o_orderpriority"), ["1-URGENT"], {"2": "C2", "5": "C5"}, ["-HIGH", "-LOW"])
    return table(s, sf, "orders").select("o_orderkey", hit["city"].alias("city"), hit["township"].alias("township"))


@query("R6", "json_detail_extract", """select event_id, user_id, event_type, (props->>'k')::bigint as k from events where (props->>'k')::bigint > 50""")
def _(s, sf):
    k = F.from_json("props", "k bigint")["k"]
    return table(s, sf, "events").select("event_id", "user_id", "event_type", k.alias("k")).filter(c("k") > 50)
