"""Projection, filter and predicate rows (P)."""

from pyspark.sql import functions as F

from shelfmark.functions import names as N
from shelfmark.functions import paths as P
from shelfmark.functions import values as V
from shelfmark.operators import predicates as R
from shelfmark.plans.bindings import PAGE_PATHS, page_paths, crc32_sql
from shelfmark.plans.registry import query, table

c, lit = F.col, F.lit


@query("P1", "ext_allowlist", rf"""with {PAGE_PATHS}, a as (select page_id, regexp_extract(path, '([^/]*)$', 1) as n from pp)
select page_id, n as filename, lower(regexp_extract(n, '\.([^.]*)$', 1)) as ext from a where contains(n, '.') and lower(regexp_extract(n, '\.([^.]*)$', 1)) in ('html', 'htm')""")
def _(s, sf):
    n = P.file_name(c("path"))
    return page_paths(s, sf).select("page_id", n.alias("filename"), P.extension(n).alias("ext")).filter(c("ext").isin("html", "htm"))


@query("P2", "folder_prune", rf"""with {PAGE_PATHS} select page_id, path from pp
where len(list_filter(string_split(path, '/'), lambda x: x = 'de' or starts_with(x, '9'))) = 0""")
def _(s, sf):
    return page_paths(s, sf).select("page_id", "path").filter(~P.pruned_folder(c("path"), ["de"], ["9"]))


@query("P3", "sidecar_filter", """select p_type, count(*) filter (where p_name not like 're%') as kept, count(*) filter (where p_name like 're%') as skipped from part group by 1""")
def _(s, sf):
    side = c("p_name").startswith("re")
    return table(s, sf, "part").groupBy("p_type").agg(F.count_if(~side).alias("kept"), F.count_if(side).alias("skipped"))


@query("P4", "depth_limit", rf"with {PAGE_PATHS} select page_id, path from pp where len(string_split(path, '/')) <= 2")
def _(s, sf):
    return page_paths(s, sf).select("page_id", "path").filter(P.depth(c("path")) <= 2)


@query("P5", "conditional_path_exclude", rf"""with {PAGE_PATHS} select page_id, url from pp
where not (contains(host, 'blog') and split_part(path, '/', 1) = 'en')""")
def _(s, sf):
    return page_paths(s, sf).filter(R.conditional_path_exclude(F.concat_ws("/", "host", "path"), "blog", "en")).select("page_id", "url")


@query("P6", "catalog_projection", """select doc_id::varchar as drive_file_id, source || '/' || doc_id as rel_path, source as channel_name,
  coalesce(nullif(lang, 'es'), '') as case_name, '' as subpath, doc_id || '.txt' as filename, case when lang = 'fr' then 0 else n_chars end as size_bytes,
  case when lang = 'en' then 'nas' else 'drive' end as source, case when lang = 'en' then '/share/' || doc_id end as nas_share_url,
  lang as category, lang = 'de' as is_old from documents""")
def _(s, sf):
    i = c("doc_id").cast("string")
    return R.catalog_row(
        table(s, sf, "documents"), drive_file_id=i, rel_path=F.concat_ws("/", "source", i), channel_name=c("source"),
        case_name=F.nullif(c("lang"), lit("es")), filename=F.concat(i, lit(".txt")), size_bytes=F.when(c("lang") != "fr", c("n_chars")),
        source=F.when(c("lang") == "en", "nas"), nas_path=F.concat(lit("/share/"), i), category=c("lang"),
        is_old=F.when(c("lang") == "de", True))


@query("P7", "orientation_generated", """select l_orderkey, l_linenumber, l_partkey, l_suppkey, case when l_linenumber = 7 then null
  when l_linenumber * 5 > l_quantity then true when l_quantity > l_linenumber * 5 then false end as is_vertical from lineitem""")
def _(s, sf):
    w = F.when(c("l_linenumber") != 7, c("l_quantity"))
    return table(s, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                           V.is_vertical(w, c("l_linenumber") * 5).alias("is_vertical"))


@query("P8", "is_old_segment", rf"""with {PAGE_PATHS} select page_id,
  list_contains(list_transform(string_split(replace(path, '.html', ' '), '/'), lambda x: trim(x)), 'fr') or
  list_contains(list_transform(string_split(replace(path, '.html', ' '), '/'), lambda x: trim(x)), '785') as is_old from pp""")
def _(s, sf):
    p = F.replace(c("path"), lit(".html"), lit(" "))
    return page_paths(s, sf).select("page_id", (P.has_segment(p, "fr") | P.has_segment(p, "785")).alias("is_old"))


@query("P9", "rest_predicates", """select doc_id, lang, source, n_chars, quality from documents left join labels using (doc_id)
where lang in ('en', 'fr') and n_chars >= 400 and source like 'src1%' and text ilike '%THAT%'
  and (quality is null or (quality = 1 and toxic <> 1)) and not list_contains(case when lang = 'en' then string_split(source, '1') end, '2')""")
def _(s, sf):
    d = table(s, sf, "documents").join(table(s, sf, "labels"), "doc_id", "left")
    tags = F.when(c("lang") == "en", F.split("source", "1"))
    return d.filter(
        c("lang").isin("en", "fr") & (c("n_chars") >= 400) & c("source").like("src1%") & c("text").ilike("%THAT%")
        & (c("quality").isNull() | ((c("quality") == 1) & (c("toxic") != 1))) & R.lacks(tags, "2")
    ).select("doc_id", "lang", "source", "n_chars", "quality")


@query("P10", "non_case_filter", r"""select doc_id, n_chars from documents where not (length(text) < 2
  or (regexp_matches(text, '^\d{4,}') and not regexp_matches(text, '[@]')) or regexp_matches(text, '(?i)token|^then|[|] |!!|\d{5}'))""")
def _(s, sf):
    return table(s, sf, "documents").filter(
        ~N.is_non_case(c("text"), ["token", "^then", "[|] ", "!!", r"\d{5}"], "@")).select("doc_id", "n_chars")


@query("P11", "untagged_worklist", """with a as (select doc_id, source || '/' || lpad(doc_id::varchar, 9, '0') || '_' || lang || '.txt' as rel_path, lang, source, text from documents
  where doc_id not in (select doc_id from labels))
select doc_id, rel_path from a where lang <> 'es' and source <> 'src7' and lang <> 'de' and text not like '%!!%' order by rel_path limit 200""")
def _(s, sf):
    d = table(s, sf, "documents").join(table(s, sf, "labels"), "doc_id", "left")
    name = F.concat(F.lpad(c("doc_id").cast("string"), 9, "0"), lit("_"), c("lang"), lit(".txt"))
    rows = d.select("doc_id", name.alias("filename"), F.concat_ws("/", "source", name).alias("rel_path"), c("quality").alias("city"),
                    F.when(c("lang") != "es", F.array(c("source"), F.when(c("text").contains("!!"), "host").otherwise("none"))).alias("tags"),
                    lit("nas").alias("source"))
    return R.untagged_worklist(rows, "nas", "src7", "host", "d", limit=200).select("doc_id", "rel_path")


TRIAGE = """tr as (select doc_id, n_chars, case when doc_id in (select doc_id from labels where quality = 1) then 'done' when contains(text, '###') then 'pre-tagged'
  when contains(text, '!!') then 'rule-skip' else 'pending' end as status, case when regexp_matches(text, 'token|tion the') then 0 else 1 end as priority from documents)"""


def triaged(s, sf):
    done = table(s, sf, "labels").filter(c("quality") == 1)
    return R.pending_triage(table(s, sf, "documents"), "doc_id", done, c("text"), c("text"), "###", "!!", "token|tion the")


@query("P12", "pending_triage", f"with {TRIAGE} select doc_id, status, priority from tr")
def _(s, sf):
    return triaged(s, sf).select("doc_id", "status", "priority")


@query("P12", "pending_triage_worklist", f"with {TRIAGE} select doc_id, n_chars, priority from tr where status = 'pending' order by priority, doc_id limit 150")
def _(s, sf):
    return R.triage_worklist(triaged(s, sf), "doc_id", 150).select("doc_id", "n_chars", "priority")


@query("P13", "hash_shard", f"""with s as (select o_orderkey, ({crc32_sql("o_orderkey")} % 4)::int as shard from orders)
select shard, count(*) as rows, min(o_orderkey) as first_key from s group by 1""")
def _(s, sf):
    o = table(s, sf, "orders").withColumn("shard", R.shard_of(c("o_orderkey"), 4))
    return o.groupBy("shard").agg(F.count(lit(1)).alias("rows"), F.min("o_orderkey").alias("first_key"))


@query("P13", "hash_shard_cover", "select count(*) as rows, sum(o_orderkey)::bigint as key_sum, 4::bigint as shards from orders")
def _(s, sf):
    k = c("o_orderkey")
    parts = table(s, sf, "orders").withColumn("shard", R.shard_of(k, 4)).groupBy("shard").agg(
        F.count(lit(1)).alias("n"), F.sum(k).alias("ks"))
    return parts.agg(F.sum("n").alias("rows"), F.sum("ks").alias("key_sum"), F.count(lit(1)).alias("shards"))


@query("P14", "needs_transcode", """select p_partkey, p_type, p_type in ('PROMO', 'LARGE') and p_name not like 'red%' and p_brand like 'Brand#1%' as transcode,
  p_type = 'SMALL' and right(p_name, 4) in ('ring', 'gear') as probe from part""")
def _(s, sf):
    codec = F.when(c("p_type") != "SMALL", c("p_type"))
    path = F.when(~c("p_name").startswith("red"), c("p_name"))
    return table(s, sf, "part").select(
        "p_partkey", "p_type",
        F.coalesce(R.needs_transcode(codec, path, F.left("p_brand", lit(7)), ["PROMO", "LARGE"], "Brand#1"), lit(False)).alias("transcode"),
        R.needs_probe(codec, F.right("p_name", lit(4)), ["RING", "gear"]).alias("probe"))


@query("P15", "date_window", "select o_orderkey, o_custkey, o_orderdate::date as day from orders where o_orderdate::date between date '1999-03-01' and date '1999-03-07'")
def _(s, sf):
    o = table(s, sf, "orders").withColumn("day", F.to_date("o_orderdate"))
    return o.filter(R.date_window(c("day"), F.to_date(lit("1999-03-01")))).select("o_orderkey", "o_custkey", "day")


@query("P16", "exclude_keywords_any", "select doc_id, lang from documents where not (contains(text, '###') or contains(text, '!!') or contains(text, 'token') or contains(text, ' than '))")
def _(s, sf):
    return table(s, sf, "documents").filter(~R.contains_any(c("text"), ["###", "!!", "token", " than "])).select("doc_id", "lang")


@query("P17", "age_window_filter", """with m as (select max(ts) as ref from events) select event_id from events, m
where event_type = 'signup' or epoch_us(ref) - epoch_us(ts) <= 6 * 3600000000""")
def _(s, sf):
    e = table(s, sf, "events")
    ts = F.when(c("event_type") != "signup", c("ts"))
    return e.filter(R.recent_or_unknown(ts, e.agg(F.max("ts")).scalar())).select("event_id")


@query("P18", "rule_verdict_by_tags", """select p_partkey, case when p_type = 'ECONOMY' or p_name like 'old %' then null
  when p_name like 'red %' or p_name like '% gear' then 'host' when p_name like '% ring' or p_name like 'hot %' then 'no-host' end as verdict from part""")
def _(s, sf):
    tags = F.when(c("p_type") != "ECONOMY", F.split("p_name", " "))
    return table(s, sf, "part").select("p_partkey", V.verdict_by_tags(
        tags, ["old"], ["red", "gear"], ["ring", "hot"], "host", "no-host").alias("verdict"))


@query("P19", "auto_apply_gate", """with a as (select l_orderkey, l_linenumber, l_partkey, l_suppkey, round(l_discount * 10, 2) + 0.0 as conf,
   replace(p_name, ' ', case when p_type = 'PROMO' then '/' else '_' end) as place, l_returnflag = 'R' as excluded, p_size // 30 + 1 as n from lineitem join part on l_partkey = p_partkey)
select l_orderkey, l_linenumber, l_partkey, l_suppkey, case when conf < 0.5::double then 'unsure' when length(place) > 9 then 'long-place'
  when contains(place, '/') then 'odd-place' when excluded then 'excluded' when n > 1 then 'many-cities' else 'ok' end as reason, conf, length(place) as place_chars, n::bigint as cities from a""")
def _(s, sf):
    place = F.when(c("p_type") == "PROMO", F.translate("p_name", " ", "/")).otherwise(F.translate("p_name", " ", "_"))
    conf, cities = F.round(c("l_discount") * 10, 2) + 0.0, F.floor(c("p_size") / 30) + 1
    reason = V.auto_apply_reason(conf, place, c("l_returnflag") == "R", cities, min_conf=0.5, max_len=9)
    return table(s, sf, "lineitem").join(table(s, sf, "part"), c("l_partkey") == c("p_partkey")).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", reason.alias("reason"), conf.alias("conf"),
        F.length(place).cast("bigint").alias("place_chars"), cities.alias("cities"))


@query("P20", "safe_path_validate", rf"""with {PAGE_PATHS}, a as (select page_id, case when contains(url, '?') then '/' || path when contains(url, '#top') then replace(path, '/', '/../')
   when host like 'm.%' then '' else path end as p from pp)
select page_id, case when p = '' then 'no-path' when starts_with(p, '/') then 'absolute-path'
  when len(list_filter(string_split(p, '/'), lambda x: x in ('', '.', '..'))) > 0 then 'dot-segment' end as reason from a""")
def _(s, sf):
    p = (F.when(c("url").contains("?"), F.concat(lit("/"), c("path"))).when(c("url").contains("#top"), F.replace(c("path"), lit("/"), lit("/../")))
         .when(c("host").startswith("m."), "").otherwise(c("path")))
    return page_paths(s, sf).select("page_id", P.safe_path_reason(p).alias("reason"))
