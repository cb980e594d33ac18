"""Aggregation rows (A)."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark import constants as C
from shelfmark.functions.paths import derive_tags
from shelfmark.functions.values import hours_between
from shelfmark.operators import aggregates as A
from shelfmark.operators import windows as W
from shelfmark.operators.dictionary import vote
from shelfmark.plans.bindings import CUSTOMER_GEO, PAGE_PATHS, customer_geo, page_paths
from shelfmark.plans.registry import query, table

c, lit = F.col, F.lit


@query("A1", "count_by_dims", "select source, lang, count(*) as rows from documents group by all")
def _(s, sf):
    return A.count_by(table(s, sf, "documents"), ["source", "lang"])


@query("A1", "catalog_summary", f"""with {CUSTOMER_GEO},
a as (select o_orderkey, o_custkey, o_orderdate, o_orderpriority, city, district, o_orderpriority || ' ' || c_name || ' ' || o_orderstatus || ' ' || city || ' ' || district || ' ' || city || ' ' || district as st
  from orders join cg on o_custkey = c_custkey qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) = 1)
select city, district, count(*) as cases, sum(length(st))::bigint as text_chars, max(o_orderdate)::date as last_day from a group by 1, 2""")
def _(s, sf):
    from shelfmark.functions.text import build_search_text
    from shelfmark.operators.lanes import keep_ranked
    newest = keep_ranked(table(s, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus"),
                         ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")])
    rows = newest.join(customer_geo(s, sf), c("o_custkey") == c("c_custkey"))
    text = build_search_text(c("o_orderpriority"), c("c_name"), lit(""), lit(""), F.array("o_orderstatus"), c("city"), c("district"))
    return rows.withColumn("st", text).groupBy("city", "district").agg(
        F.count(lit(1)).alias("cases"), F.sum(F.length("st")).alias("text_chars"), F.to_date(F.max("o_orderdate")).alias("last_day"))


@query("A2", "distinct_count", "select count(distinct o_custkey) as names from orders")
def _(s, sf):
    return A.distinct_names(table(s, sf, "orders"), "o_custkey")


@query("A3", "conditional_counts", """select source, count(*) as total, count(quality) as labelled, count(*) filter (where quality is null and n_chars > 1000) as backlog,
  (100 * count(quality)) // count(*) as pct from documents left join labels using (doc_id) group by 1""")
def _(s, sf):
    d = table(s, sf, "documents").join(table(s, sf, "labels"), "doc_id", "left")
    return d.groupBy("source").agg(
        F.count(lit(1)).alias("total"), F.count("quality").alias("labelled"),
        F.count_if(c("quality").isNull() & (c("n_chars") > 1000)).alias("backlog"),
        A.percent(F.count("quality"), F.count(lit(1))).alias("pct"))


@query("A4", "mode_vote", """select p_brand, p_type, votes from (select p_brand, p_type, count(*) as votes from part group by all)
qualify row_number() over (partition by p_brand order by votes desc, p_type) = 1""")
def _(s, sf):
    return vote(table(s, sf, "part"), ["p_brand"], ["p_type"])


@query("A5", "group_representative", """select l_orderkey, arg_min(l_partkey, (l_linenumber, l_partkey, l_suppkey, l_extendedprice)) as l_partkey,
  arg_min(l_suppkey, (l_linenumber, l_partkey, l_suppkey, l_extendedprice)) as l_suppkey, count(*) as rows from lineitem group by 1""")
def _(s, sf):
    return A.representatives(table(s, sf, "lineitem"), "l_orderkey",
                             ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"], ["l_partkey", "l_suppkey"])


def fingerprints(s, sf):
    return table(s, sf, "documents").select("doc_id", "n_chars", F.md5("text").alias("hash"), F.nullif(c("lang"), lit("es")).alias("lang"))


@query("A6", "duplicate_groups", """select md5(text) as hash, n_chars, lang, count(*) as copies, min(doc_id) as first_id from documents where lang <> 'es' group by 1, 2, 3 having count(*) >= 2""")
def _(s, sf):
    return A.duplicate_groups(fingerprints(s, sf), ["hash", "n_chars", "lang"], "doc_id")


@query("A6", "duplicate_rejects", "select count(*) filter (where lang = 'es') as rejected, count(*) as rows from documents")
def _(s, sf):
    return A.rejected_rows(fingerprints(s, sf), ["hash", "n_chars", "lang"])


@query("A7", "all_members_predicate", """select o_custkey, count(*) as members from orders group by 1
having bool_and(coalesce(case when o_orderstatus <> 'P' or o_totalprice < 400000 then o_orderdate end <= timestamp '2001-01-15', false))""")
def _(s, sf):
    ts = F.when((c("o_orderstatus") != "P") | (c("o_totalprice") < 400000), c("o_orderdate"))
    return A.all_older(table(s, sf, "orders").withColumn("mtime", ts), "o_custkey", "mtime", lit("2001-01-15").cast("timestamp_ntz"))


KEEPERS = """kp as (select doc_id, n_chars, md5(text) as content, concat_ws('|', lang, n_chars) as grp, md5(text || source) as canon, quality is distinct from 0 as usable, doc_id as mt from documents left join labels using (doc_id)),
k1 as (select grp, arg_min(doc_id, doc_id) filter (where usable) as keeper, arg_min(content, doc_id) filter (where usable) as kc,
   arg_min(canon, doc_id) filter (where usable) as kn, count(*) as copies from kp group by 1),
kplan as (select doc_id, n_chars, keeper, copies, case when copies < 2 then 'single' when keeper is null then 'no-keeper' when doc_id = keeper then 'keeper'
   when canon = kn then 'row-only' when content = kc then 'move' else 'hash-mismatch' end as plan from kp join k1 using (grp))"""


def keeper_rows(s, sf):
    d = table(s, sf, "documents").join(table(s, sf, "labels"), "doc_id", "left")
    rows = d.select("doc_id", "n_chars", F.concat_ws("|", "lang", "n_chars").alias("grp"), F.md5("text").alias("content"),
                    F.md5(F.concat("text", "source")).alias("canon"), (~c("quality").eqNullSafe(0)).alias("usable"),
                    F.timestamp_seconds(lit(2_000_000_000) - c("doc_id")).alias("mtime"))
    return W.keeper_plan(rows, ["grp"], "doc_id", "mtime", c("usable"), "content", "canon")


@query("A8", "dedupe_plan_summary", f"""with {KEEPERS} select count(*) filter (where plan = 'keeper') as groups, count(*) filter (where plan = 'move') as moves,
  count(*) filter (where plan = 'row-only') as row_only, coalesce(sum(n_chars) filter (where plan = 'move'), 0)::bigint as bytes_freed,
  count(*) filter (where plan = 'hash-mismatch') as hash_mismatch, count(*) filter (where plan = 'no-keeper') as no_keeper_rows from kplan""")
def _(s, sf):
    return W.dedupe_summary(keeper_rows(s, sf), "n_chars")


@query("A9", "status_histogram", """select coalesce(event_type, w) as event_type, count(event_type) as rows from events
full join (values ('click'), ('error'), ('pending-review')) v(w) on w = event_type group by 1""")
def _(s, sf):
    return A.status_histogram(table(s, sf, "events"), "event_type", ["click", "error", "pending-review"])


@query("A9", "status_top", "select event_type, count(*) as rows from events group by 1 order by rows desc, event_type limit 3")
def _(s, sf):
    return A.status_histogram(table(s, sf, "events"), "event_type", ["pending-review"], top=3)


@query("A10", "sample_any_verdict", """select l_orderkey, case when count(*) filter (where l_returnflag <> 'N') = 0 then 'no_frames'
  when bool_or(l_returnflag <> 'N' and l_discount * 10 >= 0.95::double and l_quantity / 50 >= 0.5::double) then 'yes' else 'no' end as verdict from lineitem group by 1""")
def _(s, sf):
    return A.any_detection(table(s, sf, "lineitem"), "l_orderkey", c("l_returnflag") != "N", c("l_discount") * 10,
                           c("l_quantity") / 50, 0.95, 0.5)


@query("A11", "preferred_slot_rollup", """select user_id, ts::date as day, arg_min(value, (case when hour(ts) <> 6 then 1 else 0 end, ts, event_id)) as chosen, min(value) as lowest from events group by 1, 2""")
def _(s, sf):
    e = table(s, sf, "events").withColumn("day", F.to_date("ts"))
    return A.preferred_slot(e, ["user_id", "day"], "ts", "value", "event_id")


@query("A12", "progress_rate", """with a as (select count(quality) as processed, count(*) filter (where quality = 1) as hits, count(*) - count(quality) as remaining from documents left join labels using (doc_id))
select processed, hits, remaining, round(hits / processed::double, 6) as hit_rate, ceil(remaining / 250.0)::bigint as days_left,
  case when processed >= 50 then round_even(remaining * (hits / processed::double), 0) end as expected_hits from a""")
def _(s, sf):
    d = table(s, sf, "documents").join(table(s, sf, "labels"), "doc_id", "left")
    return A.progress(d, c("quality").isNotNull(), c("quality") == 1, 250).withColumn("hit_rate", F.round("hit_rate", 6))


@query("A13", "coverage_report", """select sum(d)::bigint as done, sum(t)::bigint as total, (100 * sum(d)::bigint) // sum(t)::bigint as pct from
 (select count(*) as d, 0 as t from labels union all select 0, count(*) from documents)""")
def _(s, sf):
    done = table(s, sf, "labels").agg(F.count(lit(1)).alias("d"), lit(0).cast("bigint").alias("t"))
    total = table(s, sf, "documents").agg(lit(0).cast("bigint").alias("d"), F.count(lit(1)).alias("t"))
    return done.unionAll(total).agg(F.sum("d").alias("done"), F.sum("t").alias("total"),
                                    A.percent(F.sum("d"), F.sum("t")).alias("pct"))


@query("A14", "keyset_collect_tags", rf"""with {PAGE_PATHS}, a as (select page_id, host, list_filter(string_split(path, '/'), lambda x: x <> '' and x not in ('en', '369')) as t,
  regexp_replace(regexp_extract(path, '([^/]*)$', 1), '\.[^.]*$', '') as stem from pp)
select page_id, array_to_string(list_sort(list_distinct(list_concat(t, ['case', host], case when stem <> '' then [stem] else [] end))), ',') as tags from a""")
def _(s, sf):
    tags = derive_tags(c("path"), lit("case"), c("host"), F.substring_index("path", "/", -1), ["en"], ["369"])
    return page_paths(s, sf).select("page_id", F.array_join(tags, ",").alias("tags"))


@query("A15", "fan_in_batches", """with a as (select o_orderkey, (row_number() over (order by o_orderkey) - 1) // 500 + 1 as batch from orders)
select batch, (select ceil(count(*) / 500.0)::bigint from orders) as total, string_agg(o_orderkey::varchar, ',' order by o_orderkey) as keys from a group by 1""")
def _(s, sf):
    return A.batches(table(s, sf, "orders"), "o_orderkey", 500).withColumn("keys", F.array_join("keys", ","))


RULES = [
    ("disk_pct", float(C.DISK_PERCENT[0]), float(C.DISK_PERCENT[1]), True, "warn"),
    ("backup_age_h", float(C.BACKUP_AGE_HOURS[0]), float(C.BACKUP_AGE_HOURS[1]), False, "critical"),
    ("backlog", float(C.BACKLOG_WARN), None, False, "warn"),
    ("snapshot_age_h", float(C.SNAPSHOT_AGE_HOURS), None, False, "critical"),
    ("probe", None, None, False, "warn"),
]
CARD = """me as (select 'disk_pct' as name, 100.0 * count(*) filter (where p_size < 43) / count(*) as value from part
  union all select 'backup_age_h', (epoch_us(timestamp '2024-01-31 12:00:00') - epoch_us(max(ts))) / 3600000000.0 from events where event_type = 'purchase'
  union all select 'backlog', count(*) from documents where doc_id not in (select doc_id from labels)
  union all select 'snapshot_age_h', (epoch_us(max(ts)) - epoch_us(max(ts) filter (where event_type = 'signup'))) / 3600000000.0 from events),
ru(name, warn, critical, inc, missing) as (values ('disk_pct', 80.0, 90.0, true, 'warn'), ('backup_age_h', 26.0, 30.0, false, 'critical'), ('backlog', 200.0, null, false, 'warn'),
   ('snapshot_age_h', 3.0, null, false, 'critical'), ('probe', null, null, false, 'warn')),
card as (select name, round(value::double, 4) as value, case when value is null then missing when coalesce(case when inc then value >= critical else value > critical end, false) then 'critical'
   when coalesce(case when inc then value >= warn else value > warn end, false) then 'warn' else 'ok' end as status
  from ru left join me using (name))"""


def card(s, sf):
    e, d = table(s, sf, "events"), table(s, sf, "documents")
    last = lambda cond: F.max(F.when(cond, c("ts")))
    parts = [
        table(s, sf, "part").agg((F.count_if(c("p_size") < 43) * 100.0 / F.count(lit(1))).alias("value")).withColumn("name", lit("disk_pct")),
        e.agg(hours_between(lit("2024-01-31 12:00:00").cast("timestamp"), last(c("event_type") == "purchase")).alias("value")).withColumn("name", lit("backup_age_h")),
        d.join(table(s, sf, "labels"), "doc_id", "left_anti").agg(F.count(lit(1)).cast("double").alias("value")).withColumn("name", lit("backlog")),
        e.agg(hours_between(F.max("ts"), last(c("event_type") == "signup")).alias("value")).withColumn("name", lit("snapshot_age_h")),
    ]
    metrics = reduce(DataFrame.unionByName, parts)
    return A.scorecard(metrics, s.createDataFrame(RULES, "name string, warn double, critical double, inclusive boolean, missing string"))


@query("A16", "health_scorecard", f"with {CARD} select name, value, status from card")
def _(s, sf):
    return card(s, sf).withColumn("value", F.round("value", 4))


@query("A16", "health_overall", f"""with {CARD} select case max(case status when 'critical' then 2 when 'warn' then 1 else 0 end) when 2 then 'critical' when 1 then 'warn' else 'ok' end as overall,
  count(*) filter (where status <> 'ok') as failing from card""")
def _(s, sf):
    return A.overall(card(s, sf))
