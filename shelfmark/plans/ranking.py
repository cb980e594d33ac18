"""Sort, limit and set rows (L, O)."""

from pyspark.sql import functions as F

from shelfmark.operators import ranking as R
from shelfmark.operators.lanes import keep_ranked
from shelfmark.plans.registry import query, table

c, lit = F.col, F.lit


@query("L1", "top_n_counts", "select o_custkey, count(*) as rows from orders group by 1 order by rows desc, o_custkey limit 30")
def _(s, sf):
    return R.top_counts(table(s, sf, "orders"), "o_custkey", 30)


@query("L2", "candidate_rank_topk", """select source, doc_id, row_number() over (partition by source order by case lang when 'en' then 0 when 'fr' then 1 else 9 end, n_chars desc, doc_id)::int as pick
from documents qualify pick <= 3""")
def _(s, sf):
    rank = F.when(c("lang") == "en", 0).when(c("lang") == "fr", 1).otherwise(9)
    return keep_ranked(table(s, sf, "documents"), ["source"], [rank.asc(), F.desc("n_chars"), F.asc("doc_id")], 3,
                       rank_col="pick").select("source", "doc_id", "pick")


@query("L3", "preview_with_remainder", """select doc_id, greatest((select count(*) from documents where doc_id not in (select doc_id from labels)) - 20, 0) as more
from documents where doc_id not in (select doc_id from labels) order by doc_id limit 20""")
def _(s, sf):
    stale = table(s, sf, "documents").select("doc_id").join(table(s, sf, "labels"), "doc_id", "left_anti")
    return R.preview_with_remainder(stale, [F.asc("doc_id")])


@query("L4", "latest_named_period", """with a as (select case when o_orderstatus = 'P' and year(o_orderdate) < 2001 then year(o_orderdate) || '年' when o_orderstatus = 'O' then 'x' || year(o_orderdate)
  else year(o_orderdate) || '年' || month(o_orderdate) || '月' end as t from orders),
b as (select t, regexp_extract(t, '^(\\d{4})年', 1)::int as y, coalesce(nullif(regexp_extract(t, '^\\d{4}年(\\d{1,2})月$', 1), '')::int, 13) as m from a where t not like 'x%')
select t as title, y as year, m as month from b order by y desc, m desc, t desc limit 1""".replace(chr(92) * 2, chr(92)))
def _(s, sf):
    y, m = F.year("o_orderdate").cast("string"), F.month("o_orderdate").cast("string")
    t = (F.when((c("o_orderstatus") == "P") & (F.year("o_orderdate") < 2001), F.concat(y, lit("年")))
         .when(c("o_orderstatus") == "O", F.concat(lit("x"), y)).otherwise(F.concat(y, lit("年"), m, lit("月"))))
    return R.latest_named_period(table(s, sf, "orders").select(t.alias("t")), "t")


@query("L5", "page_slice", "select doc_id, n_chars, (select count(*) from documents) as total from documents order by n_chars desc, doc_id limit 25 offset 50")
def _(s, sf):
    return R.page_slice(table(s, sf, "documents").select("doc_id", "n_chars"), [F.desc("n_chars"), F.asc("doc_id")], 50, 25)


@query("L6", "recent_events", "select event_id, event_type from (select * from events order by ts desc, event_id desc limit 15) where event_type <> 'view'")
def _(s, sf):
    e = table(s, sf, "events").select("event_id", "event_type", "ts")
    return R.recent_then_filter(e, [F.desc("ts"), F.desc("event_id")], 15, c("event_type") != "view").select("event_id", "event_type")


@query("L7", "recent_per_key", "select user_id, event_id, event_type from events qualify row_number() over (partition by user_id order by ts desc, event_id) <= 3")
def _(s, sf):
    return keep_ranked(table(s, sf, "events"), ["user_id"], [F.desc("ts"), F.asc("event_id")], 3).select("user_id", "event_id", "event_type")


@query("O1", "union_sources", """select 'customer' as party, c_custkey as key, c_name as name, c_mktsegment as segment from customer
union all select 'supplier', s_suppkey, s_name, null from supplier""")
def _(s, sf):
    a = table(s, sf, "customer").select(lit("customer").alias("party"), c("c_custkey").alias("key"), c("c_name").alias("name"),
                                        c("c_mktsegment").alias("segment"))
    b = table(s, sf, "supplier").select(lit("supplier").alias("party"), c("s_suppkey").alias("key"), c("s_name").alias("name"))
    return a.unionByName(b, allowMissingColumns=True)


@query("O2", "except_keys", "select l_orderkey as k from lineitem where l_returnflag = 'A' except select l_orderkey from lineitem where l_linestatus = 'O'")
def _(s, sf):
    li = table(s, sf, "lineitem")
    k = c("l_orderkey").alias("k")
    return li.filter(c("l_returnflag") == "A").select(k).subtract(li.filter(c("l_linestatus") == "O").select(k))


@query("O3", "intersect_keys", "select c_nationkey as n from customer where c_acctbal > 9900 intersect select s_nationkey from supplier where s_acctbal > 5000")
def _(s, sf):
    a = table(s, sf, "customer").filter(c("c_acctbal") > 9900).select(c("c_nationkey").alias("n"))
    return a.intersect(table(s, sf, "supplier").filter(c("s_acctbal") > 5000).select(c("s_nationkey").alias("n")))


@query("O4", "distinct_values", "select o_orderstatus, o_orderpriority, min(o_orderkey) as first_seen from orders group by 1, 2 order by 3")
def _(s, sf):
    return table(s, sf, "orders").groupBy("o_orderstatus", "o_orderpriority").agg(F.min("o_orderkey").alias("first_seen")).orderBy("first_seen")
