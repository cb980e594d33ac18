"""Table maintenance rows (K)."""

from pyspark.sql import functions as F

from shelfmark.operators import maintenance as M
from shelfmark.plans.bindings import CUSTOMER_GEO, PAGE_PATHS, customer_geo, page_paths
from shelfmark.plans.registry import query, table
from shelfmark.session import shared_path

c, lit = F.col, F.lit


@query("K1", "upsert_merge", """with s as (select c_custkey as k, c_name as n, c_acctbal + 1 as b from customer where c_mktsegment = 'MACHINERY'
    union all select -1 - s_suppkey, s_name, s_acctbal from supplier)
select coalesce(k, c_custkey) as c_custkey, case when k is not null then n else c_name end as c_name,
  round(case when k is not null then b else c_acctbal end, 2) as c_acctbal, c_mktsegment from customer full join s on c_custkey = k""")
def _(s, sf):
    t = table(s, sf, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    upd = t.filter(c("c_mktsegment") == "MACHINERY").select("c_custkey", "c_name", (c("c_acctbal") + 1).alias("c_acctbal"))
    new = table(s, sf, "supplier").select((-1 - c("s_suppkey")).alias("c_custkey"), c("s_name").alias("c_name"),
                                          c("s_acctbal").alias("c_acctbal"))
    return M.upsert_merge(t, upd.unionByName(new), "c_custkey").withColumn("c_acctbal", F.round("c_acctbal", 2))


def size_patch(s, sf):
    hot = table(s, sf, "lineitem").filter((c("l_returnflag") == "R") & (c("l_quantity") == 50))
    return hot.select(c("l_partkey").alias("p_partkey")).distinct().withColumn("p_size", lit(99))


@query("K2", "partial_update", """select p_partkey, p_name, case when p_partkey in (select l_partkey from lineitem where l_returnflag = 'R' and l_quantity = 50)
  then 99 else p_size end as p_size from part""")
def _(s, sf):
    return M.partial_update(table(s, sf, "part").select("p_partkey", "p_name", "p_size"), size_patch(s, sf), "p_partkey")


@query("K2", "partial_update_report", """select count(distinct l_partkey) as asked, count(distinct p_partkey) as matched,
  case when count(p_partkey) > 0 then 'ok' else 'failed' end as status
from lineitem left join (select p_partkey from part where p_type = 'PROMO') on l_partkey = p_partkey where l_returnflag = 'R' and l_quantity = 50""")
def _(s, sf):
    return M.partial_update_report(table(s, sf, "part").filter(c("p_type") == "PROMO"), size_patch(s, sf), "p_partkey")


@query("K3", "grouped_bulk_update", f"""with {CUSTOMER_GEO},
a as (select city, c_mktsegment, c_custkey, (row_number() over (partition by city, c_mktsegment order by c_custkey) - 1) // 100 as chunk from cg)
select city, c_mktsegment, chunk, string_agg(c_custkey::varchar, ',' order by c_custkey) as keys from a group by 1, 2, 3""")
def _(s, sf):
    return M.grouped_bulk_update(customer_geo(s, sf), "c_custkey", ["city", "c_mktsegment"]).withColumn(
        "keys", F.array_join("keys", ","))


@query("K4", "delete_by_keys", "select o_orderkey, o_orderstatus from orders where o_orderkey not in (select l_orderkey from lineitem where l_returnflag = 'A')")
def _(s, sf):
    gone = table(s, sf, "lineitem").filter(c("l_returnflag") == "A").select(c("l_orderkey").alias("o_orderkey"))
    return M.delete_by_keys(table(s, sf, "orders").select("o_orderkey", "o_orderstatus"), gone, ["o_orderkey"])


def scanned_orders(s, sf):
    li = table(s, sf, "lineitem").groupBy("l_orderkey").agg(
        F.bool_or(c("l_returnflag") == "A").alias("a"),
        F.bool_or((c("l_returnflag") == "A") & (c("l_linestatus") == "O")).alias("ao"))
    o = table(s, sf, "orders").join(li, c("o_orderkey") == c("l_orderkey"), "left")
    p = c("o_orderpriority")
    seen = ((p == "5-LOW") | ((p == "1-URGENT") & c("a").isNotNull()) | ((p == "2-HIGH") & F.coalesce("a", lit(False)))
            | ((p == "3-MEDIUM") & F.coalesce("ao", lit(False))))
    return o.filter(seen).select("o_orderkey", "o_orderpriority")


SCANNED = """li as (select l_orderkey, bool_or(l_returnflag = 'A') as a, bool_or(l_returnflag = 'A' and l_linestatus = 'O') as ao from lineitem group by 1),
so as (select o_orderkey, o_orderpriority from orders left join li on o_orderkey = l_orderkey where o_orderpriority = '5-LOW'
  or (o_orderpriority = '1-URGENT' and a is not null) or (o_orderpriority = '2-HIGH' and a) or (o_orderpriority = '3-MEDIUM' and ao)),
rep as (select o.o_orderpriority, count(so.o_orderkey) as scanned, count(*) as stored, count(*) - count(so.o_orderkey) as stale
  from orders o left join so using (o_orderkey) group by 1 having count(so.o_orderkey) > 0),
act as (select *, case when stale = 0 then 'clean' when stale > scanned * 0.5 then 'skip' else 'prune' end as action from rep)"""


@query("K5", "guarded_prune_plan", f"with {SCANNED} select o_orderpriority, scanned, stored, stale, action from act")
def _(s, sf):
    return M.prune_plan(table(s, sf, "orders"), scanned_orders(s, sf), "o_orderkey", "o_orderpriority")


@query("K5", "guarded_prune", f"""with {SCANNED} select o_orderkey, o_orderpriority from orders left join act using (o_orderpriority)
where not (coalesce(action, '') = 'prune' and o_orderkey not in (select o_orderkey from so))""")
def _(s, sf):
    stored = table(s, sf, "orders").select("o_orderkey", "o_orderpriority")
    return M.guarded_prune(stored, scanned_orders(s, sf), "o_orderkey", "o_orderpriority")


@query("K6", "full_refresh_replace", """select o_orderkey, o_custkey, cast(o_orderdate as date) as day from orders
where o_orderdate between timestamp '2001-07-01' and timestamp '2001-07-07'""")
def _(s, sf):
    path = shared_path(s, "schedule")
    rows = table(s, sf, "orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("day"))
    M.full_refresh(rows.filter(c("day") < "2001-07-01"), path)
    return M.full_refresh(rows.filter(c("day").between("2001-07-01", "2001-07-07")), path)


@query("K7", "insert_ignore", """with b as (select c_custkey, c_name, c_acctbal, row_number() over (partition by c_custkey // 5 order by c_custkey) as r from customer)
select s_suppkey, s_name, null::varchar as note from supplier union all
select c_custkey // 5, c_name, '{"bal":' || c_acctbal || '}' from b where r = 1 and c_custkey // 5 not in (select s_suppkey from supplier)""")
def _(s, sf):
    batch = table(s, sf, "customer").select(
        F.floor(c("c_custkey") / 5).alias("s_suppkey"), c("c_name").alias("s_name"), c("c_custkey").alias("is_vertical"),
        F.to_json(F.struct(c("c_acctbal").alias("bal"))).alias("note"), "c_custkey")
    t = table(s, sf, "supplier").select("s_suppkey", "s_name")
    return M.insert_ignore(t, batch, "s_suppkey", [F.asc("c_custkey")], ["is_vertical"]).select("s_suppkey", "s_name", "note")


KEYS = {"region": ["r_regionkey"], "nation": ["n_nationkey"], "customer": ["c_custkey"], "supplier": ["s_suppkey"],
        "part": ["p_partkey"], "orders": ["o_orderkey"], "events": ["event_id"],
        "lineitem": ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"],
        "documents": ["doc_id"], "embeddings": ["vec_id"], "pages": ["page_id"], "benchmark": ["item_id"],
        "labels": ["doc_id"], "conversations": ["conv_id", "turn"]}


@query("K8", "backup_export_manifest", " union all ".join(f"select '{t}' as name, count(*) as rows, null as error from {t}" for t in KEYS)
       + " union all select 'absent', null, 'AnalysisException'")
def _(s, sf):
    tables = {t: (f"{sf}/{t}.parquet", keys) for t, keys in KEYS.items()}
    tables["absent"] = (f"{sf}/absent.parquet", ["id"])
    return M.export_all(s, tables, shared_path(s, "backup")).select("name", "rows", "error")


THRESHOLDS = [("customer", 1000), ("orders", 20000), ("events", 1000), ("absent", 1)]


@query("K9", "restore_verify", """with g(name, got) as (select 'customer', count(*) from customer union all select 'orders', count(*) from orders
  union all select 'events', count(*) from events), t(name, expected) as (values ('customer', 1000::bigint), ('orders', 20000), ('events', 1000), ('absent', 1))
select name, expected, coalesce(got, 0) as got, coalesce(got, 0) >= expected as ok from t left join g using (name)""")
def _(s, sf):
    root, names = shared_path(s, "backup"), ["customer", "orders", "events"]
    M.export_all(s, {t: (f"{sf}/{t}.parquet", KEYS[t]) for t in names}, root)
    restored = M.restore_all(s, root, {t: KEYS[t] for t in names}, f"{root}-restored")
    return M.restore_verify(restored.select("name", F.col("rows").alias("got")), s.createDataFrame(THRESHOLDS, "name string, expected bigint"))


@query("K9", "restore_drill_rows", "select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer")
def _(s, sf):
    root = shared_path(s, "backup")
    M.export_all(s, {"customer": (f"{sf}/customer.parquet", KEYS["customer"])}, root)
    for _ in range(2):      # a repeated drill adds nothing
        M.restore_all(s, root, {"customer": KEYS["customer"]}, f"{root}-restored")
    return s.read.parquet(f"{root}-restored/customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")


@query("K10", "retention_prune", """with m as (select max(ts) as ref from events)
select event_type, count(*) filter (where not old) as kept, count(*) filter (where old) as pruned from
 (select event_type, epoch_us(ref) - epoch_us(ts) > 14 * 86400000000 and event_type like 'p%' as old from events, m) group by 1""")
def _(s, sf):
    e = table(s, sf, "events")
    split = M.retention_split(e, "ts", e.agg(F.max("ts")).scalar(), 14, "event_type", "p")
    return split.groupBy("event_type").agg(F.count_if(~c("pruned")).alias("kept"), F.count_if("pruned").alias("pruned"))


@query("K11", "journal_append", """select case when ts < timestamp '2024-01-16' then 'run-1' else 'run-2' end as run_id, count(*) as records,
  count(*) filter (where event_type = 'purchase') as successes from events group by 1""")
def _(s, sf):
    path = shared_path(s, "journal")
    e = table(s, sf, "events").select("event_id", "event_type", "ts")
    first, second = c("ts") < lit("2024-01-16").cast("timestamp_ntz"), c("ts") >= lit("2024-01-16").cast("timestamp_ntz")
    M.journal_append(e.filter(first), "run-1", path)
    M.journal_append(e.filter(second), "run-2", path)
    M.journal_append(e.filter(second), "run-2", path)      # a repeated run leaves one copy
    back = s.read.schema("event_id bigint, event_type string, ts timestamp_ntz, run_id string").parquet(path)
    return M.ledger(back, c("event_type") == "purchase")


@query("K12", "state_key_migration", rf"""with {PAGE_PATHS},
a as (select page_id, case when path like '%html' then 'v1:' || path when contains(url, '?') then replace('/' || scheme || '/' || path, '/', '\')
   else '/' || scheme || '/' || path end as k from pp),
b as (select *, replace(k, '\', '/') as z from a),
d as (select page_id, k, case when k like 'v1:%' then k when starts_with(z, '/https/') then 'v1:' || substr(z, 8)
   when starts_with(z, '/http/en/') then 'v2:' || substr(z, 10) else k end as key from b)
select key, arg_max(page_id, page_id) as page_id, count(*) filter (where key <> k) as converted from d group by key""")
def _(s, sf):
    raw = F.concat(lit("/"), c("scheme"), lit("/"), c("path"))
    key = (F.when(c("path").endswith("html"), F.concat(lit("v1:"), c("path")))
           .when(c("url").contains("?"), F.translate(raw, "/", "\\")).otherwise(raw))
    state = page_paths(s, sf).select("page_id", key.alias("key"), c("page_id").alias("seq"))
    return M.migrate_keys(state, "key", "page_id", "seq", [("/https/", "v1"), ("/http/en/", "v2")], ["v1", "v2"])
