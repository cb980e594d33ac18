"""Window rows (W)."""

from pyspark.sql import functions as F

from shelfmark.functions.paths import extract_version
from shelfmark.functions.values import hours_between
from shelfmark.operators import schedule as S
from shelfmark.operators import windows as W
from shelfmark.operators.lanes import keep_ranked
from shelfmark.plans.aggregates import KEEPERS, keeper_rows
from shelfmark.plans.columns import VERSIONED, versioned_name
from shelfmark.plans.registry import query, table
from shelfmark.sources.tables import spread

c, lit = F.col, F.lit

VERSION_FLAGS = f"""with {VERSIONED}, sc as (select *, p_type <> 'LARGE' as in_scope, p_brand = 'Brand#1' as was_old from v),
vf as (select *, was_old or (in_scope and row_number() over (partition by in_scope, p_type, base, ext order by version desc, p_partkey) > 1) as is_old from sc)"""


def flagged_parts(s, sf):
    p = table(s, sf, "part").withColumn("v", extract_version(versioned_name())).select(
        "p_partkey", "p_type", "v.base", "v.version", "v.ext", (c("p_brand") == "Brand#1").alias("is_old"))
    return W.latest_version_flag(p, ["p_type", "base", "ext"], "version", "p_partkey", c("p_type") != "LARGE")


@query("W1", "latest_version_flag", f"{VERSION_FLAGS} select p_partkey, is_old, is_old and not was_old as newly_marked from vf")
def _(s, sf):
    return flagged_parts(s, sf).select("p_partkey", "is_old", "newly_marked")


@query("W1", "latest_version_counts", f"{VERSION_FLAGS} select p_type, count(*) as rows, count(*) filter (where is_old) as old, count(*) filter (where is_old and not was_old) as marked from vf group by 1")
def _(s, sf):
    return flagged_parts(s, sf).groupBy("p_type").agg(
        F.count(lit(1)).alias("rows"), F.count_if("is_old").alias("old"), F.count_if("newly_marked").alias("marked"))


@query("W2", "keeper_selection", f"with {KEEPERS} select doc_id, keeper, copies, plan from kplan")
def _(s, sf):
    return keeper_rows(s, sf).select("doc_id", "keeper", "copies", "plan")


@query("W3", "distinct_on", """select user_id, event_id, event_type, value from events qualify row_number() over (partition by user_id order by ts desc, event_id) = 1""")
def _(s, sf):
    return keep_ranked(table(s, sf, "events"), ["user_id"], [F.desc("ts"), F.asc("event_id")]).select("user_id", "event_id", "event_type", "value")


@query("W4", "year_rollover", """with a as (select o_custkey, o_orderkey, month(o_orderdate) as mo, case when o_orderstatus = 'F' then 31 else day(o_orderdate) end as da, c_mktsegment = 'MACHINERY' as yo
   from orders join customer on o_custkey = c_custkey),
b as (select *, coalesce(mo < lag(mo) over (partition by o_custkey order by o_orderkey), false)::int as r from a),
d as (select *, sum(r) over (partition by o_custkey order by o_orderkey) as cum, sum(r) over (partition by o_custkey) as total from b)
select o_orderkey, try_cast(printf('%04d-%02d-%02d', (2020 - case when yo then total else 0 end + cum)::int, mo::int, da::int) as date) as date from d""")
def _(s, sf):
    o = table(s, sf, "orders").join(table(s, sf, "customer"), c("o_custkey") == c("c_custkey"))
    o = o.select("o_custkey", "o_orderkey", F.month("o_orderdate").alias("mo"), (c("c_mktsegment") == "MACHINERY").alias("year_only"),
                 F.when(c("o_orderstatus") == "F", 31).otherwise(F.dayofmonth("o_orderdate")).alias("da"))
    return S.year_rollover(o, "o_custkey", ["o_orderkey"], "mo", "da", lit(2020), c("year_only")).select("o_orderkey", "date")


def order_grid(s, sf):
    d = lambda n: F.date_format(F.date_add(F.to_date("o_orderdate"), n), "M/d")
    third = F.when(c("o_orderstatus") == "P", c("o_orderpriority")).otherwise(d(2))
    body1 = F.array(F.concat(c("o_orderpriority"), lit(" (ab)")), F.concat(c("o_orderstatus"), lit(" x (cd)")), lit("off (ab)"))
    body2 = F.array(F.concat(c("o_orderstatus"), lit(" y *2 (ab)")), c("o_orderpriority"), F.concat(c("o_custkey").cast("string"), lit("n (zz)")))
    rows = F.array(F.array(d(0), d(1), third), body1, body2)
    o = spread(table(s, sf, "orders")).select("o_custkey", "o_orderkey", F.posexplode(rows).alias("i", "cells"))
    return o.select(c("o_custkey").alias("sheet"), (c("o_orderkey") * 3 + c("i")).alias("row_idx"),
                    F.posexplode("cells").alias("col_idx", "cell"))


GRID = """g0 as (select o_custkey as sheet, o_orderkey * 3 as r, o_orderstatus as st, o_orderpriority as pr, o_custkey as ck, o_orderdate::date as d from orders),
fm as (select *, month(d) || '/' || day(d) as c0, month(d + 1) || '/' || day(d + 1) as c1, case when st = 'P' then pr else month(d + 2) || '/' || day(d + 2) end as c2 from g0),
grid as (select sheet, r as row_idx, unnest([0, 1, 2])::int as col_idx, unnest([c0, c1, c2]) as cell from fm union all
  select sheet, r + 1, unnest([0, 1, 2])::int, unnest([pr || ' (ab)', st || ' x (cd)', 'off (ab)']) from fm union all
  select sheet, r + 2, unnest([0, 1, 2])::int, unnest([st || ' y *2 (ab)', pr, ck || 'n (zz)']) from fm),
hd as (select sheet, row_idx as h, list(cell order by col_idx) as hc from grid where regexp_matches(cell, '^\\d{1,2}/\\d{1,2}') and length(cell) <= 10 group by 1, 2 having count(*) >= 3),
asg as (select g.sheet, g.row_idx, g.col_idx, g.cell, h, hc[g.col_idx + 1] as header_cell from grid g asof join hd on g.sheet = hd.sheet and g.row_idx >= hd.h
  where g.row_idx > h and g.row_idx - h <= 4)"""


@query("W5", "header_fill_assign", f"with {GRID.replace(chr(92) * 2, chr(92))} select sheet, row_idx, col_idx, cell, h as header_row, header_cell from asg")
def _(s, sf):
    g = order_grid(s, sf)
    return S.assign_headers(g, S.header_cells(g, "sheet"), "sheet").select("sheet", "row_idx", "col_idx", "cell", "header_row", "header_cell")


SCHEDULE = GRID.replace(chr(92) * 2, chr(92)) + r""",
hx as (select sheet, h, unnest([0, 1, 2])::int as col_idx, unnest(hc) as t from hd),
h1 as (select *, split_part(t, '/', 1)::int as mo, split_part(t, '/', 2)::int as da from hx),
h2 as (select *, coalesce(mo < lag(mo) over (partition by sheet order by h, col_idx), false)::int as r from h1),
h3 as (select *, try_cast(printf('%04d-%02d-%02d', (2000 + sum(r) over (partition by sheet order by h, col_idx rows unbounded preceding))::int, mo, da) as date) as dt from h2),
bo as (select a.sheet, a.h, row_idx, a.col_idx, cell, dt, case when contains(regexp_extract(cell, '\(([^)]+)\)', 1), 'ab') then 'ab' when contains(regexp_extract(cell, '\(([^)]+)\)', 1), 'cd') then 'cd' end as editor
  from asg a join h3 on a.sheet = h3.sheet and a.h = h3.h and a.col_idx = h3.col_idx where dt is not null and not contains(cell, 'off')),
ti as (select *, trim(regexp_replace(regexp_replace(trim(regexp_replace(cell, '\s*\([^)]+\)\s*$', '')), '\s*\*\s*\d+\s*$', ''), '\s+', ' ', 'g')) as case_name from bo where editor is not null)"""


@query("W5", "schedule_parse", f"""with {SCHEDULE}
select sheet, dt as date, case_name, editor from ti where case_name <> '' group by all""")
def _(s, sf):
    return S.parse_schedule(order_grid(s, sf), "sheet", lit(2000), lit(False), ["off"], ["ab", "cd"], [], [], [])


@query("W6", "dedupe_first_wins", """select o_orderkey, o_custkey, o_orderpriority from orders
qualify row_number() over (partition by o_custkey, o_orderpriority, o_orderdate > timestamp '1998-06-01' order by o_orderkey) = 1""")
def _(s, sf):
    o = table(s, sf, "orders").withColumn("late", c("o_orderdate") > lit("1998-06-01").cast("timestamp_ntz"))
    return W.dedupe_first(o, ["o_custkey", "o_orderpriority", "late"], ["o_orderkey"]).select("o_orderkey", "o_custkey", "o_orderpriority")


@query("W7", "dedupe_last_wins", """select user_id, event_type, event_id, value from events qualify row_number() over (partition by user_id, event_type order by ts desc, event_id desc) = 1""")
def _(s, sf):
    return W.dedupe_last(table(s, sf, "events"), ["user_id", "event_type"], ["ts", "event_id"]).select("user_id", "event_type", "event_id", "value")


DELTA_SQL = """with d as (select event_type, ts::date as day, count(*) as rows from events group by 1, 2),
e as (select *, rows - coalesce(lag(rows) over (partition by event_type order by day), rows) as rows_delta from d)
select event_type, day, rows, rows_delta from e where rows_delta <> 0"""


@query("W8", "run_delta", DELTA_SQL)
def _(s, sf):
    d = table(s, sf, "events").groupBy("event_type", F.to_date("ts").alias("day")).agg(F.count(lit(1)).alias("rows"))
    return W.run_delta(d, ["event_type"], "day", ["rows"])


STREAK_SQL = """with h as (select user_id, max((ts, event_id)) filter (where event_type not in ('error', 'view')) as hit from events group by 1),
l as (select e.user_id, event_type in ('error', 'view') and (hit is null or (ts, event_id) > hit) as live, ts from events e join h on e.user_id = h.user_id),
s as (select user_id, count(*) filter (where live) as streak, max(ts) filter (where live) as last_null from l group by 1)"""


@query("W9", "null_streak", f"""{STREAK_SQL} select user_id, streak, last_null, streak >= 3 as permanent, coalesce(streak = 3 and last_null::date = date '2024-01-30', false) as newly_permanent from s""")
def _(s, sf):
    return W.null_streak(table(s, sf, "events"), "user_id", ["ts", "event_id"], c("event_type").isin("error", "view"), "ts",
                         asof_day=F.to_date(lit("2024-01-30")))


@query("W10", "recent_ids_cap", "select event_type, event_id from events qualify row_number() over (partition by event_type order by ts desc, event_id desc) <= 1000")
def _(s, sf):
    return keep_ranked(table(s, sf, "events"), ["event_type"], [F.desc("ts"), F.desc("event_id")], 1000).select("event_type", "event_id")


@query("W11", "latest_artifact", """select event_type, max(ts) as latest, arg_max(event_id, (ts, event_id)) as event_id,
  round((epoch_us(timestamp '2024-02-01') - epoch_us(max(ts))) / 3600000000.0::double, 4) as age_hours from events group by 1""")
def _(s, sf):
    out = table(s, sf, "events").groupBy("event_type").agg(
        F.max("ts").alias("latest"), F.max_by("event_id", F.struct("ts", "event_id")).alias("event_id"))
    return out.withColumn("age_hours", F.round(hours_between(lit("2024-02-01").cast("timestamp"), c("latest")), 4))


@query("W12", "event_order_kind", """with a as (select *, o_orderstatus = 'P' as old, month(o_orderdate) as mo from orders)
select o_orderkey, case when live = 1 and not any_old then 'complete' else 'revised' end as kind from
 (select *, count(*) filter (where not old) over w as live, bool_or(old) over w as any_old from a window w as (partition by o_custkey, mo)) where not old""")
def _(s, sf):
    o = table(s, sf, "orders").withColumn("mo", F.month("o_orderdate"))
    return W.order_kind(o, ["o_custkey", "mo"], "o_orderkey", c("o_orderstatus") == "P").select("o_orderkey", "kind")
