"""Source rows (S)."""

from pyspark.sql import functions as F

from shelfmark.plans.bindings import PAGE_PATHS, page_paths
from shelfmark.plans.registry import query, table
from shelfmark.session import shared_path
from shelfmark.sources import grids, inventory, journals, snapshots, tables

c, lit = F.col, F.lit


@query("S1", "file_inventory")
def _(s, sf):
    return inventory.file_inventory(s, sf, "v1", ["parquet"], prune_names=["_temporary"], prune_prefixes=["#", "@"])


@query("S2", "snapshot_envelope_read", """select '2024-01-31T00:00:00Z' as scanned_at, true as count_ok,
  c_custkey, c_name, c_mktsegment from customer""")
def _(s, sf):
    path = shared_path(s, "envelopes")
    rows = table(s, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    snapshots.write_envelopes(rows, "c_custkey", path, lit("2024-01-31T00:00:00Z"))
    return snapshots.read_envelopes(s, path, "c_custkey:bigint,c_name:string,c_mktsegment:string")


@query("S3", "dict_lookup_read", """select event_id, u.key as key, u.value as value from (select event_id,
  unnest([{'key': 'k', 'value': props->>'k'}, {'key': 'type', 'value': case when event_type <> 'error' then event_type end}]) as u
  from events) where u.value is not null""")
def _(s, sf):
    kind = F.when(c("event_type") != "error", c("event_type")).otherwise("")
    text = F.concat(lit('{"k":"'), F.get_json_object("props", "$.k"), lit('","type":"'), kind, lit('","_comment":"x"}'))
    return snapshots.dict_entries(table(s, sf, "events").select("event_id", text.alias("text")), "text", "string", ["_comment"])


def journal_lines(s, sf):
    bad = F.concat(lit('{"id": '), c("event_id").cast("string"), lit(', "status": '), F.repeat(c("event_type"), 120))
    good = F.to_json(F.struct(c("event_id").alias("id"), F.when(c("event_type") == "purchase", "tag").otherwise(
        c("event_type")).alias("status"), F.when(c("value") > 20, c("value")).alias("place")))
    return table(s, sf, "events").select("event_id", F.when(c("event_type") == "error", bad)
                                         .when(c("event_type") == "signup", "  ").otherwise(good).alias("line"))


@query("S4", "journal_read_tolerant", """select event_id, case event_type when 'error' then 'mv-fail' when 'purchase' then 'tag' else event_type end as status,
  case when event_type <> 'error' then event_id end as id, case when event_type <> 'error' and value > 20 then value end as place,
  case when event_type = 'error' then left('{"id": ' || event_id || ', "status": ' || repeat(event_type, 120), 500) || '...<truncated>' end as raw
from events where event_type <> 'signup'""")
def _(s, sf):
    return journals.parse_tolerant(journal_lines(s, sf), "line", "id bigint, status string, place double")


@query("S5", "journal_read_dropping", """select event_id as id, value as place from events where event_type = 'purchase' and value > 20""")
def _(s, sf):
    path = shared_path(s, "journal")
    journal_lines(s, sf).select("line").write.text(path)
    return journals.read_dropping(s, path, "id bigint, status string, place double", "tag", ("id", "place")).select("id", "place")


@query("S6", "table_scan_offset_paged", "select o_orderkey, o_custkey, o_totalprice from orders")
def _(s, sf):
    o = table(s, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    twice = o.unionAll(o.filter(c("o_orderstatus") == "P"))      # pages that shifted under writes
    return tables.scan_once(twice, "o_orderkey").select("o_orderkey", "o_custkey", "o_totalprice")


@query("S7", "table_scan_keyset", "select o_orderkey, o_orderdate, o_totalprice from orders where o_orderkey > 499 order by o_orderkey limit 1000")
def _(s, sf):
    return tables.keyset_page(table(s, sf, "orders").select("o_orderkey", "o_orderdate", "o_totalprice"), "o_orderkey", 499)


@query("S7", "table_scan_keyset_pages", """with a as (select o_orderkey, (row_number() over (order by o_orderkey) - 1) // 1000 + 1 as page from orders)
select page, min(o_orderkey) as first_key, max(o_orderkey) as last_key, count(*) as rows from a group by page""")
def _(s, sf):
    return tables.keyset_pages(table(s, sf, "orders"), "o_orderkey")


@query("S8", "grid_long_read", """with a as (select o_orderkey, case o_orderstatus when 'F' then [o_orderstatus] when 'P' then
    [o_orderstatus, o_orderpriority, '', ''] else [o_orderstatus, o_orderpriority, month(o_orderdate) || '/' || day(o_orderdate), 'x'] end as g from orders)
select o_orderkey, i::int as col_idx, coalesce(g[i + 1], '') as cell from a, range(0, 4) r(i)""")
def _(s, sf):
    line = (F.when(c("o_orderstatus") == "F", c("o_orderstatus"))
            .when(c("o_orderstatus") == "P", F.concat_ws(",", "o_orderstatus", "o_orderpriority"))
            .otherwise(F.concat_ws(",", "o_orderstatus", "o_orderpriority", F.date_format("o_orderdate", "M/d"), lit("x"))))
    return tables.grid_long(table(s, sf, "orders"), "o_orderkey", F.split(line, ","))


@query("S8", "grid_files_read", """with g as (select o_orderpriority as sheet, row_number() over (partition by o_orderpriority order by o_orderkey) - 1 as row_idx,
  case o_orderstatus when 'F' then [o_orderkey::varchar] when 'P' then [o_orderkey::varchar, 'a, ' || o_orderstatus, '', 'x']
    else [o_orderkey::varchar, 'say "' || o_orderstatus || '"', 'two' || chr(10) || 'lines'] end as cells from orders),
w as (select sheet, max(len(cells)) as width from g group by 1)
select sheet, row_idx, i::int as col_idx, coalesce(cells[i + 1], '') as cell from g join w using (sheet), range(0, 4) r(i) where i < width""")
def _(s, sf):
    key, status = c("o_orderkey").cast("string"), c("o_orderstatus")
    cells = (F.when(status == "F", F.array(key)).when(status == "P", F.array(key, F.concat(lit("a, "), status), lit(""), lit("x")))
             .otherwise(F.array(key, F.concat(lit('say "'), status, lit('"')), lit("two\nlines"))))
    path = shared_path(s, "grids")
    grids.write_grids(table(s, sf, "orders").withColumn("cells", cells), "o_orderpriority", "o_orderkey", "cells", path)
    return grids.read_grids(s, path)


@query("S9", "nested_forecast_explode", """select 'u' || user_id as location, event_type as element, strftime(ts, '%Y-%m-%dT%H:%M:%S') as start_time,
  case when event_type = 'error' then null when event_type = 'view' then (props->>'k') else value::varchar end as value from events""")
def _(s, sf):
    first = F.when(c("event_type").isin("error", "view"), lit("-")).otherwise(c("value").cast("string"))
    second = F.when(c("event_type") == "error", lit("")).otherwise(F.get_json_object("props", "$.k"))
    slot = F.struct(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("StartTime"), F.array(
        F.create_map(lit("MaxT"), first), F.create_map(lit("Alt"), second)).alias("ElementValue"))
    el = F.struct(c("event_type").alias("ElementName"), F.array(slot).alias("Time"))
    loc = F.struct(F.concat(lit("u"), c("user_id").cast("string")).alias("LocationName"), F.array(el).alias("WeatherElement"))
    doc = F.to_json(F.struct(F.struct(F.array(F.struct(F.array(loc).alias("Location"))).alias("Locations")).alias("records")))
    return snapshots.flatten_forecast(table(s, sf, "events").select(doc.alias("doc")), "doc", ["MaxT", "Alt"])


@query("S10", "document_text_source", rf"""with {PAGE_PATHS}
select page_id, regexp_extract(path, '([^/]*)$', 1) as name, case when split_part(path, '/', 1) in ('en', 'fr') then host else split_part(path, '/', 1) end as case_name
from pp where contains(regexp_extract(path, '([^/]*)$', 1), '7')""")
def _(s, sf):
    p = page_paths(s, sf).withColumn("full", F.concat_ws("/", "host", "path"))
    return tables.document_source(p, "full", "7", ["en", "fr"]).select("page_id", "name", "case_name")
