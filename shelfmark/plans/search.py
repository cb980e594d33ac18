"""Search rows (Q, U)."""

from pyspark.sql import functions as F

from shelfmark.operators import search as Q
from shelfmark.plans.bindings import CUSTOMER_GEO, customer_geo
from shelfmark.plans.columns import sql_grams
from shelfmark.plans.registry import query, table

c, lit = F.col, F.lit


@query("Q1", "relaxed_search", """select doc_id, lang from documents where text ilike '%token%' and lang <> 'de'""")
def _(s, sf):
    return Q.relaxed_search(table(s, sf, "documents"), "text", "token - part 2", r"\s*part \d+\s*$", "a-z", c("lang") != "de").select("doc_id", "lang")


@query("Q1", "relaxed_search_direct", """select doc_id, lang from documents where text ilike '%THAT%'""")
def _(s, sf):
    return Q.relaxed_search(table(s, sf, "documents"), "text", "That", r"\s*part \d+\s*$", "a-z").select("doc_id", "lang")


PRIMARY = f"""with {CUSTOMER_GEO}, e as (select c_custkey, city, district from cg where lower(c_mktsegment) = 'machine' and city <> 'ASIA' order by c_custkey limit 100),
l as (select c_custkey, city, district from cg where c_mktsegment ilike '%machine%' and city <> 'ASIA' and not exists (select 1 from e) order by c_custkey limit 100),
v as (select city, district, count(*) as votes from (select * from e union all select * from l) group by 1, 2)"""


@query("Q2", "primary_location", f"""{PRIMARY} select city, district, votes, district as districts from v order by votes desc, city, district limit 1""")
def _(s, sf):
    g = customer_geo(s, sf).withColumn("city", F.when(c("city") != "ASIA", c("city")))
    out = Q.primary_location(g, "c_mktsegment", "city", "district", "c_custkey", "machine")
    return out.withColumn("districts", F.array_join("districts", ","))


@query("Q3", "priority_partition", f"""with {CUSTOMER_GEO}, a as (select o_orderkey, o_orderdate, nullif(city, 'EUROPE') as city, nullif(district, 'NATION_6') as district from orders join cg on o_custkey = c_custkey),
b as (select o_orderkey, o_orderdate, case when city = 'AMERICA' and (district ilike '%NATION_1%') then 0
  when city <> 'AMERICA' or not (district ilike '%NATION_1%') or city is null then 1 end as block from a)
select o_orderkey, block from b where block is not null""")
def _(s, sf):
    g = customer_geo(s, sf).select("c_custkey", F.nullif(c("city"), lit("EUROPE")).alias("city"), F.nullif(c("district"), lit("NATION_6")).alias("district"))
    o = table(s, sf, "orders").join(g, c("o_custkey") == c("c_custkey"))
    return Q.priority_partition(o, "city", "district", "AMERICA", ["NATION_1"], "o_orderdate", "o_orderkey").select("o_orderkey", "block")


@query("Q3", "priority_partition_page", f"""with {CUSTOMER_GEO}, b as (select o_orderkey, o_orderdate, case when city = 'AMERICA' and district ilike '%NATION_1%' then 0 else 1 end as block from orders join cg on o_custkey = c_custkey)
select o_orderkey, block from b order by block, o_orderdate desc, o_orderkey limit 50 offset 700""")
def _(s, sf):
    o = table(s, sf, "orders").join(customer_geo(s, sf), c("o_custkey") == c("c_custkey"))
    return Q.priority_partition(o, "city", "district", "AMERICA", ["NATION_1"], "o_orderdate", "o_orderkey", 700, 50).select("o_orderkey", "block")


FUZZY = f"""with n as (select distinct p_name as case_name from part), g as (select case_name, {sql_grams('case_name')} as a, {sql_grams("'red rings'")} as b from n),
f as (select case_name, len(list_intersect(a, b)) / (len(a) + len(b) - len(list_intersect(a, b)))::double as sim from g)"""


@query("Q4", "fuzzy_case_search", f"{FUZZY} select case_name, round(sim, 6) as sim from f where sim >= 0.03 order by case_name limit 50")
def _(s, sf):
    return Q.fuzzy_case_search(table(s, sf, "part"), "p_name", "red rings").withColumn("sim", F.round("sim", 6))


@query("Q4", "fuzzy_case_search_by_similarity", f"{FUZZY} select case_name, round(sim, 6) as sim from f where sim >= 0.2 order by f.sim desc, case_name limit 10")
def _(s, sf):
    return Q.fuzzy_case_search(table(s, sf, "part"), "p_name", "red rings", 0.2, 10, "similarity").withColumn("sim", F.round("sim", 6))


@query("Q5", "catalog_spot_check", """select lang, count(*) as rows, count(*) filter (where text ilike '%token%') as in_text, count(*) filter (where contains(source, '1')) as in_path,
  count(*) filter (where quality is null) as unlabelled from documents left join labels using (doc_id) group by 1""")
def _(s, sf):
    d = table(s, sf, "documents").join(table(s, sf, "labels"), "doc_id", "left")
    return d.groupBy("lang").agg(
        F.count(lit(1)).alias("rows"), F.count_if(c("text").ilike("%token%")).alias("in_text"),
        F.count_if(c("source").contains("1")).alias("in_path"), F.count_if(c("quality").isNull()).alias("unlabelled"))


@query("U1", "fuzzy_search_cases_function", f"{FUZZY} select case_name, round(sim, 6) as sim from f where sim >= 0.1 order by case_name limit 50")
def _(s, sf):
    table(s, sf, "part").createOrReplaceTempView("shelfmark_catalog")
    Q.register_sql_functions(s, "shelfmark_catalog", "p_name")
    return s.sql("select case_name, round(sim, 6) as sim from fuzzy_search_cases('red rings', threshold => 0.1D)")


@query("U2", "trigram_function", f"select p_partkey, array_to_string(list_sort({sql_grams('p_name')}), '|') as grams from part")
def _(s, sf):
    table(s, sf, "part").createOrReplaceTempView("shelfmark_catalog")
    Q.register_sql_functions(s, "shelfmark_catalog", "p_name")
    return s.sql("select p_partkey, array_join(array_sort(trgm(p_name)), '|') as grams from shelfmark_catalog")
