"""The driver's tables seen as catalogs, with the same views in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.plans.registry import table

URL = r"^([a-z]+)://([^/]+)/(.*)$"


def page_paths(spark: SparkSession, sf: str) -> DataFrame:
    """page_id, url, scheme, host, rel (with query), path (without query and fragment)."""
    p = table(spark, sf, "pages").select("page_id", "url")
    rel = F.regexp_extract("url", URL, 3)
    return p.select("page_id", "url", F.regexp_extract("url", URL, 1).alias("scheme"),
                    F.regexp_extract("url", URL, 2).alias("host"), rel.alias("rel"),
                    F.regexp_replace(rel, r"[?#].*$", "").alias("path"))


PAGE_PATHS = r"""pp as (select page_id, url, regexp_extract(url, '^([a-z]+)://([^/]+)/(.*)$', 1) as scheme,
  regexp_extract(url, '^([a-z]+)://([^/]+)/(.*)$', 2) as host,
  regexp_extract(url, '^([a-z]+)://([^/]+)/(.*)$', 3) as rel,
  regexp_replace(regexp_extract(url, '^([a-z]+)://([^/]+)/(.*)$', 3), '[?#].*$', '') as path from pages)"""


def customer_geo(spark: SparkSession, sf: str) -> DataFrame:
    """case = customer key, district = nation, city = region."""
    n = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    c = table(spark, sf, "customer")
    return c.join(n, c.c_nationkey == n.n_nationkey).select(
        "c_custkey", "c_name", "c_mktsegment", "c_acctbal", F.col("r_name").alias("city"), F.col("n_name").alias("district"))


CUSTOMER_GEO = """cg as (select c_custkey, c_name, c_mktsegment, c_acctbal, r_name as city, n_name as district
  from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey)"""


def crc32_sql(key: str) -> str:
    """CRC-32 of an ASCII rendering of ``key``, byte by byte and bit by bit, as DuckDB has no function for it."""
    text = f"CAST({key} AS VARCHAR)"
    step = "CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::UBIGINT) ELSE x // 2 END"
    byte = f"list_reduce(list_prepend(xor(c, b), list_transform(range(8), lambda k: k::UBIGINT)), lambda x, k: {step})"
    codes = f"list_transform(range(1, len({text}) + 1), lambda i: ascii({text}[i])::UBIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::UBIGINT, {codes}), lambda c, b: {byte}), 4294967295::UBIGINT)"
