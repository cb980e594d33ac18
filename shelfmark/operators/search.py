"""Search composites."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark import constants as C
from shelfmark.functions.names import search_key_cascade
from shelfmark.functions.text import gram_similarity, trigrams
from shelfmark.functions.values import split_multi_value
from shelfmark.operators.dictionary import vote
from shelfmark.operators.ranking import page_slice


def like_pattern(q: str) -> str:
    return "%" + q.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_") + "%"


def _like_pattern(q: Column) -> Column:
    """``like_pattern`` as an expression."""
    return F.concat(F.lit("%"), F.regexp_replace(q, r"([\\%_])", r"\\$1"), F.lit("%"))


def weaker_key(q: str, part: str, letters: str) -> Column:
    """The next weaker search key of a query, a constant; null without one."""
    return F.get(F.filter(search_key_cascade(F.lit(q), part, letters), lambda k: k != F.lit(q)), 0)


def relaxed_search(df: DataFrame, text: str, q: str, part: str, letters: str, keep: Column | None = None) -> DataFrame:
    """Rows that contain ``q``; when no row does, rows that contain its next weaker search key. ``keep`` filters afterwards.

    The keys are those of ``search_key_cascade`` for the part ending ``part`` and the letters of a head word; the weaker
    one is worked out in the plan and folded to a constant there. A query without a weaker key finds nothing more.
    """
    full = F.col(text).ilike(like_pattern(q))
    weaker = weaker_key(q, part, letters)
    # the probe needs one hit only and stays a subquery of the same plan
    none = df.filter(full).select(F.lit(1).alias("x")).limit(1).agg(F.count("x")).scalar() == 0
    hits = df.filter(full | (none & F.coalesce(F.ilike(F.col(text), _like_pattern(weaker)), F.lit(False))))
    return hits if keep is None else hits.filter(keep)


def primary_location(df: DataFrame, case: str, city: str, district: str, row_id: str, q: str, rows: int = 100) -> DataFrame:
    """One row (city, district, districts): vote of the located rows named ``q``, else of those containing it."""
    located = df.filter(F.col(city).isNotNull()).select(
        F.col(row_id).alias("_id"), F.col(case).alias("_case"), F.col(city).alias("city"),
        F.coalesce(F.col(district), F.lit("")).alias("district"))
    exact = located.filter(F.lower("_case") == q.lower()).orderBy("_id").limit(rows)
    none = exact.agg(F.count(F.lit(1))).scalar() == 0
    loose = located.filter(F.col("_case").ilike(like_pattern(q)) & none).orderBy("_id").limit(rows)
    winner = vote(exact.unionAll(loose).withColumn("_q", F.lit(q)), ["_q"], ["city", "district"])
    return winner.select("city", "district", "votes", split_multi_value(F.col("district"), ",").alias("districts"))


def priority_partition(df: DataFrame, city: str, district: str, wanted_city: str, wanted: Sequence[str],
                       mtime: str, row_id: str, offset: int = 0, n: int | None = None) -> DataFrame:
    """Two blocks, newest first: place matches, then the rest; with ``n`` the page of so many rows after ``offset`` rows.

    Rest means another city, no city, or a district that matches none of the wanted ones. Under
    SQL nulls a row of the right city without a district is in neither block.
    """
    c, d = F.col(city), F.col(district)
    any_d, no_d = F.lit(False), F.lit(True)
    for w in wanted:
        any_d, no_d = any_d | d.ilike(like_pattern(w)), no_d & ~d.ilike(like_pattern(w))
    first = (c == wanted_city) & any_d if wanted else c == wanted_city
    rest = (c != wanted_city) | c.isNull()
    if wanted:
        rest = rest | no_d
    block = F.when(F.coalesce(first, F.lit(False)), 0).when(F.coalesce(rest, F.lit(False)), 1)
    out = df.withColumn("block", block).filter(F.col("block").isNotNull())
    order = [F.asc("block"), F.desc(mtime), F.asc(row_id)]
    return page_slice(out, order, offset, n).drop("total") if n else out.orderBy(*order)


def fuzzy_case_search(df: DataFrame, case: str, q: str, threshold: float = C.FUZZY_THRESHOLD,
                      limit: int = C.FUZZY_LIMIT, order: str = "name") -> DataFrame:
    """(case_name, sim) of distinct names at least ``threshold`` similar; the first ``limit`` by name
    (or, on request, by similarity)."""
    names = df.filter(F.col(case).isNotNull()).select(F.col(case).alias("case_name")).distinct()
    scored = names.withColumn("sim", gram_similarity(trigrams(F.col("case_name")), trigrams(F.lit(q))))
    by = [F.asc("case_name")] if order == "name" else [F.desc("sim"), F.asc("case_name")]
    return scored.filter(F.col("sim") >= threshold).orderBy(*by).limit(limit)


def register_sql_functions(spark: SparkSession, view: str, case: str) -> None:
    """``trgm(text)`` and the table function ``fuzzy_search_cases(q, threshold)`` over a catalog view."""
    spark.sql(r"""
      create or replace temporary function trgm(x string) returns array<string> return
        array_distinct(flatten(transform(
          filter(split(lower(coalesce(x, '')), '[^\\p{L}\\p{N}]+'), w -> w <> ''),
          w -> transform(sequence(1, length(w) + 1), i -> substr(concat('  ', w, ' '), i, 3)))))""")
    spark.sql(f"""
      create or replace temporary function fuzzy_search_cases(q string, threshold double default {C.FUZZY_THRESHOLD})
      returns table (case_name string, sim double) return
        select case_name, sim from (
          select case_name, size(array_intersect(a, b)) / cast(size(array_union(a, b)) as double) as sim
          from (select case_name, trgm(case_name) as a, trgm(fuzzy_search_cases.q) as b
                from (select distinct {case} as case_name from {view} where {case} is not null)))
        where sim >= fuzzy_search_cases.threshold order by case_name limit {C.FUZZY_LIMIT}""")
