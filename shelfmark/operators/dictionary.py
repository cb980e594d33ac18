"""Dictionaries against texts: containment, ordered keywords, gazetteers, prefixes, votes.

A short list given as a parameter becomes one expression. A dictionary that comes as a
DataFrame has no size bound: it meets the texts through an equi join on grams, never through a
theta join.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark import constants as C
from shelfmark.functions import bloom
from shelfmark.functions.names import normalize_for_match
from shelfmark.operators.lanes import attach_lookup, keep_ranked
from shelfmark.session import stage

GRAM = 8


def _grams(text: str, n: int) -> Column:
    return F.when(F.length(text) >= n, F.transform(
        F.sequence(F.lit(1), F.length(text) - F.lit(n - 1)), lambda i: F.substr(F.col(text), i, F.lit(n)))
    ).otherwise(F.array().cast("array<string>"))


def containment_pairs(texts: DataFrame, text: str, terms: DataFrame, term: str, gram: int = GRAM) -> DataFrame:
    """Distinct (text, term) with the term inside the text; exact.

    A contained term brings its leading gram along, so candidates come from an equi join on
    (up to) ``gram`` characters and are then verified. Both sides shuffle straight into the
    join, which lets adaptive execution split a gram that very many texts share.
    """
    dic = terms.select(F.col(term).alias("_term")).filter(F.length("_term") > 0).distinct()
    dic = dic.withColumn("_gram", F.left("_term", F.lit(gram)))
    sizes = sorted(r[0] for r in dic.select(F.length("_gram")).distinct().collect())    # at most ``gram`` numbers
    txt = texts.select(F.col(text).alias("_text")).filter(F.col("_text").isNotNull()).distinct()
    empty = F.array().cast("array<string>")
    grams = F.concat(*[_grams("_text", n) for n in sizes]) if sizes else empty
    txt = txt.select("_text", F.explode(F.array_distinct(grams)).alias("_gram"))
    hit = txt.join(dic, "_gram").filter(F.contains(F.col("_text"), F.col("_term")))
    return hit.select(F.col("_text").alias(text), F.col("_term").alias(term))


def contained_terms(texts: DataFrame, row_id: str, text: str, terms: DataFrame, term: str, gram: int = GRAM) -> DataFrame:
    """(row_id, term, place) of every occurrence of every term in texts of any length; exact, place in bytes from 0.

    A positional index of grams, of which only what the dictionary needs is ever sent: a text's grams are tested against a
    Bloom filter of the dictionary's where they stand, and travel as (id, place, hash). Each term is looked up by the
    rarest of its grams, a term with a gram that no text has drops out, and candidates are verified with the texts, which
    are shuffled once, by id, and only those with a candidate. UTF-8 bytes are compared, which finds the same places as
    characters. ``row_id`` is unique; null texts and empty terms find nothing.
    """
    dic = terms.select(F.col(term).cast("binary").alias("_term")).filter(F.length("_term") > 0).distinct()
    dic = dic.withColumn("_n", F.least(F.length("_term"), F.lit(gram)))
    sizes = sorted(r[0] for r in dic.select("_n").distinct().collect())         # at most ``gram`` numbers
    if not sizes:
        return texts.select(row_id, F.lit(None).cast("string").alias(term), F.lit(0).alias("place")).limit(0)

    def hashed(data: Column, at: Column, n: Column) -> Column:
        return F.xxhash64(n, F.substring(data, at + 1, n))

    starts = F.sequence(F.lit(0), F.length("_term") - F.col("_n"))
    parts = dic.select("_term", "_n", F.explode(starts).alias("_skip"))
    parts = parts.withColumn("_gram", hashed(F.col("_term"), F.col("_skip"), F.col("_n")))
    rows = texts.select(F.col(row_id).alias("_id"), F.col(text).cast("binary").alias("_text")).filter(F.length("_text") > 0)

    def grams(wanted: DataFrame) -> DataFrame:
        places = rows.select("_id", "_text", F.explode(F.sequence(F.lit(0), F.length("_text") - 1)).alias("_at"))
        held = bloom.build(wanted.select("_gram").distinct(), "_gram")
        every = None
        for n in sizes:
            one = places.filter(F.col("_at") + n <= F.length("_text")).select(
                "_id", "_at", hashed(F.col("_text"), F.col("_at"), F.lit(n)).alias("_gram")).filter(bloom.may_contain(held, F.col("_gram")))
            every = one if every is None else every.unionAll(one)
        return every

    # counted once per gram: the dictionary's rows and the texts' counts meet, no text does
    times = grams(parts).groupBy("_gram").agg(F.count(F.lit(1)).alias("_times"))
    ranked = parts.join(times, "_gram", "left")
    rarest = ranked.groupBy("_term").agg(
        F.min_by(F.struct("_gram", "_skip"), F.struct(F.coalesce("_times", F.lit(0)), "_skip")).alias("_r"),
        F.min(F.coalesce("_times", F.lit(0))).alias("_times")).filter("_times > 0")
    rarest = stage(rarest.select("_term", F.col("_r._gram").alias("_gram"), F.col("_r._skip").alias("_skip")), "grams")
    hits = grams(rarest).join(rarest, "_gram").select("_id", "_term", (F.col("_at") - F.col("_skip")).alias("_at")).filter("_at >= 0")
    found = hits.join(rows, "_id").filter(F.substring(F.col("_text"), F.col("_at") + 1, F.length("_term")) == F.col("_term"))
    return found.select(F.col("_id").alias(row_id), F.col("_term").cast("string").alias(term), F.col("_at").alias("place"))


def first_term_join(texts: DataFrame, row_id: str, text: str, rules: DataFrame, keyword: str, priority: str,
                    values: Sequence[str]) -> DataFrame:
    """(row_id, keyword, values) of the rule with the lowest priority whose keyword a text of any length contains."""
    pairs = contained_terms(texts, row_id, text, rules, keyword).select(row_id, keyword).distinct()
    hits = pairs.join(rules.select(keyword, priority, *values), keyword)
    best = hits.groupBy(row_id).agg(F.min_by(F.struct(keyword, *values), F.col(priority)).alias("_hit"))
    return best.select(row_id, *[F.col(f"_hit.{v}").alias(v) for v in (keyword, *values)])


def first_keyword_join(names: DataFrame, text: str, rules: DataFrame, keyword: str, priority: str,
                       values: Sequence[str]) -> DataFrame:
    """Distinct texts with the values of the first rule (lowest priority) whose keyword they contain."""
    pairs = containment_pairs(names, text, rules, keyword)
    hits = pairs.join(rules.select(keyword, priority, *values), keyword)
    best = hits.groupBy(text).agg(F.min_by(F.struct(keyword, *values), F.col(priority)).alias("_hit"))
    return best.select(text, *[F.col(f"_hit.{v}").alias(v) for v in (keyword, *values)])


def first_keyword(text: Column, rules: Sequence[tuple], n_values: int) -> Column:
    """struct(keyword, v1..vn) of the first listed keyword contained in the text; for short rule lists."""
    names = ["keyword", *[f"v{i + 1}" for i in range(n_values)]]
    out = F.lit(None).cast("struct<" + ",".join(f"{n}:string" for n in names) + ">")
    for rule in reversed(list(rules)):
        hit = F.struct(*[F.lit(v).cast("string").alias(n) for n, v in zip(names, rule)])
        out = F.when(text.contains(rule[0]), hit).otherwise(out)
    return out


def gazetteer_match(text: Column, cities: Sequence[str], variants: dict[str, str], districts: dict[str, Sequence[str]],
                    unique_districts: dict[str, str], aliases: dict[str, tuple[str, str]]) -> Column:
    """struct(city, district): longest city first, then its longest district; without a city the
    unambiguous districts, then the aliases, in table order. A city without district gives ''.
    """
    kind = "struct<city:string,district:string>"

    def place(city: str, district: Column) -> Column:
        return F.struct(F.lit(city).alias("city"), district.alias("district"))

    out = F.lit(None).cast(kind)
    for alias, (city, district) in reversed(list(aliases.items())):
        out = F.when(text.contains(alias), place(city, F.lit(district))).otherwise(out)
    for district, city in reversed(list(unique_districts.items())):
        out = F.when(text.contains(district), place(city, F.lit(district))).otherwise(out)
    for raw in reversed(sorted(cities, key=len, reverse=True)):
        city = variants.get(raw, raw)
        known = sorted(districts.get(city, ()), key=len, reverse=True)
        best = F.lit("")
        if known:
            inside = F.filter(F.array(*[F.lit(d) for d in known]), lambda d: F.contains(text, d))
            best = F.coalesce(F.get(inside, F.lit(0)), F.lit(""))
        out = F.when(text.contains(raw), place(city, best)).otherwise(out)
    return out


def progressive_prefix_lookup(df: DataFrame, name: str, lookup: DataFrame, direct: Sequence[str] = (),
                              default: str | None = None, min_len: int = C.MIN_SEARCH_KEY_LEN,
                              row_key: Sequence[str] | None = None) -> DataFrame:
    """Adds ``found``: up to three directly contained words, else the value of the longest known
    prefix of the name, else ``default``. ``lookup`` has (key, value); null and blank values are as good as none.
    """
    def resolve(names: DataFrame) -> DataFrame:
        prefixes = names.filter(F.length(name) >= min_len).select(
            name, F.explode(F.transform(F.sequence(F.lit(min_len), F.length(name)),
                                        lambda n: F.left(F.col(name), n))).alias("key"))
        known = lookup.select("key", "value").where(F.trim("value") != "")      # a blank value does not end the search
        hits = prefixes.join(known, "key")
        return hits.groupBy(name).agg(F.max_by("value", F.length("key")).alias("_value"))

    out = attach_lookup(df, [name], row_key or df.columns, resolve, ["_value"])
    words = F.filter(F.array(*[F.lit(d) for d in direct]).cast("array<string>"), lambda d: F.contains(F.col(name), d))
    shown = F.when(F.size(words) > 0, F.array_join(F.slice(words, 1, 3), ","))
    return out.withColumn("found", F.coalesce(shown, F.col("_value"), F.lit(default))).drop("_value")


def render_batches(df: DataFrame, rn: str, line: Column, size: int, extra: str | None = None) -> DataFrame:
    """One text per batch of ``size`` numbered rows: '1. ...' lines (a batch never holds more rows)."""
    at = F.col(rn) - 1
    rows = df.select((F.floor(at / size) + 1).alias("batch"), (at % size + 1).alias("i"), line.alias("line"))
    lines = F.transform(F.array_sort(F.collect_list(F.struct("i", "line"))),
                        lambda x: F.concat(x["i"].cast("string"), F.lit(". "), x["line"]))
    out = rows.groupBy("batch").agg(F.array_join(lines, "\n").alias("prompt"))
    return out.withColumn("prompt", F.concat("prompt", F.lit("\n" + extra))) if extra else out


def vote(df: DataFrame, keys: Sequence[str], pair: Sequence[str]) -> DataFrame:
    """Most frequent pair per key; equal counts are settled by value. Counts combine before the shuffle."""
    counts = df.groupBy(*keys, *pair).agg(F.count(F.lit(1)).alias("votes"))
    order = [F.desc("votes"), *[F.asc_nulls_first(p) for p in pair]]
    return keep_ranked(counts, keys, order)


def fallback_vote(names: DataFrame, name: str, keys: Column, catalog: DataFrame, case: str, row_id: str,
                  city: str, district: str, rows_per_key: int = C.VOTE_ROWS_PER_KEY) -> DataFrame:
    """(name, tier, city, district): the strongest key with any located row decides by vote.

    ``keys`` is an array from strong to weak; a row counts for a key when its case contains the
    key, whatever the letter case; only the first ``rows_per_key`` rows (by id) of a key vote.
    """
    asked = names.select(name, F.posexplode(keys).alias("tier", "_key")).filter(
        F.length("_key") >= C.MIN_SEARCH_KEY_LEN).withColumn("_key", F.lower("_key"))
    rows = catalog.filter(F.col(city).isNotNull()).select(
        F.lower(case).alias("_case"), F.col(row_id).alias("_id"), F.col(city).alias("city"),
        F.coalesce(F.col(district), F.lit("")).alias("district"))
    first = keep_ranked(rows, ["_case"], [F.asc("_id")], rows_per_key)
    pairs = containment_pairs(first, "_case", asked, "_key")
    voters = keep_ranked(pairs.join(first, "_case"), ["_key"], [F.asc("_id")], rows_per_key)
    winners = vote(voters, ["_key"], ["city", "district"])
    hits = asked.join(winners, "_key")
    return keep_ranked(hits, [name], [F.asc("tier")]).select(name, "tier", "city", "district")


def normalized_containment_vote(names: DataFrame, name: str, catalog: DataFrame, case: str, city: str, district: str,
                                min_len: int = C.MIN_NORMALIZED_LEN) -> DataFrame:
    """(name, city, district): vote among located cases whose folded name contains the folded name or is contained."""
    asked = names.select(name, normalize_for_match(F.col(name)).alias("_n")).filter(F.length("_n") >= min_len)
    cases = catalog.filter(F.col(city).isNotNull() & F.col(case).isNotNull()).groupBy(case).agg(
        F.min(F.struct(F.col(city).alias("city"), F.coalesce(F.col(district), F.lit("")).alias("district"))).alias("p"))
    cases = cases.select(normalize_for_match(F.col(case)).alias("_v"), "p.city", "p.district").filter(F.length("_v") >= min_len)
    inside = containment_pairs(cases, "_v", asked, "_n")
    around = containment_pairs(asked, "_n", cases, "_v")
    # equal names contain each other and must vote once
    pairs = inside.select("_v", "_n").union(around.filter(F.col("_v") != F.col("_n")).select("_v", "_n"))
    votes = vote(pairs.join(cases, "_v"), ["_n"], ["city", "district"])
    return asked.join(votes, "_n").select(name, "city", "district")


def resolve_location(names: DataFrame, name: str, keys: Column, curated: DataFrame, manual: DataFrame,
                     catalog: DataFrame, case: str, row_id: str, city: str, district: str) -> DataFrame:
    """(name, stage, city, district) in the documented order: curated dimension (a non-building
    clears the place), manual exact, manual folded, vote, folded containment, manual containment.

    ``curated`` has (case_name, city, district, is_non_building), ``manual`` (case_name, city, district).
    """
    asked = names.select(name).distinct()
    blank = F.coalesce(F.col("district"), F.lit("")).alias("district")
    cur = curated.filter(F.col("is_non_building") | (F.coalesce(F.col("city"), F.lit("")) != ""))
    cur = cur.select(F.col("case_name").alias(name), F.lit(0).alias("stage"),
                     F.when(~F.col("is_non_building"), F.col("city")).alias("city"),
                     F.when(~F.col("is_non_building"), F.coalesce(F.col("district"), F.lit(""))).alias("district"))
    man = manual.filter(F.coalesce(F.col("city"), F.lit("")) != "").select("case_name", "city", blank)
    exact = asked.join(man, F.col(name) == F.col("case_name")).select(name, F.lit(1).alias("stage"), "city", "district")
    folded = man.withColumn("_f", normalize_for_match(F.col("case_name"))).filter(F.length("_f") >= C.MIN_NORMALIZED_LEN)
    folded = folded.groupBy("_f").agg(F.min_by(F.struct("city", "district"), F.col("case_name")).alias("p"))
    near = asked.withColumn("_f", normalize_for_match(F.col(name))).join(folded, "_f").select(
        name, F.lit(2).alias("stage"), "p.city", "p.district")
    near = near.join(exact, name, "left_anti")
    cur = asked.join(cur, name).select(name, "stage", "city", "district")
    first = cur.unionByName(exact.join(cur, name, "left_anti")).unionByName(near.join(cur, name, "left_anti"))
    # names only; each step is written before the next, costlier one looks at what is left
    found = [stage(first, "place")]

    def rest() -> DataFrame:
        return asked.join(reduce(DataFrame.unionByName, found).select(name), name, "left_anti")

    def add(n: int, hits: DataFrame) -> None:
        found.append(stage(hits.select(name, F.lit(n).alias("stage"), "city", "district"), "place"))

    add(3, fallback_vote(rest(), name, keys, catalog, case, row_id, city, district))
    add(4, normalized_containment_vote(rest(), name, catalog, case, city, district))
    add(5, normalized_containment_vote(rest(), name, man, "case_name", "city", "district"))
    return asked.join(reduce(DataFrame.unionByName, found), name, "left")
