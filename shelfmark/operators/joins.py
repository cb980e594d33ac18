"""Lookups, exclusions, overrides, tiers, reconciliation."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark import constants as C
from shelfmark.functions.names import normalize_city, normalize_district
from shelfmark.functions.paths import blank_to_null, strip
from shelfmark.functions.values import hours_between
from shelfmark.operators.dictionary import containment_pairs
from shelfmark.operators.lanes import attach_group, keep_ranked, numbered
from shelfmark.session import stage


def lookup_left_join(df: DataFrame, key: str, dim: DataFrame, dim_key: str, values: Sequence[str],
                     row_key: Sequence[str] = ()) -> DataFrame:
    """Attach dimension values by key (unique in ``dim``); unknown and '' become null.

    A plain left join: the facts are read once, a small dimension is broadcast by its statistics, and adaptive execution
    splits a key that very many facts share.
    """
    d = dim.select(F.col(dim_key).alias("_k"), *[blank_to_null(F.col(v)).alias(v) for v in values])
    return df.join(d, F.col(key) == F.col("_k"), "left").drop("_k")


def unknown_names(df: DataFrame, key: str, known: DataFrame, group: str, sample: str) -> DataFrame:
    """Rows no source resolves, per group with a sample, most frequent first."""
    rest = df.join(known.select(key), key, "left_anti")
    return rest.groupBy(group).agg(F.min(sample).alias("sample"), F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), group)


def exclusion_reasons(df: DataFrame, key: str, manual: DataFrame, decided: DataFrame, nulls: DataFrame,
                      limit: int = C.NULL_STREAK_LIMIT) -> DataFrame:
    """Adds ``reason``: manual, table, null-limit or todo, first match wins. ``nulls`` has (key, count)."""
    m = manual.select(F.col(key).alias("_m")).distinct()
    t = decided.select(F.col(key).alias("_t")).distinct()
    n = nulls.select(F.col(key).alias("_n"), F.col("count").alias("_c"))
    out = (df.join(m, F.col(key) == F.col("_m"), "left").join(t, F.col(key) == F.col("_t"), "left")
           .join(n, F.col(key) == F.col("_n"), "left"))
    reason = (F.when(F.col("_m").isNotNull(), "manual").when(F.col("_t").isNotNull(), "table")
              .when(F.coalesce("_c", F.lit(0)) >= limit, "null-limit").otherwise("todo"))
    return out.withColumn("reason", reason).drop("_m", "_t", "_n", "_c")


def snapshot_diff(stored: DataFrame, scanned: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys.., status) with new, stale or kept."""
    a = stored.select(*keys).distinct().withColumn("_a", F.lit(1))
    b = scanned.select(*keys).distinct().withColumn("_b", F.lit(1))
    status = F.when(F.col("_a").isNull(), "new").when(F.col("_b").isNull(), "stale").otherwise("kept")
    return a.join(b, list(keys), "full").select(*keys, status.alias("status"))


def override_merge(guess: DataFrame, existing: DataFrame, manual: DataFrame, admin: DataFrame, key: str,
                   admin_source: str = "admin-ui", city_variants: dict[str, str] | None = None,
                   city_units: str | None = None, district_units: str | None = None,
                   keep_districts: Sequence[str] = ()) -> DataFrame:
    """(key, city, district, area) after all levels, one row per key known to any level but admin-only clears.

    guess and existing: (key, city, district, area, auto_area[, manual]); an existing entry counts
    where the guess lacks the key or when it is flagged manual. manual: (key, city, district, area)
    replaces, but an automatic area stays when it names none. admin: (key, city, district,
    is_non_building, source): only ``admin_source`` rows act, a non-building clears all three
    values, an empty city changes nothing, otherwise city and district change and the area stays.
    NULL is a legal final value, so levels are told apart by flags, not by coalesce.
    """
    def level(df: DataFrame, p: str, cols: Sequence[str]) -> DataFrame:
        return df.select(F.col(key).alias(f"{p}_key"), *[F.col(c).alias(f"{p}_{c}") for c in cols], F.lit(True).alias(f"{p}_has"))

    g = level(guess, "g", ["city", "district", "area", "auto_area"])
    e = level(existing, "e", ["city", "district", "area", "auto_area", "manual"])
    m = level(manual, "m", ["city", "district", "area"])
    a = level(admin.filter(F.col("source") == admin_source), "a", ["city", "district", "is_non_building"])
    joined = g.join(e, F.col("g_key") == F.col("e_key"), "full").withColumn("_k", F.coalesce("g_key", "e_key"))
    joined = joined.join(m, F.col("_k") == F.col("m_key"), "full").withColumn("_k", F.coalesce("_k", "m_key"))
    joined = joined.join(a, F.col("_k") == F.col("a_key"), "full").withColumn("_k", F.coalesce("_k", "a_key"))
    use_e = F.col("e_has").isNotNull() & (F.col("g_has").isNull() | F.coalesce("e_manual", F.lit(False)))
    first = {c: F.when(use_e, F.col(f"e_{c}")).otherwise(F.col(f"g_{c}")) for c in ("city", "district", "area", "auto_area")}
    has_m = F.col("m_has").isNotNull()
    auto_area = F.coalesce(first["auto_area"], F.lit(False)) & blank_to_null(first["area"]).isNotNull()
    keep_area = auto_area & blank_to_null(F.col("m_area")).isNull()
    second = {
        "city": F.when(has_m, F.col("m_city")).otherwise(first["city"]),
        "district": F.when(has_m, F.col("m_district")).otherwise(first["district"]),
        "area": F.when(has_m & ~keep_area, F.col("m_area")).otherwise(first["area"]),
    }
    a_city, a_district = blank_to_null(strip(F.col("a_city"))), blank_to_null(strip(F.col("a_district")))
    if city_units:
        a_city = normalize_city(F.col("a_city"), city_variants or {}, city_units)
    if district_units:
        a_district = normalize_district(F.col("a_district"), district_units, keep_districts)
    clear = F.coalesce(F.col("a_is_non_building"), F.lit(False))
    put = F.col("a_has").isNotNull() & ~clear & a_city.isNotNull()
    known = F.coalesce(F.col("g_has"), F.col("e_has"), F.col("m_has")).isNotNull() | clear | put
    return joined.filter(known).select(
        F.col("_k").alias(key),
        F.when(clear, None).when(put, a_city).otherwise(second["city"]).alias("city"),
        F.when(clear, None).when(put, a_district).otherwise(second["district"]).alias("district"),
        F.when(clear, None).otherwise(second["area"]).alias("area"))


def mismatches(df: DataFrame, key: str, expected: DataFrame, columns: Sequence[str], row_key: Sequence[str] = ()) -> DataFrame:
    """Rows whose values differ from the expected ones of their key; null and '' are equal."""
    names = [f"_e_{c}" for c in columns]
    e = expected.select(F.col(key).alias("_k"), *[F.col(c).alias(f"_e_{c}") for c in columns])
    found = df.join(e, F.col(key) == F.col("_k"))
    differs = reduce(lambda a, b: a | b, [
        ~blank_to_null(F.col(c)).eqNullSafe(blank_to_null(F.col(f"_e_{c}"))) for c in columns])
    return found.filter(differs).drop("_k")


def tiered_match(cases: DataFrame, case: str, scripts: DataFrame, norm, script_id: str, folder: str, subfolder: str,
                 name: str, rank: Sequence[Column], k: int = 3) -> DataFrame:
    """(case, tier, script_id, pick): the best ``k`` scripts of the first tier that finds any.

    Tiers: 1 exact folder or subfolder, 2 equal after ``norm``, 3 containment either way (the first
    folder in script order only), 4 the script name contains the folded case. Scripts are ranked
    per folder before any join, so a folder of any size sends k rows.
    """
    asked = cases.select(F.col(case).alias("_case")).distinct().withColumn("_n", norm(F.col("_case")))
    both = F.array(blank_to_null(strip(F.col(subfolder))), blank_to_null(strip(F.col(folder))))
    keyed = scripts.select("*", F.explode(F.array_distinct(both)).alias("_f")).filter(F.col("_f").isNotNull())
    keyed = keyed.withColumn("_fn", norm(F.col("_f")))
    per_folder = keep_ranked(keyed, ["_f"], rank, k).select("_f", script_id, *_rank_inputs(scripts, script_id))
    one_norm = keep_ranked(keyed, ["_fn", script_id], [F.asc("_f")])
    per_norm = keep_ranked(one_norm, ["_fn"], rank, k).select("_fn", script_id, *_rank_inputs(scripts, script_id))
    cols = ["_case", "tier", script_id, *_rank_inputs(scripts, script_id)]

    exact = keyed.select(F.col("_f").alias("_case"), F.lit(True).alias("_one")).distinct()
    equal = keyed.select(F.col("_fn").alias("_n"), F.lit(True).alias("_two")).distinct()
    # distinct names only; written once because every later tier starts from it
    asked = stage(asked.join(exact, "_case", "left").join(equal, "_n", "left"), "tiers")
    t1 = asked.filter("_one").join(per_folder, F.col("_case") == F.col("_f")).withColumn("tier", F.lit(1)).select(*cols)
    t2 = asked.filter("_one is null and _two").join(per_norm, F.col("_n") == F.col("_fn")).withColumn(
        "tier", F.lit(2)).select(*cols)
    left = asked.filter("_one is null and _two is null and _n <> ''").select("_case", "_n")

    folders = keyed.filter(F.col("_fn") != "").groupBy("_fn").agg(F.min(script_id).alias("_first"))
    hits = containment_pairs(folders, "_fn", left, "_n").select("_n", "_fn").union(
        containment_pairs(left, "_n", folders, "_fn").select("_n", "_fn"))
    nearest = stage(hits.join(folders, "_fn").groupBy("_n").agg(
        F.min_by("_fn", F.struct("_first", "_fn")).alias("_fn")), "tier3")
    t3 = left.join(nearest, "_n").join(per_norm, "_fn").withColumn("tier", F.lit(3)).select(*cols)
    left = left.join(nearest, "_n", "left_anti")

    per_name = keep_ranked(scripts, [name], rank, k)
    in_name = containment_pairs(scripts, name, left, "_n").join(per_name, name)
    t4 = left.join(in_name, "_n").withColumn("tier", F.lit(4)).select(*cols)
    every = reduce(DataFrame.unionByName, [t1, t2, t3, t4])
    return keep_ranked(every, ["_case"], rank, k, rank_col="pick").select(
        F.col("_case").alias(case), "tier", script_id, "pick")


def _rank_inputs(scripts: DataFrame, script_id: str) -> list[str]:
    return [c for c in scripts.columns if c != script_id]


def journal_reconcile(journal: DataFrame, key: str, new_path: str, on_disk: Column, catalog: DataFrame,
                      catalog_key: str, path: str) -> DataFrame:
    """Adds ``status``: disk-missing, row-missing, already-new or patched."""
    cat = catalog.select(F.col(catalog_key).alias("_k"), F.col(path).alias("_p"))
    status = (F.when(~on_disk, "disk-missing").when(F.col("_k").isNull(), "row-missing")
              .when(F.col("_p") == F.col(new_path), "already-new").otherwise("patched"))
    return journal.join(cat, F.col(key) == F.col("_k"), "left").withColumn("status", status).drop("_k", "_p")


def apply_renames(catalog: DataFrame, key: str, tags: str, renames: DataFrame, protected: Sequence[str]) -> DataFrame:
    """Catalog after renames (key, new_key): a row already at the new key stays and takes over the
    protected tags of the rows that move onto it; otherwise the first mover takes the key.
    """
    r = renames.select(F.col(key).alias("_old"), F.col("new_key").alias("_new"))
    rows = catalog.join(r, F.col(key) == F.col("_old"), "left").withColumn("_key", F.coalesce("_new", key))
    keep = F.array_intersect(F.col(tags), F.array(*[F.lit(p) for p in protected]))
    extra = rows.select("_key", F.explode(keep).alias("_t")).distinct().groupBy("_key").agg(F.collect_set("_t").alias("_x"))
    first = keep_ranked(rows, ["_key"], [F.col("_old").isNotNull().asc(), F.asc(key)])
    out = first.select(F.col("_key").alias(key), *[c for c in catalog.columns if c != key]).join(
        extra.withColumnRenamed("_key", key), key, "left")
    merged = F.array_sort(F.array_union(F.col(tags), F.coalesce("_x", F.array().cast("array<string>"))))
    return out.withColumn(tags, merged).drop("_x").select(*catalog.columns)


def preserve_tags(source: DataFrame, target: DataFrame, key: str, tags: str, protected: Sequence[str]) -> DataFrame:
    """Rows to upsert, with the protected tags their stored rows carry."""
    keep = F.array_intersect(F.col(tags), F.array(*[F.lit(p) for p in protected]))
    old = target.select(F.col(key).alias("_k"), keep.alias("_x")).filter(F.size("_x") > 0)
    out = source.join(old, F.col(key) == F.col("_k"), "left")
    merged = F.array_sort(F.array_union(F.col(tags), F.coalesce("_x", F.array().cast("array<string>"))))
    return out.withColumn(tags, merged).drop("_k", "_x")


def ancestor_chains(folders: DataFrame, levels: int = 5) -> DataFrame:
    """(folder_id, chain) with at most ``levels`` names from near to far; ``folders`` has (folder_id, name, parent_id).

    Pointers double: after k rounds an open chain has 2**k names and points 2**k folders up, so a depth of a million takes
    twenty joins. A chain that has reached a folder without a known parent, or ``levels`` names, is finished: open ones
    take over its names, but it joins no more, and no join sees a null key. A cycle goes round until ``levels`` names.
    """
    known = folders.select(F.col("folder_id").alias("_known"))
    chain = folders.select("folder_id", F.array("name").alias("chain"), F.col("parent_id").alias("_next"))
    # the parents that exist; of the others the chain ends here
    chain = stage(chain.join(known, F.col("_next") == F.col("_known"), "left").select(
        "folder_id", "chain", F.col("_known").alias("_next")), "chains")
    length = 1
    while length < levels and not chain.filter(F.col("_next").isNotNull()).isEmpty():
        ahead = chain.select(F.col("folder_id").alias("_f"), F.col("chain").alias("_c"), F.col("_next").alias("_n"))
        step = chain.filter(F.col("_next").isNotNull()).join(ahead, F.col("_next") == F.col("_f")).select(
            "folder_id", F.concat("chain", "_c").alias("chain"), F.col("_n").alias("_next"))
        chain = stage(chain.filter(F.col("_next").isNull()).unionByName(step), "chains")
        length *= 2
    return chain.select("folder_id", F.slice("chain", 1, levels).alias("chain"))


def output_case(files: DataFrame, parent: str, folders: DataFrame, output_name: str, row_key: Sequence[str] = ()) -> DataFrame:
    """Files directly inside an ``output_name`` folder, with the folder above it as their case."""
    out = folders.filter(F.col("name") == output_name).select(F.col("folder_id").alias("output_id"), F.col("parent_id").alias("case_id"))
    case = folders.select(F.col("folder_id").alias("case_id"), F.col("name").alias("case_name"))
    inside = out.join(case, "case_id")
    return files.join(inside, F.col(parent) == F.col("output_id"))


def same_path_rows(df: DataFrame, key: str, canonical: str) -> DataFrame:
    """Records of an already listed file: adds ``keeper`` (first key of the path) and ``row_only`` (drop the row, not the data)."""
    rows = attach_group(df, [canonical], [key], {"keeper": ("min", F.col(key)), "copies": ("count", F.lit(1))})
    return rows.withColumn("row_only", F.col(key) != F.col("keeper"))


def approvals(pending: DataFrame, actions: DataFrame, ttl_days: int = C.APPROVAL_TTL_DAYS) -> DataFrame:
    """(token, action, at, outcome) for each action.

    ``pending`` has (token, created_at), ``actions`` (token, action, at, seq). The first action
    after creation settles its token: executed, cancelled or expired (confirming too late drops
    the request). Others find no pending request or an unknown token.
    """
    p = pending.select(F.col("token").alias("_t"), "created_at")
    # one exchange of the actions and one of the requests serve all three joins
    live = actions.join(p, F.col("token") == F.col("_t")).filter(F.col("at") >= F.col("created_at"))
    firsts = live.groupBy("_t").agg(F.min(F.struct("at", "seq")).alias("_first"))
    settled = actions.join(p.join(firsts, "_t", "left"), F.col("token") == F.col("_t"), "left")
    late = hours_between(F.col("at"), F.col("created_at")) > ttl_days * 24
    outcome = (F.when(F.col("_t").isNull(), "unknown-token")
               .when(~F.coalesce(F.struct("at", "seq") == F.col("_first"), F.lit(False)), "no-pending")
               .when(F.col("action") == "cancel", "cancelled").when(late, "expired").otherwise("executed"))
    return settled.select("token", "action", "at", "seq", outcome.alias("outcome"))


def approved_deletes(ids: DataFrame, outcomes: DataFrame, cap: int = C.APPROVAL_DELETE_CAP) -> DataFrame:
    """(token, id, execute) of the executed requests: the first ``cap`` ids run now, the rest remain."""
    run = ids.join(outcomes.filter(F.col("outcome") == "executed").select("token"), "token", "left_semi")
    return numbered(run, ["id"], ["token"]).select("token", "id", (F.col("rn") <= cap).alias("execute"))
