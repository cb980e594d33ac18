"""The catalog jobs that combine the operators: refine a listing, publish it, place its cases.

Each job takes and returns DataFrames; what several steps read is written to the shared folder.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark import constants as C
from shelfmark.functions import paths as P
from shelfmark.functions.text import append_missing_tokens, build_search_text, remove_token
from shelfmark.operators.joins import lookup_left_join, override_merge, preserve_tags
from shelfmark.operators.maintenance import full_refresh, guarded_prune, upsert_merge
from shelfmark.operators.predicates import date_window
from shelfmark.operators.ranking import page_slice
from shelfmark.operators.search import primary_location, priority_partition, relaxed_search, weaker_key
from shelfmark.operators.windows import latest_version_flag
from shelfmark.session import stage


@dataclass(frozen=True)
class NamingRules:
    """Word lists of one catalog."""

    layers: Sequence[str] = ()                       # folders that only group cases
    stop_names: Sequence[str] = ()                   # folder names that never name a case or tag
    channel_categories: dict[str, str] = field(default_factory=dict)
    category_rules: Sequence[tuple[str, str]] = ()   # (keyword, category), first match wins
    default_category: str = "other"
    old_marker: str = "old"
    versioned_source: str = "nas"
    versioned_category: str = "output"


def refine_listing(raw: DataFrame, rules: NamingRules) -> DataFrame:
    """Catalog fields of a raw listing (seq, drive_file_id, source, channel_folder, case_folder, subpath, filename, ..).

    Adds channel_order, channel_name, case_name, category, category_folder, tags and is_old; outdated versions are
    flagged within (channel, case folder, subpath, base name, extension).
    """
    rows = raw.filter(~F.col("filename").startswith(C.SIDECAR_PREFIX))
    channel = P.parse_ordered_name(F.col("channel_folder"))
    path = F.col("rel_path") if "rel_path" in raw.columns else F.concat_ws(
        "/", "channel_folder", "case_folder", F.nullif(F.col("subpath"), F.lit("")), "filename")
    rows = rows.withColumn("_ch", channel).withColumn("_v", P.extract_version(F.col("filename")))
    rows = rows.select(
        *raw.columns, F.col("_ch.ord").alias("channel_order"), F.col("_ch.name").alias("channel_name"),
        P.derive_case_name(F.col("case_folder"), F.col("subpath"), rules.layers, rules.stop_names).alias("case_name"),
        P.derive_category(F.col("_ch.name"), path, rules.channel_categories, rules.category_rules,
                          rules.default_category).alias("category"),
        F.when(F.col("case_folder").isin(list(rules.layers)), F.col("case_folder")).otherwise("").alias("category_folder"),
        F.coalesce(P.has_segment(F.col("subpath"), rules.old_marker), F.lit(False)).alias("is_old"),
        F.col("_v.base").alias("_base"), F.col("_v.version").alias("_version"), F.col("_v.ext").alias("_ext"))
    rows = rows.withColumn("tags", P.derive_tags(F.col("subpath"), F.col("case_name"), F.col("channel_name"),
                                                 F.col("filename"), rules.layers, rules.stop_names))
    scope = (F.col("source") == rules.versioned_source) & (F.col("category") == rules.versioned_category)
    flagged = latest_version_flag(rows, ["channel_folder", "case_folder", "subpath", "_base", "_ext"], "_version", "seq", scope)
    return flagged.drop("_base", "_version", "_ext", "newly_marked")


def publish(catalog: DataFrame, listing: DataFrame, protected: Sequence[str],
            share: float = C.PRUNE_MAX_STALE_SHARE) -> DataFrame:
    """Next catalog snapshot: the listing upserted (protected tags survive, search text rebuilt), vanished
    rows pruned per source behind the guard. Columns the listing lacks keep their stored value.

    ``listing`` is read several times: pass a written table (see ``session.stage``).
    """
    key = "drive_file_id"
    rows = preserve_tags(listing, catalog, key, "tags", protected)
    text = build_search_text(F.col("channel_name"), F.col("case_name"), F.col("subpath"), F.col("filename"), F.col("tags"),
                             F.lit(None).cast("string"), F.lit(None).cast("string"))
    rows = rows.withColumn("search_text", text)
    merged = upsert_merge(catalog, rows.select(*[c for c in catalog.columns if c in rows.columns]), key)
    return guarded_prune(stage(merged, "upsert"), listing, key, "source", share)


def expected_places(catalog: DataFrame, match: Callable[[Column], Column], existing: DataFrame, manual: DataFrame,
                    admin: DataFrame, **norm) -> DataFrame:
    """(case_name, city, district, area): the gazetteer's guess per distinct case, then the override levels."""
    cases = catalog.select("case_name").filter(F.coalesce("case_name", F.lit("")) != "").distinct()
    hit = cases.withColumn("_m", match(F.col("case_name"))).filter(F.col("_m").isNotNull())
    guess = hit.select("case_name", F.col("_m.city").alias("city"), F.col("_m.district").alias("district"),
                       F.lit(None).cast("string").alias("area"), F.lit(False).alias("auto_area"))
    return override_merge(guess, existing, manual, admin, "case_name", **norm)


def apply_places(catalog: DataFrame, expected: DataFrame) -> DataFrame:
    """Catalog with the expected places: differing rows get city and district, and the place words the
    search text lacks are appended. Cases without expectation stay untouched.
    """
    names = ["_city", "_district", "_area", "_known"]
    e = expected.select("case_name", F.col("city").alias("_city"), F.col("district").alias("_district"),
                        F.col("area").alias("_area"), F.lit(True).alias("_known"))
    rows = catalog.join(e.withColumnRenamed("case_name", "_case"), F.col("case_name") == F.col("_case"), "left").drop("_case")
    known = F.coalesce("_known", F.lit(False))
    city, district = P.blank_to_null(F.col("_city")), P.blank_to_null(F.col("_district"))
    pair = F.when(city.isNotNull() & district.isNotNull(), F.concat(city, F.lit(" "), district))
    base = F.coalesce("search_text", F.lit(""))
    text = append_missing_tokens(base, [city, district, pair])
    area = F.filter(F.split(F.coalesce("_area", F.lit("")), " "), lambda t: (t != "") & ~F.contains(base, t))
    text = F.trim(F.concat_ws(" ", text, P.blank_to_null(F.array_join(area, " "))))
    needs = (text != F.trim(base))
    return rows.withColumn("search_text", F.when(known & needs, text).otherwise(F.col("search_text"))).withColumn(
        "city", F.when(known, city).otherwise(F.col("city"))).withColumn(
        "district", F.when(known, district).otherwise(F.col("district"))).drop(*names)


def search(catalog: DataFrame, q: str, part: str, letters: str, *, category: str | None = None, offset: int = 0,
           n: int = 20) -> DataFrame:
    """One page of the live assets that match ``q``, else its next weaker key, with ``block``: those at the query's own place first.

    The place is the vote of the cases named like the query, or else like its weaker key (``primary_location``), of which every district
    counts; without a place all hits are one block. Newest first, then by id. Two rows, key and place, reach the driver.
    """
    keep = ~F.col("is_old") & ((F.col("category") == category) if category else F.lit(True))
    hits = relaxed_search(catalog, "search_text", q, part, letters, keep)
    key = catalog.sparkSession.range(1).select(weaker_key(q, part, letters)).first()[0]
    asked = (primary_location(catalog, "case_name", "city", "district", "drive_file_id", x).first() for x in (q, key) if x)
    place = next((p for p in asked if p), None)
    if place is None:
        return page_slice(hits.withColumn("block", F.lit(0)), [F.desc("mtime"), F.asc("drive_file_id")], offset, n).drop("total")
    return priority_partition(hits, "city", "district", place["city"], [d for d in place["districts"] if d], "mtime", "drive_file_id", offset, n)


def cases_for_scripts(catalog: DataFrame, manual: DataFrame, match: Callable[[Column], Column]) -> DataFrame:
    """(case_name, city, district) of the cases without a city that no manual entry settles.

    A case whose own name gives city and district carries them and needs no script; the others
    (city null) go on to ``tiered_match``.
    """
    names = F.trim(F.coalesce("case_name", F.lit("")))
    cases = catalog.filter(F.col("city").isNull()).select(names.alias("case_name")).filter("case_name <> ''").distinct()
    settled = manual.filter(F.coalesce(F.col("city"), F.lit("")) != "").select("case_name")
    rest = cases.join(settled, "case_name", "left_anti").withColumn("_m", match(F.col("case_name")))
    own = (F.coalesce(F.col("_m.city"), F.lit("")) != "") & (F.coalesce(F.col("_m.district"), F.lit("")) != "")
    return rest.select("case_name", F.when(own, F.col("_m.city")).alias("city"), F.when(own, F.col("_m.district")).alias("district"))


def place_schedule(schedule: DataFrame, places: DataFrame, row_key: Sequence[str] = ()) -> DataFrame:
    """Schedule rows with the city and district resolved for their case."""
    return lookup_left_join(schedule, "case_name", places, "case_name", ["city", "district"], row_key)


def sync_schedule(schedule: DataFrame, places: DataFrame, asof: Column, days: int, path: str) -> DataFrame:
    """The dated rows of a parsed schedule from ``asof`` on for ``days`` days, with the places of their cases, as the new table at ``path``.

    ``schedule`` is (sheet, date, case_name, editor), ``places`` one row per case_name; the old table is replaced as a whole. One write.
    """
    week = schedule.filter(date_window(F.col("date"), asof, days - 1))
    return full_refresh(place_schedule(week, places).select("sheet", "date", "case_name", "editor", "city", "district"), path)


def rollback_places(catalog: DataFrame, journal: DataFrame, fid: str, place: str, seq: str) -> tuple[DataFrame, DataFrame]:
    """(patches, report) that take back the places a journal has applied.

    ``journal`` holds the applied records (fid, place, seq), as ``read_dropping`` gives them. A patch (drive_file_id, tags, search_text)
    has all places of its asset taken out in journal order. The report (fid, place, seq, status) says of each record: row-missing,
    reverted, or no-change where neither tags nor search text hold the place any more; a record that repeats an earlier one
    changes nothing. A second run over the patched catalog therefore only reports no-change.
    """
    records = journal.select(F.col(fid).alias("fid"), F.col(place).alias("place"), F.col(seq).alias("seq"))
    # different places of an asset are few, however often the journal names them
    first = records.groupBy("fid", "place").agg(F.min("seq").alias("first"))
    per_asset = first.groupBy("fid").agg(F.array_sort(F.collect_list(F.struct("first", "place"))).alias("steps"))
    rows = catalog.select(F.col("drive_file_id").alias("id"), F.coalesce("tags", F.array().cast("array<string>")).alias("tags"),
                          F.coalesce("search_text", F.lit("")).alias("text"))
    found = rows.join(per_asset, F.col("id") == F.col("fid"))
    start = F.struct(F.col("text").alias("text"), F.array().cast("array<boolean>").alias("changed"))

    def step(state: Column, s: Column) -> Column:
        after = remove_token(state["text"], s["place"])
        return F.struct(after.alias("text"), F.array_append(state["changed"], after != state["text"]).alias("changed"))

    done = found.withColumn("done", F.aggregate("steps", start, step))
    done = done.withColumn("kept", F.filter("tags", lambda t: ~F.array_contains(F.transform("steps", lambda s: s.place), t)))
    each = F.transform(F.arrays_zip("steps", F.col("done.changed").alias("changed")), lambda z: F.struct(
        z.steps.first.alias("first"), z.steps.place.alias("place"),
        (z.changed | F.array_contains("tags", z.steps.place)).alias("changed")))
    done = done.withColumn("each", each)
    patches = done.filter(F.exists("each", lambda e: e.changed)).select(
        F.col("id").alias("drive_file_id"), F.col("kept").alias("tags"), F.col("done.text").alias("search_text"))
    steps = done.select(F.col("id").alias("_id"), F.explode("each").alias("e")).select(
        "_id", F.col("e.first").alias("_first"), F.col("e.place").alias("_place"), F.col("e.changed").alias("_changed"))
    out = records.join(steps, (F.col("fid") == F.col("_id")) & (F.col("place") == F.col("_place")), "left")
    status = (F.when(F.col("_id").isNull(), "row-missing").when((F.col("seq") == F.col("_first")) & F.col("_changed"), "reverted")
              .otherwise("no-change"))
    return patches, out.select("fid", "place", "seq", status.alias("status"))


def missing_files(catalog: DataFrame, listing: DataFrame, key: str, volume: str, path: str, mounted: Sequence[str]) -> DataFrame:
    """(key, status) of catalog rows that the listing of the volumes lacks: missing, or skipped on an unhealthy volume.

    A volume is healthy when it is mounted and the file of its smallest key is listed: if that one is gone, the whole
    volume may be, and nothing of it is called missing. Rows without a path are left out.
    """
    rows = catalog.filter(F.coalesce(F.col(path), F.lit("")) != "").select(key, volume, path)
    on_disk = listing.select(F.col(volume).alias("_v"), F.col(path).alias("_p")).distinct()
    sample = rows.groupBy(volume).agg(F.min_by(path, key).alias("_p"))
    healthy = sample.filter(F.col(volume).isin(list(mounted))).join(
        on_disk, (F.col(volume) == F.col("_v")) & (sample["_p"] == on_disk["_p"]), "left_semi").select(F.col(volume).alias("_healthy"))
    gone = rows.join(on_disk, (F.col(volume) == F.col("_v")) & (F.col(path) == F.col("_p")), "left_anti")
    out = gone.join(healthy, F.col(volume) == F.col("_healthy"), "left")
    return out.select(key, F.when(F.col("_healthy").isNotNull(), "missing").otherwise("skipped").alias("status"))
