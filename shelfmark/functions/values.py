"""Numbers, codes, dates, tag sets, JSON fields."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfmark import constants as C
from shelfmark.functions.paths import blank_to_null, strip


def hours_between(later: Column, earlier: Column) -> Column:
    """Exact hours, from microseconds."""
    us = F.unix_micros(later.cast("timestamp")) - F.unix_micros(earlier.cast("timestamp"))
    return us / F.lit(3_600_000_000.0)


def is_vertical(width: Column, height: Column) -> Column:
    """Taller than wide; null when a side is missing or the frame is square."""
    return F.when(height > width, F.lit(True)).when(width > height, F.lit(False))


def rotation_swap(width: Column, height: Column, rotation: Column, has_stream: Column, error: Column) -> Column:
    """struct(w, h): turned frames swap sides, no stream gives (0, 0), a probe error gives null (retry)."""
    turned = F.coalesce(rotation.isin(90, -90, 270, -270), F.lit(False))
    dims = F.struct(F.when(turned, height).otherwise(width).alias("w"), F.when(turned, width).otherwise(height).alias("h"))
    zero = F.struct(F.lit(0).cast("bigint").alias("w"), F.lit(0).cast("bigint").alias("h"))
    return F.when(error.isNull(), F.when(has_stream, dims).otherwise(zero))


def codec_normalize(codec: Column, aliases: dict[str, str], unknown: str = "UNKNOWN") -> Column:
    low = F.lower(strip(F.coalesce(codec, F.lit(""))))
    out = F.coalesce(blank_to_null(low), F.lit(unknown))
    for alias, name in aliases.items():
        out = F.when(low == alias, F.lit(name)).otherwise(out)
    return out


def short_flag(frames: Column, fps: Column, limit: float = C.SHORT_SECONDS) -> Column:
    """True below ``limit`` seconds; null when the length cannot be computed."""
    return F.when((frames > 0) & (fps > 0), F.try_divide(frames.cast("double"), fps) < limit)


def content_fingerprint(content: Column, size: Column, sample: int = 1 << 20) -> Column:
    """SHA-256 of head, middle and tail samples; of everything below three samples."""
    mid = F.floor(size / 2) - F.floor(F.lit(sample) / 2) + 1
    picked = F.concat(F.substr(content, F.lit(1), F.lit(sample)), F.substr(content, mid.cast("int"), F.lit(sample)),
                      F.substr(content, (size - sample + 1).cast("int"), F.lit(sample)))
    return F.sha2(F.when(size < 3 * sample, content).otherwise(picked), 256)


def model_status(excluded: Column, has_context: Column, file_found: Column, frame_ok: Column, answer_ok: Column,
                 place: Column, confidence: Column, place_city: Column, folder_cities: Column,
                 minimum: float = C.CONFIDENCE_MIN) -> Column:
    """First failing step of the model-result cascade, else 'tag'."""
    conf = F.coalesce(confidence, F.lit(0.0))
    outside = place_city.isNotNull() & ~F.coalesce(F.array_contains(folder_cities, place_city), F.lit(False))
    return (F.when(excluded, F.lit("excluded-folder"))
            .when(~has_context, F.lit("no-context"))
            .when(~file_found, F.lit("file-missing"))
            .when(~frame_ok, F.lit("ffmpeg-fail"))
            .when(~answer_ok, F.lit("gemini-fail"))
            .when((F.coalesce(place, F.lit("")) == "") | (conf < minimum), F.lit("low-conf"))
            .when(outside, F.lit("out-of-area"))
            .otherwise(F.lit("tag")))


def auto_apply_reason(confidence: Column, place: Column, excluded: Column, n_cities: Column,
                      min_conf: float = C.AUTO_APPLY_CONFIDENCE_MIN, max_len: int = C.AUTO_APPLY_PLACE_MAX_LEN,
                      allowed: str = C.PLACE_CHARS) -> Column:
    """'ok', or the code of the first reason why an automatic rename needs a person."""
    conf = F.coalesce(confidence, F.lit(0.0))
    p = F.coalesce(place, F.lit(""))
    return (F.when(conf < min_conf, F.lit("unsure"))
            .when(p == "", F.lit("no-place"))
            .when(F.length(p) > max_len, F.lit("long-place"))
            .when(~p.rlike(allowed), F.lit("odd-place"))
            .when(excluded, F.lit("excluded"))
            .when(n_cities > 1, F.lit("many-cities"))
            .otherwise(F.lit("ok")))


def verdict_by_tags(tags: Column, done: Sequence[str], yes: Sequence[str], no: Sequence[str],
                    yes_label: str, no_label: str) -> Column:
    """Tag-only verdict; null when nothing is known or the asset is done. ``yes`` beats ``no``."""
    def any_of(words: Sequence[str]) -> Column:
        return F.arrays_overlap(tags, F.array(*[F.lit(w) for w in words]))
    return F.when(F.coalesce(F.size(tags), F.lit(0)) > 0,
                  F.when(any_of(done), F.lit(None)).when(any_of(yes), F.lit(yes_label)).when(any_of(no), F.lit(no_label)))


def parse_iso_ts(text: Column) -> Column:
    """ISO-8601 with 'Z' or an offset; null when unreadable."""
    return F.try_to_timestamp(text)


def is_date_cell(text: Column) -> Column:
    t = strip(F.coalesce(text, F.lit("")))
    return t.rlike(C.DATE_CELL) & (F.length(t) <= C.DATE_CELL_MAX_LEN)


def weekday_label(day: Column, names: Sequence[str], fmt: str = C.WEEKDAY_FORMAT) -> Column:
    """M/D with the weekday name, Monday first in ``names``."""
    name = F.element_at(F.array(*[F.lit(n) for n in names]), F.weekday(day) + 1)
    return F.format_string(fmt, F.month(day), F.dayofmonth(day), name)


def tag_set(tags: Column) -> Column:
    return F.array_sort(F.array_distinct(tags))


def split_multi_value(text: Column, sep: str = "[/,]") -> Column:
    parts = F.transform(F.split(text, sep), strip)
    return F.array_distinct(F.filter(parts, lambda x: x != ""))


def json_from_noisy_text(text: Column, schema: str) -> Column:
    """Parse the fenced JSON object of an answer, else its widest {..}; null when there is none."""
    fenced = F.regexp_extract(text, C.FENCED_JSON, 1)
    loose = F.regexp_extract(text, C.LOOSE_JSON, 1)
    return F.from_json(F.coalesce(blank_to_null(fenced), blank_to_null(loose)), schema)


def code_label(code: Column, labels: dict, default: str = "code ") -> Column:
    out = F.concat(F.lit(default), code.cast("string"))
    for k, v in labels.items():
        out = F.when(code == k, F.lit(v)).otherwise(out)
    return out
