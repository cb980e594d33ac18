"""Clean-up, normalisation and matching of case names and place names."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfmark import constants as C
from shelfmark.functions.paths import blank_to_null, strip


def alternation(words: Sequence[str]) -> str:
    """Regex that matches any of the literal words, longest first."""
    return "|".join(re.escape(w) for w in sorted(words, key=len, reverse=True))


def tail_token(name: Column) -> Column:
    """Last fragment after '_', white space or a closing parenthesis."""
    return F.element_at(F.split(strip(name), C.TAIL_SPLIT), -1)


def normalize_city(city: Column, variants: dict[str, str], units: str) -> Column:
    """Replace a leading variant character, then drop one trailing unit character."""
    out = strip(city)
    for old, new in variants.items():
        out = F.regexp_replace(out, "^" + re.escape(old), new.replace("\\", "\\\\").replace("$", "\\$"))
    return blank_to_null(F.regexp_replace(out, f"[{re.escape(units)}]$", ""))


def normalize_district(district: Column, units: str, keep: Sequence[str]) -> Column:
    """Drop one trailing unit character per comma-separated item; short kept names stay."""
    def item(x: Column) -> Column:
        x = strip(x)
        return F.when(x.isin(list(keep)), x).otherwise(F.regexp_replace(x, f"[{re.escape(units)}]$", ""))
    return blank_to_null(F.array_join(F.filter(F.transform(F.split(district, ","), item), lambda x: x != ""), ","))


def detect_labels(candidates: Sequence[Column], pattern: str, labels: dict[str, str],
                  literals: Sequence[str]) -> Column:
    """Canonical labels of all pattern matches plus literal words, first seen first, joined by blanks."""
    mapping = F.create_map(*[F.lit(x) for kv in labels.items() for x in kv]) if labels else None

    def found(c: Column) -> Column:
        c = F.coalesce(c, F.lit(""))
        hits = F.regexp_extract_all(c, F.lit(pattern), F.lit(1))
        if mapping is not None:
            hits = F.transform(hits, lambda h: F.coalesce(F.try_element_at(mapping, h), h))
        words = [F.when(c.contains(w), F.array(F.lit(w))).otherwise(F.array().cast("array<string>")) for w in literals]
        return F.concat(hits, *words)
    return blank_to_null(F.array_join(F.array_distinct(F.concat(*[found(c) for c in candidates])), " "))


def clean_title(text: Column, leading: Sequence[str], boundary: Sequence[str], trailing: Sequence[str]) -> Column:
    """Searchable title out of a raw schedule cell."""
    s = strip(F.regexp_extract(text, r"^([^\n\r]*)", 1))
    s = strip(F.regexp_replace(s, C.TITLE_PAREN, " "))
    if leading:
        # each word at most once, in list order, with the joints behind it
        s = F.regexp_replace(s, "^" + "".join(f"(?:{re.escape(w)}[{C.TITLE_JOINTS}]*)?" for w in leading), "")
    s = F.regexp_replace(s, C.TITLE_DATE, "")
    s = F.regexp_replace(s, C.TITLE_NUMBER, "")
    if boundary:
        # the shortest text in front of any boundary word
        s = F.regexp_replace(s, f"(?s)(?:{alternation(boundary)}).*$", "")
    s = strip(s)
    s = F.regexp_replace(s, C.TITLE_TIMES, "")
    if trailing:
        s = F.regexp_replace(s, f"(?:[{C.TITLE_JOINTS}]*(?:{alternation(trailing)}))+$", "")
    return strip(F.regexp_replace(s, C.BLANKS, " "))


def search_key_cascade(name: Column, part_pattern: str, script_class: str) -> Column:
    """Keys from strong to weak: whole, before '_'/'-', without a trailing part number, leading script block."""
    head = strip(F.regexp_extract(name, f"^([^{C.KEY_HEAD_STOP}]*)", 1))
    bare = strip(F.regexp_replace(head, part_pattern, ""))
    base = F.when(bare != "", bare).otherwise(head)
    block = F.regexp_extract(base, f"^([{script_class}]+)", 1)
    keys = F.array(
        name,
        F.when((head != "") & (head != name), head),
        F.when((bare != "") & (bare != head), bare),
        F.when(F.length(block) >= 2, block),
    )
    return F.when(F.coalesce(name, F.lit("")) == "", F.array().cast("array<string>")).otherwise(
        F.array_distinct(F.filter(keys, lambda k: k.isNotNull())))


def normalize_for_match(s: Column) -> Column:
    return F.lower(F.regexp_replace(F.coalesce(s, F.lit("")), C.BLANKS, ""))


def normalize_building(s: Column) -> Column:
    return F.upper(F.regexp_replace(s, C.BUILDING_NOISE, ""))


def normalize_case(name: Column, link_text: str) -> Column:
    """Cut at the link line or at '(n-' / '(n/', squeeze white space."""
    s = F.regexp_replace(F.coalesce(name, F.lit("")), r"(?s)\s*\n\s*" + re.escape(link_text) + ".*$", "")
    s = F.regexp_replace(s, "(?s)" + C.CASE_PART, "")
    return strip(F.regexp_replace(s, C.BLANKS, " "))


def clean_noise_tokens(name: Column, noise: str) -> Column:
    """Numeric prefix, mmdd prefix, parentheses, noise words, trailing number."""
    s = F.regexp_replace(name, C.NOISE_URL_NUMBER, "")
    s = F.regexp_replace(s, C.NOISE_MMDD, "")
    s = F.regexp_replace(s, C.NOISE_PAREN, "")
    s = F.regexp_replace(s, rf"\s*(?:{noise})+\s*", "")
    return strip(F.regexp_replace(s, C.NOISE_TAIL_NUMBER, ""))


def name_similarity_accept(a: Column, b: Column, share: float = C.NAME_OVERLAP_SHARE) -> Column:
    """Either contains the other, or enough distinct characters are shared."""
    x, y = normalize_building(a), normalize_building(b)
    common = F.size(F.array_intersect(F.split(x, ""), F.split(y, "")))
    return x.contains(y) | y.contains(x) | (common >= F.least(F.length(x), F.length(y)) * F.lit(share))


def prefix_similarity_accept(a: Column, b: Column, n: int = 3) -> Column:
    x, y = F.upper(F.regexp_replace(a, r"\s", "")), F.upper(F.regexp_replace(b, r"\s", ""))
    return y.contains(F.left(x, F.lit(n))) | x.contains(F.left(y, F.lit(n)))


def editor_tag(text: Column, tags: Sequence[str]) -> Column:
    """First listed tag inside the first parentheses."""
    inside = strip(F.regexp_extract(F.coalesce(text, F.lit("")), C.EDITOR_PAREN, 1))
    out = F.lit(None).cast("string")
    for t in reversed(list(tags)):
        out = F.when(inside.contains(t), F.lit(t)).otherwise(out)
    return out


def remove_editor_tag(text: Column) -> Column:
    return strip(F.regexp_replace(text, C.EDITOR_PAREN_END, ""))


def parse_schedule_entry(text: Column) -> Column:
    """struct(title, editor): the closing '(..)' is the editor, a leading m/d goes away."""
    pat = C.ENTRY_EDITOR
    hit = strip(text).rlike(pat)
    body = F.when(hit, strip(F.regexp_replace(strip(text), pat, ""))).otherwise(text)
    return F.struct(
        strip(F.regexp_replace(body, C.ENTRY_DATE, "")).alias("title"),
        F.when(hit, F.regexp_extract(strip(text), pat, 1)).alias("editor"),
    )


def is_non_case(name: Column, patterns: Sequence[str], address_chars: str) -> Column:
    """Names that cannot be cases: too short, a long number without address words, or a listed pattern."""
    short = name.isNull() | (F.length(name) < 2)
    number = name.rlike(r"^\d{4,}") & ~name.rlike(f"[{re.escape(address_chars)}]")
    return F.coalesce(short | number | name.rlike("(?i)" + "|".join(patterns)), F.lit(True))


def has_script_chars(text: Column, script_class: str) -> Column:
    return text.rlike(f"[{script_class}]")


def has_place_suffix(name: Column, script_class: str) -> Column:
    """The stem carries '_' followed by a letter of the script."""
    return F.regexp_replace(name, r"\.[^.]*$", "").rlike(f"_[{script_class}]")
