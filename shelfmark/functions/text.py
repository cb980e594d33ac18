"""Search text, tokens, similarity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfmark import constants as C
from shelfmark.functions.paths import blank_to_null


def build_search_text(channel: Column, case_name: Column, subpath: Column, name: Column, tags: Column,
                      city: Column, district: Column) -> Column:
    c, d = blank_to_null(city), blank_to_null(district)
    pair = F.when(c.isNotNull() & d.isNotNull(), F.concat(c, F.lit(" "), d))
    parts = [channel, case_name, subpath, name, F.array_join(tags, " ")]
    return F.concat_ws(" ", *[blank_to_null(p) for p in parts], c, d, pair)


def append_missing_tokens(text: Column, tokens: Sequence[Column], sequential: bool = False) -> Column:
    """Append tokens the text does not contain.

    By default every token is tested against the original text; ``sequential`` also sees the
    tokens appended before it.
    """
    base = F.coalesce(text, F.lit(""))
    if sequential:
        listed = F.filter(F.array(*tokens), lambda t: t.isNotNull() & (t != ""))
        return F.trim(F.aggregate(listed, base, lambda acc, t: F.when(F.contains(acc, t), acc).otherwise(
            F.concat_ws(" ", blank_to_null(acc), t))))
    missing = [F.when(~base.contains(t), blank_to_null(t)) for t in tokens]
    return F.trim(F.concat_ws(" ", base, *missing))


def remove_token(text: Column, token: Column, whole_token: bool = False) -> Column:
    """Drop ' t', then 't ', then every 't'. ``whole_token`` leaves longer words alone."""
    if whole_token:
        kept = F.filter(F.split(text, " "), lambda w: w != token)
        return F.trim(F.array_join(kept, " "))
    out = F.replace(text, F.concat(F.lit(" "), token), F.lit(""))
    out = F.replace(out, F.concat(token, F.lit(" ")), F.lit(""))
    return F.trim(F.replace(out, token, F.lit("")))


def truncate_with_marker(text: Column, limit: int = C.JOURNAL_TEXT_CAP, mark: str = C.TRUNCATED_MARK) -> Column:
    return (F.when(text.isNull(), F.lit(""))
            .when(F.length(text) > limit, F.concat(F.left(text, F.lit(limit)), F.lit(mark))).otherwise(text))


def text_near(text: Column, name: str, window: int = C.VICINITY_CHARS) -> Column:
    """The text around the first occurrence of ``name`` (any case); null when it does not occur."""
    at = F.instr(F.lower(text), name.lower())
    start = F.greatest(at - F.lit(window), F.lit(1))
    end = at + F.lit(len(name) + window)
    return F.when(at > 0, F.substr(text, start, end - start))


def first_contained(text: Column, entries: Sequence[str]) -> Column:
    """First entry, in list order, that occurs in the text."""
    out = F.lit(None).cast("string")
    for e in reversed(list(entries)):
        out = F.when(text.contains(e), F.lit(e)).otherwise(out)
    return out


def token_vicinity_find(text: Column, name: str, entries: Sequence[str], window: int = C.VICINITY_CHARS) -> Column:
    return first_contained(text_near(text, name, window), entries)


def trigrams(text: Column) -> Column:
    """Distinct 3-grams of the lower-case words, padded by two blanks in front and one behind."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    grams = F.transform(words, lambda w: F.transform(
        F.sequence(F.lit(1), F.length(w) + F.lit(1)),
        lambda i: F.substr(F.concat(F.lit("  "), w, F.lit(" ")), i, F.lit(3))))
    return F.array_distinct(F.flatten(grams))


def gram_similarity(a: Column, b: Column) -> Column:
    """Shared grams over all grams of two gram sets; 0 when both are empty."""
    common = F.size(F.array_intersect(a, b))
    return F.coalesce(F.try_divide(common.cast("double"), F.size(a) + F.size(b) - common), F.lit(0.0))


def trigram_similarity(a: Column, b: Column) -> Column:
    return gram_similarity(trigrams(a), trigrams(b))
