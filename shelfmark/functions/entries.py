"""Checked location entries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def validate_entry(city: Column, district: Column, allowed: Sequence[str], stamp: str) -> Column:
    """struct(city, district, manual, stamp) when the city is allowed, else null."""
    entry = F.struct(city.alias("city"), F.coalesce(district, F.lit("")).alias("district"),
                     F.lit(True).alias("manual"), F.lit(stamp).alias("stamp"))
    return F.when(F.coalesce(city, F.lit("")).isin(list(allowed)) & (city != ""), entry)


def resolve_dataset(place: Column, direct: Sequence[str], townships: dict[str, str], units: Sequence[str]) -> Column:
    """struct(city, township): a listed city stands for itself, a township (with or without its unit) for its city."""
    out = F.lit(None).cast("struct<city:string,township:string>")
    for name, city in townships.items():
        forms = [name, *[name + u for u in units]]
        out = F.when(place.isin(forms), F.struct(F.lit(city).alias("city"), F.lit(name).alias("township"))).otherwise(out)
    return F.when(place.isin(list(direct)), F.struct(place.alias("city"), F.lit(None).cast("string").alias("township"))).otherwise(out)
