"""JSON snapshots, dictionaries and nested documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.operators.lanes import numbered


def write_envelopes(df: DataFrame, key: str, path: str, scanned_at: Column, rows_per_envelope: int = 1000) -> None:
    """{scanned_at, count, rows[]} objects, one per line, of bounded size."""
    at = numbered(df.withColumn("_row", F.struct(*df.columns)), [key])
    batch = F.floor((F.col("rn") - 1) / rows_per_envelope)
    env = at.groupBy(batch.alias("b")).agg(F.collect_list("_row").alias("rows"))
    env.select(scanned_at.alias("scanned_at"), F.size("rows").cast("bigint").alias("count"), "rows").write.json(path)


def read_envelopes(spark: SparkSession, path: str, row_schema: str, multi_line: bool = False) -> DataFrame:
    """Rows of every envelope with its header and ``count_ok`` (stated count = rows found)."""
    schema = f"scanned_at string, count bigint, rows array<struct<{row_schema}>>"
    env = spark.read.schema(schema).option("multiLine", multi_line).json(path)
    return env.select("scanned_at", (F.col("count") == F.size("rows")).alias("count_ok"), F.inline("rows"))


def dict_entries(df: DataFrame, text: str, value_type: str, comment_keys: Sequence[str] = ()) -> DataFrame:
    """Rows of JSON objects used as dictionaries; comment keys and empty values are left out."""
    out = df.select(*[c for c in df.columns if c != text],
                    F.explode(F.from_json(F.col(text), f"map<string,{value_type}>")).alias("key", "value"))
    out = out.filter(F.col("value").isNotNull() & ~F.col("key").isin(list(comment_keys)))
    return out.filter(F.col("value") != "") if value_type == "string" else out


def read_dict(spark: SparkSession, path: str, value_type: str, comment_keys: Sequence[str] = ()) -> DataFrame:
    return dict_entries(spark.read.text(path, wholetext=True), "value", value_type, comment_keys)


FORECAST = ("struct<Locations:array<struct<Location:array<struct<LocationName:string,WeatherElement:array<struct<"
            "ElementName:string,Time:array<struct<StartTime:string,ElementValue:array<map<string,string>>>>>>>>>>>")


def flatten_forecast(df: DataFrame, text: str, value_keys: Sequence[str]) -> DataFrame:
    """(location, element, start_time, value): the first usable of ``value_keys``; '-' and '' are missing."""
    doc = df.select(F.from_json(text, f"records {FORECAST}").alias("d"))
    place = doc.select(F.explode("d.records.Locations").alias("g")).select(F.explode("g.Location").alias("l"))
    element = place.select(F.col("l.LocationName").alias("location"), F.explode("l.WeatherElement").alias("e"))
    slot = element.select("location", F.col("e.ElementName").alias("element"), F.explode("e.Time").alias("t"))

    def usable(key: str) -> Column:
        found = F.transform("t.ElementValue", lambda m: F.try_element_at(m, F.lit(key)))
        return F.get(F.filter(found, lambda v: v.isNotNull() & ~v.isin("", "-")), F.lit(0))
    return slot.select("location", "element", F.col("t.StartTime").alias("start_time"),
                       F.coalesce(*[usable(k) for k in value_keys]).alias("value"))
