"""Line-oriented JSON journals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark import constants as C
from shelfmark.functions.text import truncate_with_marker


def _fields(schema: str | T.StructType) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def _read(doc: Column, field: T.StructField) -> Column:
    """A field of a parsed line; null where its value is of another type."""
    path, kind = f"$['{field.name}']", field.dataType
    if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
        return F.try_variant_get(doc, path, kind.simpleString())
    return F.try_variant_get(doc, path, "string").try_cast(kind)


def _parsed(lines: DataFrame, line: str) -> DataFrame:
    """The lines that are not blank, with ``_doc``: null where the line is no JSON object, whatever its types."""
    doc = F.try_parse_json(F.col(line))
    return lines.filter(F.trim(line) != "").withColumn(
        "_doc", F.when(F.schema_of_variant(doc).startswith("OBJECT"), doc))


def parse_tolerant(lines: DataFrame, line: str, schema: str | T.StructType, fail_status: str = "mv-fail") -> DataFrame:
    """Journal records; a malformed line becomes a ``fail_status`` record holding its cut raw text.

    ``schema`` must name a ``status`` column. Blank lines are left out. Only lines that are no JSON object are
    malformed; a value of another type than the schema's is null.
    """
    doc, bad = F.col("_doc"), F.col("_doc").isNull()
    fields = {f.name: _read(doc, f) for f in _fields(schema)}
    cols = [F.when(bad, F.lit(fail_status)).otherwise(fields.pop("status")).alias("status")]
    cols += [c.alias(n) for n, c in fields.items()]
    cols.append(F.when(bad, truncate_with_marker(F.col(line), C.JOURNAL_TEXT_CAP)).alias("raw"))
    return _parsed(lines, line).select(*[c for c in lines.columns if c != line], *cols)


def read_tolerant(spark: SparkSession, path: str, schema: str | T.StructType, fail_status: str = "mv-fail") -> DataFrame:
    return parse_tolerant(spark.read.text(path), "value", schema, fail_status)


def read_dropping(spark: SparkSession, path: str, schema: str | T.StructType, status: str = "tag",
                  required: tuple[str, ...] = ()) -> DataFrame:
    """Journal records of one status; malformed lines are dropped, required fields must be present."""
    lines = _parsed(spark.read.text(path), "value").filter(F.col("_doc").isNotNull())
    rows = lines.select(*[_read(F.col("_doc"), f).alias(f.name) for f in _fields(schema)]).filter(F.col("status") == status)
    for f in required:
        rows = rows.filter(F.col(f).isNotNull())
    return rows
