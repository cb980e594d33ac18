"""Sheets as ragged CSV files, one folder per sheet."""

from __future__ import annotations

import csv
import io
import itertools
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows of a file, which is what a task parses at once.
ROWS_PER_FILE = 50_000
SIZES = pa.schema([("sheet", pa.string()), ("file", pa.string()), ("rows", pa.int64()), ("width", pa.int32())])
ROWS = pa.schema([("sheet", pa.string()), ("file", pa.string()), ("i", pa.int64()), ("cells", pa.list_(pa.string()))])


def _quoted(cell: Column) -> Column:
    text = F.coalesce(cell, F.lit(""))
    return F.when(text.rlike('[",\r\n]'), F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(text)


def write_grids(df: DataFrame, sheet: str, row_idx: str, cells: str, path: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    """CSV files below ``<path>/sheet=<name>``, rows in order of ``row_idx``, each as long as its cells.

    Cells with commas, quotes or line breaks are quoted; null cells are empty. A file has at most ``rows_per_file`` whole rows,
    and a sheet is written by as many tasks as its rows take: its files follow one another by task and count in their names.
    """
    line = F.array_join(F.transform(cells, _quoted), ",")
    # a line without text would be lost among line ends
    line = F.when(line == "", F.lit('""')).otherwise(line)
    rows = df.select(F.col(sheet).cast("string").alias("sheet"), row_idx, line.alias("value"))
    (rows.repartitionByRange("sheet", row_idx).sortWithinPartitions("sheet", row_idx).select("sheet", "value")
     .write.option("lineSep", "\n").option("maxRecordsPerFile", rows_per_file).partitionBy("sheet").text(path))


def _parsed(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[str, str, Iterator[list[str]]]]:
    """Sheet, file and the rows of its text, one after another."""
    for batch in batches:
        for sheet, file, text in zip(*batch.columns):
            yield sheet.as_py(), file.as_py(), csv.reader(io.StringIO(text.as_py(), newline=""))


def _sizes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for sheet, file, grid in _parsed(batches):
        rows = width = 0
        for row in grid:
            rows, width = rows + 1, max(width, len(row))
        yield pa.RecordBatch.from_pydict({"sheet": [sheet], "file": [file], "rows": [rows], "width": [width]}, SIZES)


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for sheet, file, grid in _parsed(batches):
        start = 0
        while part := list(itertools.islice(grid, 5000)):
            n = len(part)
            yield pa.RecordBatch.from_pydict({"sheet": [sheet] * n, "file": [file] * n, "i": range(start, start + n), "cells": part}, ROWS)
            start += n


def read_grids(spark: SparkSession, path: str) -> DataFrame:
    """(sheet, row_idx, col_idx, cell) of every cell, 0-based; short rows are padded with '' to the width of their sheet.

    Rows may differ in length, quoted cells may hold commas, quotes and line breaks. The files of a sheet are parsed side by
    side, each row by row: first for its number of rows and width, then for its cells.
    """
    files = spark.read.schema("value string, sheet string").text(path, wholetext=True).select(
        "sheet", F.col("_metadata.file_name").alias("file"), "value")
    number = [F.regexp_extract("file", r"^part-(\d+)-.*\bc(\d+)\.", i).try_cast("long") for i in (1, 2)]
    sheet = Window.partitionBy("sheet")
    before = sheet.orderBy(*number, "file").rowsBetween(Window.unboundedPreceding, -1)
    sizes = files.mapInArrow(_sizes, "sheet string, file string, rows bigint, width int").select(
        F.col("sheet").alias("_sheet"), F.col("file").alias("_file"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"), F.max("width").over(sheet).alias("width"))
    rows = files.mapInArrow(_rows, "sheet string, file string, i bigint, cells array<string>")
    rows = rows.join(sizes, F.col("sheet").eqNullSafe(F.col("_sheet")) & (F.col("file") == F.col("_file")))
    padded = F.concat("cells", F.array_repeat(F.lit(""), F.col("width") - F.size("cells")))
    return rows.select("sheet", (F.col("start") + F.col("i")).alias("row_idx"), F.posexplode(padded).alias("col_idx", "cell"))
