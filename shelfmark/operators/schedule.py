"""Schedule grids: header rows of dates, bodies below them, years that roll over."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.functions.names import clean_title, editor_tag, remove_editor_tag
from shelfmark.functions.paths import strip
from shelfmark.functions.values import is_date_cell
from shelfmark.operators.lanes import keep_ranked, range_bucket
from shelfmark.operators.predicates import contains_any


def year_rollover(df: DataFrame, sheet: str, order: Sequence[str], month: str, day: str, base_year: Column,
                  year_only: Column, any_month: str | None = None) -> DataFrame:
    """Adds ``date``: the year grows whenever the month falls. A year-only sheet ends in its base
    year. An impossible date is null but still counts as the previous month.

    A row without ``month`` gets no date and is passed over; the total that a year-only sheet
    counts back by follows ``any_month`` (the month alone could be read) where it is given. Rows that already have their
    ``_bucket`` of (sheet, order) are taken as they are.
    """
    order, total = list(order), any_month or month
    rows = df if "_bucket" in df.columns else range_bucket(df, [sheet, *order])
    local = Window.partitionBy(sheet, "_bucket").orderBy(*order)
    ahead = local.rowsBetween(Window.unboundedPreceding, -1)

    def falls(m: str, before: Column) -> Column:
        return F.coalesce((F.col(m) < before).cast("int"), F.lit(0))

    rows = rows.withColumn("_in", falls(month, F.last(month, True).over(ahead)))
    rows = rows.withColumn("_tin", falls(total, F.last(total, True).over(ahead)))
    rows = rows.withColumn("_cum", F.sum("_in").over(local.rowsBetween(Window.unboundedPreceding, 0)))
    # one row per (sheet, bucket): its own rollovers and the one at its left edge
    at = F.struct(*order)

    def edge(pick, m: str) -> Column:
        return pick(m, F.when(F.col(m).isNotNull(), at))

    edges = rows.groupBy(sheet, "_bucket").agg(
        F.sum("_in").alias("_n"), F.sum("_tin").alias("_tn"),
        edge(F.min_by, month).alias("_first"), edge(F.max_by, month).alias("_last"),
        edge(F.min_by, total).alias("_tfirst"), edge(F.max_by, total).alias("_tlast"))
    per = Window.partitionBy(sheet).orderBy("_bucket")
    left = per.rowsBetween(Window.unboundedPreceding, -1)
    edges = edges.withColumn("_edge", falls("_first", F.last("_last", True).over(left)))
    edges = edges.withColumn("_tedge", falls("_tfirst", F.last("_tlast", True).over(left)))
    # the left edge falls at the first readable month of the bucket, and nothing in front of it has a date
    edges = edges.select(
        F.col(sheet).alias("_s"), F.col("_bucket").alias("_b"),
        (F.sum(F.col("_n") + F.col("_edge")).over(per.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")).alias("_base"),
        F.sum(F.col("_tn") + F.col("_tedge")).over(Window.partitionBy(sheet)).alias("_rolls"))
    rows = rows.join(edges, F.col(sheet).eqNullSafe(F.col("_s")) & (F.col("_bucket") == F.col("_b")))
    year = F.when(year_only, base_year - F.col("_rolls")).otherwise(base_year) + F.col("_base") + F.col("_cum")
    iso = F.format_string("%04d-%02d-%02d", year.cast("int"), F.col(month).cast("int"), F.col(day).cast("int"))
    date = F.when(F.col(month).isNotNull(), F.try_to_date(iso, "yyyy-MM-dd"))
    return rows.withColumn("date", date).drop("_bucket", "_in", "_tin", "_cum", "_s", "_b", "_base", "_rolls")


def header_cells(grid: DataFrame, sheet: str, min_dates: int = 3, per_row: int = 7) -> DataFrame:
    """Date cells (first ``per_row``) of the rows that hold at least ``min_dates`` of them."""
    dates = grid.filter(is_date_cell(F.col("cell")))
    first = keep_ranked(dates, [sheet, "row_idx"], [F.asc("col_idx")], max(per_row, min_dates), rank_col="_r")
    # the row partitioning of the ranking serves the count as well
    counted = first.withColumn("_n", F.max("_r").over(Window.partitionBy(sheet, "row_idx")))
    return counted.filter((F.col("_n") >= min_dates) & (F.col("_r") <= per_row)).drop("_r", "_n")


def assign_headers(grid: DataFrame, heads: DataFrame, sheet: str, body_rows: int = 4, header_rows: DataFrame | None = None) -> DataFrame:
    """Body cells with the header cell of their column: up to ``body_rows`` rows below, up to the next header.

    Each header offers itself to the rows below it (an equi join); the nearest offer wins. ``header_rows`` (sheet, row_idx) are
    those of ``heads`` where that costs less to read.
    """
    rows = (heads if header_rows is None else header_rows).select(sheet, F.col("row_idx").alias("header_row")).distinct()
    offers = rows.select(sheet, "header_row", F.explode(F.sequence(F.lit(0), F.lit(body_rows))).alias("_o"))
    nearest = offers.groupBy(sheet, (F.col("header_row") + F.col("_o")).alias("row_idx")).agg(
        F.max("header_row").alias("header_row")).filter(F.col("header_row") < F.col("row_idx"))
    body = grid.join(nearest, [sheet, "row_idx"])
    cols = heads.select(sheet, F.col("row_idx").alias("header_row"), "col_idx", F.col("cell").alias("header_cell"),
                        *[c for c in heads.columns if c not in (sheet, "row_idx", "col_idx", "cell")])
    return body.join(cols, [sheet, "header_row", "col_idx"])


def parse_schedule(grid: DataFrame, sheet: str, base_year: Column, year_only: Column, exclude: Sequence[str],
                   editors: Sequence[str], leading: Sequence[str], boundary: Sequence[str],
                   trailing: Sequence[str]) -> DataFrame:
    """(sheet, date, case_name, editor) of a long grid (sheet, row_idx, col_idx, cell); first record per
    date, 30 characters of the case and editor wins.
    """
    heads = header_cells(grid, sheet)
    cell = strip(F.col("cell"))
    heads = heads.withColumn("_mo", F.regexp_extract(cell, r"^(\d+)/(\d+)$", 1).try_cast("int")).withColumn(
        "_da", F.regexp_extract(cell, r"^(\d+)/(\d+)$", 2).try_cast("int")).withColumn(
        "_any", F.regexp_extract(cell, r"^(\d+)/", 1).try_cast("int"))
    heads = range_bucket(heads, [sheet, "row_idx", "col_idx"])      # written once, read by every later step
    dated = year_rollover(heads, sheet, ["row_idx", "col_idx"], "_mo", "_da", base_year, year_only, "_any")
    dated = dated.select(sheet, "row_idx", "col_idx", "cell", "date")
    header_rows = heads.select(sheet, "row_idx").distinct()
    # what a cell itself decides is decided before anything is shuffled
    text = F.coalesce("cell", F.lit(""))
    cells = grid.filter((text != "") & (text != "nan") & ~contains_any(text, exclude))
    cells = cells.withColumn("editor", editor_tag(F.col("cell"), editors)).filter(F.col("editor").isNotNull())
    body = assign_headers(cells, dated, sheet, header_rows=header_rows).filter(F.col("date").isNotNull())
    body = body.join(header_rows, [sheet, "row_idx"], "left_anti")
    body = body.withColumn("case_name", clean_title(remove_editor_tag(F.col("cell")), leading, boundary, trailing))
    body = body.filter(F.col("case_name") != "").withColumn("_c30", F.left("case_name", F.lit(30)))
    first = keep_ranked(body, [sheet, "date", "_c30", "editor"], [F.asc("header_row"), F.asc("row_idx"), F.asc("col_idx")])
    return first.select(sheet, "date", "case_name", "editor")
