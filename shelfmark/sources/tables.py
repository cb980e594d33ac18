"""Table scans, pages and grids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark import constants as C
from shelfmark.functions.paths import file_name
from shelfmark.operators.lanes import numbered


def scan_once(df: DataFrame, key: str) -> DataFrame:
    """Every row of a paged source once per key."""
    return df.dropDuplicates([key])


def keyset_page(df: DataFrame, key: str, after, n: int = C.SCAN_PAGE) -> DataFrame:
    """The page that follows key ``after``: a pushed filter and a top-n."""
    page = df if after is None else df.filter(F.col(key) > after)
    return page.orderBy(key).limit(n)


def keyset_pages(df: DataFrame, key: str, n: int = C.SCAN_PAGE) -> DataFrame:
    """(page, first_key, last_key, rows) of a whole keyset scan."""
    page = (F.floor((F.col("rn") - 1) / n) + 1).alias("page")
    return numbered(df.select(key), [key]).groupBy(page).agg(
        F.min(key).alias("first_key"), F.max(key).alias("last_key"), F.count(F.lit(1)).alias("rows"))


def grid_long(df: DataFrame, row_idx: str, cells: Column) -> DataFrame:
    """(row_idx, col_idx, cell) of a ragged grid; short rows are padded with ''."""
    rows = df.select(row_idx, cells.alias("_cells"))
    width = rows.agg(F.max(F.size("_cells"))).scalar()
    padded = F.concat("_cells", F.array_repeat(F.lit(""), width - F.size("_cells")))
    return rows.select(row_idx, F.posexplode(padded).alias("col_idx", "cell"))


def document_source(df: DataFrame, path: str, keyword: str, categories: Sequence[str]) -> DataFrame:
    """Files whose name holds the keyword, with the innermost folder that is no category as their case."""
    folders = F.filter(F.slice(F.split(path, "/"), F.lit(1), F.size(F.split(path, "/")) - 1),
                       lambda s: (s != "") & ~s.isin(list(categories)))
    return df.withColumn("name", file_name(F.col(path))).filter(F.col("name").contains(keyword)).withColumn(
        "case_name", F.get(F.reverse(folders), F.lit(0)))


def spread(df: DataFrame) -> DataFrame:
    """Rows over all cores when the input has fewer splits than cores; unchanged (no shuffle) otherwise.

    For row-wise work that is heavy next to its input, on a table of a few files.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
