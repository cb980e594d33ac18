"""File listings."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark import constants as C
from shelfmark.functions import paths as P
from shelfmark.sources.walk import list_volume


def file_inventory(spark: SparkSession, root: str, volume: str, extensions: Sequence[str] | None = None,
                   max_depth: int = C.MAX_DEPTH, prune_names: Sequence[str] = (),
                   prune_prefixes: Sequence[str] = ()) -> DataFrame:
    """One row per file below ``root``; no file is read.

    A folder without a scheme is one that the executors mount: they list it, pruned before it is opened. Another store is
    listed by Spark, and pruned afterwards; file contents are pruned from that plan.
    """
    base = root.rstrip("/")
    if "://" not in base:
        return list_volume(spark, base, volume, extensions, max_depth, prune_names, prune_prefixes)
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(base)
             .select("path", "length", "modificationTime"))
    # a store may write its name in more than one way: paths are compared behind it
    below = len(re.sub(r"^\w+://[^/]*", "", base)) + 2
    rel = F.substr(F.regexp_replace("path", r"^\w+:(//[^/]*)?", ""), F.lit(below))
    rows = files.select(
        rel.alias("rel_path"), P.file_name(rel).alias("filename"), P.extension(P.file_name(rel)).alias("ext"),
        F.col("length").alias("size_bytes"), F.col("modificationTime").alias("mtime"), F.lit(volume).alias("volume"))
    return scan_filters(rows, extensions, max_depth, prune_names, prune_prefixes)


def scan_filters(rows: DataFrame, extensions: Sequence[str] | None = None, max_depth: int = C.MAX_DEPTH,
                 prune_names: Sequence[str] = (), prune_prefixes: Sequence[str] = ()) -> DataFrame:
    """Folder, depth, sidecar and extension rules over (rel_path, filename, ext)."""
    folders = F.regexp_replace("rel_path", r"/?[^/]*$", "")
    out = rows.filter(~F.col("filename").startswith(C.SIDECAR_PREFIX)).filter(P.depth(F.col("rel_path")) <= max_depth)
    if prune_names or prune_prefixes:
        out = out.filter(~P.pruned_folder(folders, prune_names, prune_prefixes))
    return out.filter(F.col("ext").isin(list(extensions))) if extensions else out
