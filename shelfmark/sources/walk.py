"""Mounted volumes as data sources: folder trees listed by the executors, and samples of files by ranged reads."""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from shelfmark import constants as C

LISTED = "rel_path string, filename string, ext string, size_bytes bigint, mtime timestamp, volume string"
#: Folders the driver opens to deal out work; what lies below them is listed by the tasks.
FOLDERS_TO_DEAL = 256


class _Folder(InputPartition):
    """A folder to list: with all below it, or its files alone."""

    def __init__(self, path: str, depth: int, whole: bool):
        super().__init__((path, depth, whole))
        self.path, self.depth, self.whole = path, depth, whole


class _Walk(DataSourceReader):
    def __init__(self, options: dict):
        self.root = options["path"].rstrip("/") or "/"
        self.volume = options["volume"]
        self.max_depth = int(options["max_depth"])
        self.names, self.prefixes, self.extensions = (json.loads(options[k]) for k in ("prune_names", "prune_prefixes", "extensions"))

    def _folders(self, path: str) -> list[str]:
        """The folders in a folder that are not pruned; links are not followed."""
        with os.scandir(path) as found:
            names = [e.name for e in found if e.is_dir(follow_symlinks=False)]
        return sorted(n for n in names if n not in self.names and not n.startswith(tuple(self.prefixes)))

    def partitions(self) -> list[_Folder]:
        """Folders level by level until there are enough to deal out."""
        done, level, depth = [], [self.root], 0
        while level and len(level) < FOLDERS_TO_DEAL and depth < self.max_depth:
            done += [_Folder(p, depth, False) for p in level]
            level = [os.path.join(p, n) for p in level for n in self._folders(p)]
            depth += 1
        return done + [_Folder(p, depth, True) for p in level]

    def _rows(self, path: str) -> Iterator[tuple]:
        from datetime import datetime, timezone
        with os.scandir(path) as found:
            files = [e for e in found if e.is_file()]
        for e in files:
            ext = os.path.splitext(e.name)[1][1:].lower()
            if e.name.startswith(C.SIDECAR_PREFIX) or (self.extensions and ext not in self.extensions):
                continue
            at = e.stat()
            yield (os.path.relpath(e.path, self.root), e.name, ext, at.st_size,
                   datetime.fromtimestamp(at.st_mtime_ns // 1_000_000 / 1000, timezone.utc), self.volume)

    def read(self, partition: _Folder) -> Iterator[tuple]:
        level, depth = [partition.path], partition.depth
        while level and depth < self.max_depth:
            for path in level:
                yield from self._rows(path)
            if not partition.whole:
                break
            depth += 1
            level = [os.path.join(p, n) for p in level for n in self._folders(p)] if depth < self.max_depth else []


class VolumeSource(DataSource):
    """``spark.read.format("volume")``: the files below a folder that every executor mounts."""

    @classmethod
    def name(cls) -> str:
        return "volume"

    def schema(self) -> str:
        return LISTED

    def reader(self, schema) -> DataSourceReader:
        return _Walk(self.options)


def list_volume(spark: SparkSession, root: str, volume: str, extensions: Sequence[str] | None = None, max_depth: int = C.MAX_DEPTH,
                prune_names: Sequence[str] = (), prune_prefixes: Sequence[str] = ()) -> DataFrame:
    """One row per file below ``root``, at most ``max_depth`` names deep.

    The driver opens a few hundred folders; their trees are listed by the tasks. A pruned folder is never opened, nor is
    one below the depth; sidecars and other extensions never become rows. No file is read.
    """
    spark.dataSource.register(VolumeSource)
    options = {"volume": volume, "max_depth": str(max_depth), "prune_names": json.dumps(list(prune_names)),
               "prune_prefixes": json.dumps(list(prune_prefixes)), "extensions": json.dumps(list(extensions or ()))}
    return spark.read.format("volume").options(**options).load(root)


def _sampled(sample: int):
    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for path in f["path"]:
                try:
                    with open(path, "rb") as file:
                        size = os.fstat(file.fileno()).st_size
                        digest = hashlib.sha256()
                        starts = (0, size // 2 - sample // 2, size - sample) if size >= 3 * sample else (0,)
                        for start in starts:
                            file.seek(start)
                            digest.update(file.read(sample if len(starts) > 1 else size))
                    out.append((path, size, digest.hexdigest(), None))
                except OSError as e:
                    out.append((path, None, None, type(e).__name__))
            yield pd.DataFrame(out, columns=["path", "size_bytes", "fingerprint", "error"]).astype({"size_bytes": "Int64"})
    return run


def file_fingerprints(files: DataFrame, path: str, sample: int = 1 << 20) -> DataFrame:
    """(path, size_bytes, fingerprint, error): SHA-256 of head, middle and tail of each file, of everything below three samples.

    Three ranges of each file are read, so its size doesn't matter; files lie on a volume that every executor mounts. A
    file that cannot be read has its error instead. The same as ``content_fingerprint`` over the file's bytes.
    """
    return files.select(F.col(path).cast("string").alias("path")).filter(F.col("path").isNotNull()).mapInPandas(
        _sampled(sample), "path string, size_bytes bigint, fingerprint string, error string")
