"""Helpers the operators of this package share: row keys, whole texts as bytes, blocks of hashed words."""

from __future__ import annotations

import gc
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.session import shared_root

#: Stands for a null id inside the operators: such rows sort before all others and come out with a null id again.
NULL_ID = -(1 << 63)
#: Words a memo holds before it starts anew, which bounds a worker's memory and changes no result.
MEMO_WORDS = 1 << 18
#: Words of a block of whole documents worked on at once; a longer document is a block of its own.
BLOCK_WORDS = 1 << 18

GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def key_columns(id_col: str = "doc_id", text_col: str = "text") -> list[Column]:
    """The two columns an operator reads: doc_id (NULL_ID for null) and text."""
    return [F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("doc_id"), F.col(text_col).cast("string").alias("text")]


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Those two columns alone, whatever else the table holds."""
    return docs.select(*key_columns(id_col, text_col))


def id_out(name: str = "doc_id") -> Column:
    """The id as it was given: null where NULL_ID stood for it."""
    return F.when(F.col(name) != NULL_ID, F.col(name)).alias(name)


def settled(df: DataFrame) -> DataFrame:
    """``df`` computed once into the folder of ``spark.checkpoint.dir``: lineage is cut, lost executors cost nothing.

    Spark removes these files (``spark.cleaner.referenceTracking.cleanCheckpoints``) and the shuffle files of the step when
    the driver's collector finds that nothing refers to them; it is asked to look after every step, as a step's shuffles
    can be as large as the table.
    """
    spark = df.sparkSession
    shared_root(spark)
    out = df.checkpoint()
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    return out


def ranges(spark: SparkSession, rows: int, per_range: int = 1_000_000) -> int:
    """Ranges for so many rows: ``per_range`` rows each, but a range per core at least."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // per_range))


def raw(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8 bytes, null as empty."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


class WordHashes(dict):
    """Memo of 64-bit word hashes."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def grams(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each position on; empty where fewer words are left."""
    if len(words) < n:
        return np.empty(0, np.uint64)
    total = np.zeros(len(words) - n + 1, np.uint64)
    for k in range(n):
        total = total * GOLDEN + words[k:len(words) - n + 1 + k]
    return mixed(total ^ np.uint64(n))


def word_blocks(batches: Iterable[pa.RecordBatch], lower: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, words per document, hashes of all words) of blocks of whole documents.

    Words are runs without the six ASCII blanks, as ``bytes.split`` takes them; ``lower`` lower-cases A-Z only.
    """
    memo = WordHashes()
    ids: list[int] = []
    parts: list[np.ndarray] = []
    held = 0

    def block():
        return (np.array(ids, np.int64), np.array([len(p) for p in parts], np.int64),
                np.concatenate(parts) if parts else np.empty(0, np.uint64))

    for batch in batches:
        doc_ids = batch.column(0).to_pylist()
        for doc_id, text in zip(doc_ids, batch.column(1).cast(pa.large_binary())):
            data = text.as_py() or b""
            words = (data.lower() if lower else data).split()
            ids.append(doc_id)
            parts.append(np.fromiter(map(memo.__getitem__, words), np.uint64, len(words)))
            held += len(words)
            if held >= BLOCK_WORDS:
                yield block()
                ids, parts, held = [], [], 0
    if ids:
        yield block()
