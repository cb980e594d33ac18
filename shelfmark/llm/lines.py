"""Lines that occur in several documents: range-partitioned hashes, first occurrences streamed, bitmaps returned."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import id_out, keyed, ranges, raw, settled

ORDER = ["h1", "h2", "doc_id", "row_hash", "pos"]


def _hash_lines(min_chars: int):
    def run(batches):
        for batch in batches:
            ids, hashes = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            at, pos, digests = [], [], []
            for i, text in enumerate(raw(batch.column(1))):
                for k, line in enumerate(text.split(b"\n")):
                    key = line.strip().lower()          # of bytes: the six ASCII blanks, and A-Z alone
                    if len(key) >= min_chars and (key.isascii() or len(key.decode()) >= min_chars):
                        at.append(i)
                        pos.append(k)
                        digests.append(xxhash.xxh3_128_digest(key))
            halves = np.frombuffer(b"".join(digests), ">i8").astype(np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(halves[:, 0]), pa.array(halves[:, 1]), pa.array(ids[at]), pa.array(hashes[at]),
                 pa.array(np.array(pos, np.int32))], ORDER)
    return run


def _runs(batch):
    """Starts of the runs of equal hashes in a sorted batch."""
    h1, h2 = batch.column(0).to_numpy(), batch.column(1).to_numpy()
    return h1, h2, np.flatnonzero(np.r_[True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])])


def _tails(batches):
    """The last hash of a partition and the first document it has there."""
    last, first = None, None
    for batch in batches:
        if batch.num_rows:
            h1, h2, starts = _runs(batch)
            s = starts[-1]
            if s or last != (h1[0], h2[0]):
                last, first = (h1[s], h2[s]), int(batch.column(2)[int(s)].as_py())
    if last is not None:
        yield pa.RecordBatch.from_pydict({"h1": [int(last[0])], "h2": [int(last[1])], "seen": [first]})


def _repeats(batches):
    """Stream sorted occurrences; pass on those that come after the first document of their hash."""
    last, first = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        h1, h2, starts = _runs(batch)
        docs = batch.column(2).to_numpy()
        firsts = docs[starts].copy()
        if last == (h1[0], h2[0]):
            firsts[0] = first
        last, first = (h1[-1], h2[-1]), firsts[-1]
        seen = np.repeat(firsts, np.diff(np.r_[starts, len(docs)]))
        # an earlier partition may have seen the hash with a smaller document
        carried = batch.column(5)
        seen = np.minimum(seen, carried.fill_null(np.iinfo(np.int64).max).to_numpy())
        late = pa.array(docs > seen)
        yield pa.RecordBatch.from_arrays([batch.column(i).filter(late) for i in (2, 3, 4)], ["doc_id", "row_hash", "pos"])


def _bitmaps(batches):
    for batch in batches:
        maps = []
        for positions in batch.column(2):
            drop = np.unique(positions.values.to_numpy())
            keep = np.ones((drop[-1] // 8 + 1) * 8, bool)       # whole bytes
            keep[drop] = False
            maps.append((len(drop), zlib.compress(np.packbits(keep).tobytes())))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array([n for n, _ in maps], pa.int64()),
             pa.array([m for _, m in maps], pa.binary())], ["doc_id", "row_hash", "n_dropped", "keep_bitmap"])


def _rows(docs, id_col, text_col):
    return keyed(docs, id_col, text_col).withColumn("row_hash", F.xxhash64("text"))


def line_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, min_chars: int = 10,
                 partitions: int | None = None) -> DataFrame:
    """doc_id, row_hash, n_dropped, keep_bitmap of every document that loses lines.

    A line's key is the line without ASCII blanks at its ends and with A-Z lower-cased. Keys of at least ``min_chars``
    code points found in several documents lose all lines but those of the smallest doc_id. The bitmap (zlib over
    packed bits, first line first) ends at the last dropped line. Null ids come before all others as NULL_ID; rows
    that share an id count as one document and are told apart by ``row_hash``.

    Occurrences are range-partitioned by (hash, document, position), so the occurrences of one frequent line spread
    over as many partitions as they fill. They are written once in that order, so that both passes see the same ranges:
    what a partition needs from those before it is the first document of the hash they end with, one row per partition.
    An empty table gives no rows.
    """
    lines = _rows(docs, id_col, text_col).mapInArrow(
        _hash_lines(min_chars), "h1 long, h2 long, doc_id long, row_hash long, pos int")
    if partitions is None:
        breaks = F.length(text_col) - F.length(F.replace(F.col(text_col), F.lit("\n"), F.lit("")))
        partitions = ranges(docs.sparkSession, docs.agg(F.sum(F.coalesce(breaks, F.lit(0)) + 1)).first()[0] or 0)
    ranged = settled(lines.repartitionByRange(partitions, *ORDER).sortWithinPartitions(*ORDER))
    tails = (ranged.mapInArrow(_tails, "h1 long, h2 long, seen long")
             .groupBy("h1", "h2").agg(F.min("seen").alias("seen")))
    late = (ranged.join(F.broadcast(tails), ["h1", "h2"], "left").select(*ORDER, "seen")   # a row per partition at most
            .sortWithinPartitions(*ORDER).mapInArrow(_repeats, "doc_id long, row_hash long, pos int"))
    return (late.groupBy("doc_id", "row_hash").agg(F.collect_list("pos").alias("pos"))     # lines of one document
            .mapInArrow(_bitmaps, "doc_id long, row_hash long, n_dropped long, keep_bitmap binary"))


def _kept_lines(batches):
    for batch in batches:
        counts, texts = [], []
        for text, bitmap in zip(raw(batch.column(1)), batch.column(3).to_pylist()):
            lines = text.split(b"\n")
            counts.append(len(lines))
            if bitmap:
                keep = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8))[:len(lines)].astype(bool)
                keep = np.r_[keep, np.ones(len(lines) - len(keep), bool)]
                lines = [line for line, k in zip(lines, keep) if k]
            texts.append(b"\n".join(lines))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(counts, pa.int64()), batch.column(2).fill_null(0),
             pa.array(texts, pa.binary()).cast(pa.string())], ["doc_id", "n_lines", "n_dropped", "kept_text"])


def kept_lines(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_text of every document: the bitmaps applied to the texts.

    Null and empty texts are one empty line; repeated rows each come out; an empty table gives no rows.
    """
    joined = _rows(docs, id_col, text_col).join(bitmaps, ["doc_id", "row_hash"], "left")
    return (joined.select("doc_id", "text", "n_dropped", "keep_bitmap")
            .mapInArrow(_kept_lines, "doc_id long, n_lines long, n_dropped long, kept_text string")
            .withColumn("doc_id", id_out()))
