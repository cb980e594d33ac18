"""Exact duplicates: counting quotient filters built per partition, merged by sorted remainders, checked by bytes."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import id_out, keyed, raw, settled

#: Rows of one fingerprint compared with their representative in one task, about.
VERIFY_ROWS = 2000
#: Fingerprints a task holds before it sends its filter on.
FILTER_ROWS = 1 << 20


def _fingerprints(batches):
    for batch in batches:
        texts = [t.lower() for t in raw(batch.column(1))]       # bytes.lower touches A-Z alone
        yield pa.RecordBatch.from_arrays([
            batch.column(0),
            pa.array(np.array([xxhash.xxh3_64_intdigest(t) for t in texts], np.uint64).view(np.int64)),
            pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
        ], ["doc_id", "fp", "text_sha256"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fp (64 bits of the normalised text), text_sha256 for every row."""
    return docs.mapInArrow(_fingerprints, "doc_id long, fp long, text_sha256 string")


def _build_filters(bits: int):
    """Filters of at most FILTER_ROWS fingerprints: a row per quotient with its sorted remainders and their counts."""
    def flush(held):
        values, counts = np.unique(np.concatenate(held), return_counts=True)
        quotients = (values >> np.uint64(64 - bits)).astype(np.int32)
        remainders = (values & np.uint64((1 << (64 - bits)) - 1)).astype(np.int64)
        starts = np.flatnonzero(np.r_[True, quotients[1:] != quotients[:-1]])
        offsets = pa.array(np.r_[starts, len(values)].astype(np.int32))
        return pa.RecordBatch.from_arrays(
            [pa.array(quotients[starts]), pa.ListArray.from_arrays(offsets, pa.array(remainders)),
             pa.ListArray.from_arrays(offsets, pa.array(counts.astype(np.int64)))], ["quotient", "remainders", "counts"])

    def run(batches):
        held, n = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch.column(0).to_numpy().view(np.uint64))
                n += batch.num_rows
            if n >= FILTER_ROWS:
                yield flush(held)
                held, n = [], 0
        if held:
            yield flush(held)
    return run


def _merge_filters(bits: int):
    """Merge the runs of a quotient, which come one after the other, by their sorted remainders; counts add up."""
    def merged(quotient, runs):
        remainders = np.concatenate([r for r, _ in runs])
        order = np.argsort(remainders, kind="stable")
        remainders, counts = remainders[order], np.concatenate([c for _, c in runs])[order]
        starts = np.flatnonzero(np.r_[True, remainders[1:] != remainders[:-1]])
        fp = remainders[starts].view(np.uint64) | (np.uint64(quotient) << np.uint64(64 - bits))
        return pa.RecordBatch.from_arrays([pa.array(fp.view(np.int64)), pa.array(np.add.reduceat(counts, starts))],
                                          ["fp", "n"])

    def run(batches):
        now, runs = None, []
        for batch in batches:
            for q, r, c in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                if q != now and runs:
                    yield merged(now, runs)
                    runs = []
                now = q
                runs.append((r.values.to_numpy(), c.values.to_numpy()))
        if runs:
            yield merged(now, runs)
    return run


def counted_fingerprints(prints: DataFrame, quotient_bits: int = 12) -> DataFrame:
    """fp, n: the counting quotient filters of all partitions, merged without loss.

    A filter sends a fingerprint once with its count, however often it occurs there, so hot texts send few rows.
    Raise ``quotient_bits`` with the table: a task merges one quotient at a time.
    """
    return (prints.select("fp")
            .mapInArrow(_build_filters(quotient_bits), "quotient int, remainders array<long>, counts array<long>")
            .repartition("quotient").sortWithinPartitions("quotient")
            .mapInArrow(_merge_filters(quotient_bits), "fp long, n long"))


def _normalised(batches):
    for batch in batches:
        texts = [t.lower() for t in raw(batch.column(1))]
        yield pa.RecordBatch.from_arrays([
            batch.column(0),
            pa.array(np.array([xxhash.xxh3_64_intdigest(t) for t in texts], np.uint64).view(np.int64)),
            pa.array(texts, pa.binary())], ["doc_id", "fp", "data"])


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
                     quotient_bits: int = 12) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row.

    Texts are equal when identical after lower-casing A-Z; null counts as empty. Of equal texts the row with the
    largest doc_id stays (a null id is smaller than all others, and a row that repeats both the id and the text of
    the one that stays is kept with it). Other columns of the table are not read. An empty table gives no rows.

    A fingerprint counted once is settled. Texts of the others are compared byte by byte with the text of the
    fingerprint's largest id, in salted groups of about ``VERIFY_ROWS``; what differs goes on to another round.
    """
    rows = keyed(docs, id_col, text_col)
    prints = settled(fingerprints(rows))
    repeated = settled(counted_fingerprints(prints, quotient_bits).where("n > 1"))
    single = prints.join(repeated, "fp", "left_anti").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "text_sha256")
    left = settled(rows.mapInArrow(_normalised, "doc_id long, fp long, data binary").join(repeated, "fp"))
    rounds = []
    while not left.isEmpty():
        salts = F.ceil(F.col("n") / VERIFY_ROWS).cast("int")
        reps = left.groupBy("fp").agg(F.max("doc_id").alias("rep_id"))
        reps = (left.join(reps, "fp").where("doc_id = rep_id").groupBy("fp", "rep_id", "n").agg(F.min("data").alias("rep"))
                .withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("n"))
        met = left.withColumn("salt", F.pmod(F.xxhash64("doc_id"), salts).cast("int")).join(reps, ["fp", "salt"])
        met = settled(met.select("doc_id", "fp", "n", "rep_id", F.sha2("data", 256).alias("text_sha256"),
                               F.when(F.col("data") != F.col("rep"), F.col("data")).alias("data")))
        rounds.append(met.where("data is null").drop("n", "data"))
        left = met.where("data is not null").select("doc_id", "fp", "data", "n")
    out = single
    for same in rounds:
        sizes = same.groupBy("fp", "rep_id").agg(F.count("*").alias("group_size"))
        out = out.unionByName(same.join(sizes, ["fp", "rep_id"]).select(
            "doc_id", F.col("rep_id").alias("keep_id"), "group_size", (F.col("doc_id") == F.col("rep_id")).alias("kept"),
            "text_sha256"))
    return out.select(id_out(), id_out("keep_id"), "group_size", "kept", "text_sha256")
