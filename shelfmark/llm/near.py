"""Near duplicates: MinHash bands propose, odd sketches estimate, whole shingle sets decide, stars join up components."""

from __future__ import annotations

from collections import deque
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import grams, id_out, keyed, mixed, ranges, raw, settled, word_blocks


@dataclass(frozen=True)
class Settings:
    """How near duplicates are found.

    ``bands`` of ``rows`` MinHash values each: a pair at the similarity s shares no band with probability
    (1 - s**rows)**bands, 3e-6 at 0.8 with the default. For documents that share one, odd sketches fold ``samples``
    further MinHash values into ``sketch_words`` * 64 parity bits. Pairs estimated at less than ``percent`` - ``slack``
    are not looked at in full: 4.7 standard errors of the estimate, so 2e-6 of the pairs just similar enough are lost.
    """

    shingle: int = 5
    percent: int = 80
    bands: int = 32
    rows: int = 5
    samples: int = 2048
    sketch_words: int = 128
    slack: float = 5.5
    #: leaders of a band value, picked at random, that its members are compared with before anything else
    leaders: int = 2
    #: documents of one band value compared with one another in one task
    block: int = 1000


def _sets(batches, n, lower):
    """(id, sorted distinct shingle hashes) per document; fewer words than a shingle: the whole sequence as one."""
    for ids, lengths, words in word_blocks(batches, lower):
        ends = np.cumsum(lengths)
        for doc_id, start, end in zip(ids.tolist(), ends - lengths, ends):
            own = words[start:end]
            yield doc_id, np.unique(grams(own, min(n, len(own))) if len(own) else own)


def _odd_sketch(samples: np.ndarray, words: int) -> np.ndarray:
    """Parity bitmap: every sample flips one bit."""
    bits = mixed(samples + np.arange(1, len(samples) + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)) % np.uint64(64 * words)
    parity = np.bincount(bits.astype(np.int64), minlength=64 * words) & 1
    return np.packbits(parity.astype(np.uint8), bitorder="little").view(np.int64)


def _lowest(own: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """A MinHash value per seed: multiplication by an odd number permutes the mixed hashes."""
    low = np.full(len(seeds), np.iinfo(np.uint64).max)
    for i in range(0, len(own), 1024):
        low = np.minimum(low, (own[i:i + 1024, None] * seeds).min(axis=0))
    return low


def _seeds(first: int, n: int) -> np.ndarray:
    return mixed(np.arange(first, first + n, dtype=np.uint64)) | np.uint64(1)


def _in_batches(rows, names, types, size=2000):
    held = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names)


def _signatures(s: Settings, lower: bool):
    def rows(batches):
        seeds, hashes = _seeds(1, s.bands * s.rows), deque()

        def noted():        # documents come out in the order they go in
            for batch in batches:
                hashes.extend(xxhash.xxh64_intdigest(t, seed=42) for t in raw(batch.column(1)))     # as Spark's xxhash64
                yield batch

        for doc_id, own in _sets(noted(), s.shingle, lower):
            h = int(np.uint64(hashes.popleft()).view(np.int64))
            f1, f2 = np.frombuffer(xxhash.xxh3_128_digest(own.tobytes()), np.int64).tolist()
            low = _lowest(own, seeds).reshape(s.bands, s.rows) if len(own) else ()
            bands = np.array([xxhash.xxh3_64_intdigest(b.tobytes(), seed=i) for i, b in enumerate(low)], np.uint64)
            yield doc_id, h, len(own), f1, f2, bands.view(np.int64)

    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
    return lambda batches: _in_batches(rows(batches), ["doc_id", "text_hash", "n_shingles", "f1", "f2", "bands"], types)


def _shingle_sets(s: Settings, lower: bool):
    """Whole sets, and their odd sketches: parity bitmaps in which every MinHash sample flips one bit."""
    def rows(batches):
        seeds = _seeds(1 << 32, s.samples)
        place = np.arange(1, s.samples + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)
        for doc_id, own in _sets(batches, s.shingle, lower):
            bits = mixed(_lowest(own, seeds) + place) % np.uint64(64 * s.sketch_words)
            parity = np.bincount(bits.astype(np.int64), minlength=64 * s.sketch_words) & 1
            yield doc_id, own.tobytes(), np.packbits(parity.astype(np.uint8), bitorder="little").tobytes()

    return lambda batches: _in_batches(rows(batches), ["id", "hashes", "sketch"], [pa.int64(), pa.binary(), pa.binary()], 500)


def _estimate(differing: np.ndarray, s: Settings) -> np.ndarray:
    """Similarity from the number of differing parity bits of two odd sketches."""
    n, k = 64 * s.sketch_words, s.samples
    apart = -n / 2 * np.log(np.maximum(1 - 2 * differing / n, 1e-9))
    return 1 - apart / (2 * k)


def _least(s: Settings) -> float:
    return (s.percent - s.slack) / 100


def _sketched(s: Settings):
    """Keep the pairs whose sketches allow the wanted similarity."""
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                a, b = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint64).reshape(batch.num_rows, -1)
                        for i in (2, 3))
                good = _estimate(np.bitwise_count(a ^ b).sum(axis=1), s) >= _least(s)
                yield pa.RecordBatch.from_arrays([batch.column(i).filter(pa.array(good)) for i in (0, 1)], ["a", "b"])
    return run


def _confirmed(s: Settings):
    """Keep the pairs whose whole sets are similar enough."""
    def run(batches):
        for batch in batches:
            good = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = (np.frombuffer(v.as_py(), np.uint64) for v in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * both >= s.percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(pa.array(good, pa.bool_())) for i in (0, 1)], ["a", "b"])
    return run


def _verified(pairs: DataFrame, sets: DataFrame, s: Settings) -> DataFrame:
    """The pairs (a, b) confirmed on the whole sets."""
    x, y = sets.select(F.col("id").alias("a"), F.col("hashes").alias("x")), sets.select(F.col("id").alias("b"), F.col("hashes").alias("y"))
    return settled(pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(_confirmed(s), "a long, b long"))


def _leaders(banded: DataFrame, s: Settings) -> DataFrame:
    """band, members, leads of the values that several documents have: a few random members, combined on the map side."""
    pick = [F.min(F.struct(F.xxhash64(F.lit(i), "band", "doc_id").alias("turn"), "doc_id", "n_shingles")).alias(f"lead{i}")
            for i in range(s.leaders)]
    found = banded.groupBy("band").agg(F.count("*").alias("members"), *pick).where("members > 1")
    leads = F.array(*[F.struct(f"lead{i}.doc_id", f"lead{i}.n_shingles") for i in range(s.leaders)])
    return found.select("band", "members", F.array_distinct(leads).alias("leads"))


def _cross_labels(s: Settings):
    """Pairs of one (band value, block pair) with different labels whose sizes and sketches allow a link.

    Of the band values a pair shares only the smallest gives it.
    """
    def run(key, table):
        band, first, second = (k.as_py() for k in key)
        bands = [b.values.to_numpy() for b in table.column("bands").combine_chunks()]
        block, ids, label, n = (table.column(c).to_numpy() for c in ("part", "doc_id", "label", "n_shingles"))
        sketches = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint64).reshape(len(ids), -1)
        left, right = np.flatnonzero(block == first), np.flatnonzero(block == second)
        found = [[], []]
        for i in left:
            j = right[(label[right] != label[i]) & (ids[right] > ids[i] if first == second else True)
                      & (100 * np.minimum(n[right], n[i]) >= s.percent * np.maximum(n[right], n[i]))]
            if len(j):
                j = j[_estimate(np.bitwise_count(sketches[j] ^ sketches[i]).sum(axis=1), s) >= _least(s)]
                j = j[np.array([np.intersect1d(bands[i], bands[x]).min() == band for x in j], bool)]
                found[0].append(np.minimum(ids[j], ids[i]))
                found[1].append(np.maximum(ids[j], ids[i]))
        a, b = (np.concatenate(f) if f else np.empty(0, np.int64) for f in found)
        return pa.table({"a": a, "b": b})
    return run


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, label: the smallest node reachable over the links, for every node that has one.

    Alternates large stars (larger neighbours move to the smallest one around) and small stars (smaller neighbours
    join up) until nothing moves. Every round is written to the shared folder; hot nodes are combined on the map side.
    No round has more edges than the one before, so the first count says how many tasks read and write them: what a task
    reports stays on the driver, and rounds are many.
    """
    edges = settled(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u != v").distinct())
    parts = ranges(edges.sparkSession, edges.count())
    edges = edges.coalesce(parts)
    before = None
    while True:
        both = edges.select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("e")).select("e.*")
        low = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(
            F.struct(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v")),
            F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.*").where("u != v").distinct()
        edges = settled(small.coalesce(parts))
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()).coalesce(parts)
        before = state


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
                    settings: Settings = Settings(), lower: bool = True) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, text_hash (xxhash64 of the text, null as empty) for every row.

    Words are runs without ASCII blanks, A-Z lower-cased if ``lower``. A document's set: its distinct shingles of
    ``settings.shingle`` words; with fewer words the whole sequence; null, empty and blank texts: the empty set, linked
    with nothing. Documents whose intersection is at least ``percent`` % of the union are linked; component_id is the
    smallest id reachable. A null id is smaller than all others (its component id is null). Rows that repeat
    an id with other words are linked through it, so give them ids of their own. Other columns are not read; an empty table gives no rows.

    Equal sets are one class, represented by its smallest id. Of each band value all members are compared with a few
    leaders, which differ from band to band; what that links is joined up. Only where a band value still holds several
    components are members of different components compared with one another, block by block: large groups of near
    copies never become pairs, and no link between components is lost.
    """
    s = settings
    rows = keyed(docs, id_col, text_col)
    signed = settled(rows.mapInArrow(_signatures(s, lower), "doc_id long, text_hash long, n_shingles long, f1 long, f2 long, bands array<long>"))
    classes = settled(signed.where("n_shingles > 0").groupBy("f1", "f2").agg(F.min("doc_id").alias("rep")))
    reps = settled(signed.join(classes, ["f1", "f2"]).where("doc_id = rep").dropDuplicates(["doc_id", "f1", "f2"]))

    banded = reps.select("doc_id", "n_shingles", F.explode("bands").alias("band"))
    leads = _leaders(banded, s)
    shared = settled(banded.join(leads, "band"))
    sized = F.least("n_shingles", "lead.n_shingles") * 100 >= F.greatest("n_shingles", "lead.n_shingles") * s.percent
    pairs = shared.select("doc_id", "n_shingles", F.explode("leads").alias("lead")).where(
        (F.col("doc_id") != F.col("lead.doc_id")) & sized)
    pairs = pairs.select(F.least("doc_id", "lead.doc_id").alias("a"), F.greatest("doc_id", "lead.doc_id").alias("b")).distinct()
    needed = shared.select("doc_id").distinct()
    sets = settled(rows.join(needed, "doc_id", "left_semi").mapInArrow(_shingle_sets(s, lower), "id long, hashes binary, sketch binary"))
    sketches = sets.select("id", "sketch")
    pairs = (pairs.join(sketches.toDF("b", "sb"), "b").join(sketches.toDF("a", "sa"), "a").select("a", "b", "sa", "sb")
             .mapInArrow(_sketched(s), "a long, b long"))
    links = _verified(pairs, sets, s)
    labels = settled(components(links))

    # band values that hold several components: compare across components only
    label = F.coalesce("label", "doc_id").alias("label")
    members = shared.join(labels.withColumnRenamed("node", "doc_id"), "doc_id", "left").select(
        "band", "doc_id", "n_shingles", "members", label)
    mixed_bands = (members.groupBy("band").agg(F.min("label").alias("low"), F.max("label").alias("high"))
                   .where("low != high").select("band"))
    parts = F.ceil(F.col("members") / s.block).cast("int")
    members = (members.join(mixed_bands, "band").join(sketches.withColumnRenamed("id", "doc_id"), "doc_id")
               .join(reps.select("doc_id", "bands"), "doc_id")
               .withColumn("part", F.pmod(F.xxhash64("doc_id"), parts).cast("int")))
    met = members.withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1))).withColumns(
        {"i": F.least("part", "other"), "j": F.greatest("part", "other")}).drop("members", "other")
    late = met.groupBy("band", "i", "j").applyInArrow(_cross_labels(s), "a long, b long").distinct()
    more = _verified(late, sets, s)
    if not more.isEmpty():
        # the labels say all that the links did, in fewer rows
        labels = components(labels.toDF("a", "b").unionByName(more))

    found = classes.join(labels.withColumnRenamed("node", "rep"), "rep", "left").select(
        "f1", "f2", F.coalesce("label", "rep").alias("component_id"))
    out = signed.select("doc_id", "text_hash", "n_shingles", "f1", "f2").join(found, ["f1", "f2"], "left").withColumn(
        "component_id", F.coalesce("component_id", "doc_id"))
    return out.select(id_out(), "n_shingles", id_out("component_id"),
                      (F.col("doc_id") == F.col("component_id")).alias("kept"), "text_hash")
