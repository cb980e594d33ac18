"""From raw documents to packed sequences: five stages, each an operator of ``shelfmark.llm`` whose decisions take effect.

A stage takes (spark, docs, sf_dir) and works on all that the one before kept. The first four return the columns of
``documents``; the last returns the pieces of the packed sequences. ``run`` writes every stage to the shared folder and
reads it back, so a lost executor costs one stage's tasks at most.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm import exact, language, near, packing, substring
from shelfmark.plans.registry import table
from shelfmark.session import stage

ID, HASH = "doc_id", "text_hash"


def _shared_ids(docs: DataFrame) -> DataFrame:
    """shared_id, times: the ids of several rows, and null."""
    counts = docs.groupBy(F.col(ID).alias("shared_id")).agg(F.count("*").alias("times"))
    return stage(counts.where("times > 1 or shared_id is null"), "shared")


def _chosen(docs: DataFrame, key: Column, text_hash: Column, kept: DataFrame, unique: bool) -> DataFrame:
    """The rows whose key and text hash are in ``kept`` (doc_id, text_hash), one of those that repeat both: the greatest hash of all columns.

    A ``unique`` key says all, so no text is hashed. Otherwise keys and hashes are counted first, without the texts; only
    rows that do repeat are grouped.
    """
    if unique:
        keys = kept.select(F.col(ID).alias("ki")).distinct()
        return docs.join(keys, key.eqNullSafe(F.col("ki")), "left_semi")
    rows = docs.select(F.struct(*docs.columns).alias("row"), key.alias("i"), text_hash.alias("h"))
    counts = rows.groupBy("i", "h").agg(F.count("*").alias("n"))
    keys = kept.select(F.col(ID).alias("ki"), F.col(HASH).alias("kh")).distinct()
    keys = stage(keys.join(counts, (F.col("ki").eqNullSafe(F.col("i"))) & (F.col("kh") == F.col("h"))).select("ki", "kh", "n"), "kept")
    found = rows.join(keys, (F.col("i").eqNullSafe(F.col("ki"))) & (F.col("h") == F.col("kh")))
    if keys.where("n > 1").isEmpty():
        return found.select("row.*")
    again = found.where("n > 1").groupBy("i", "h").agg(F.max_by("row", F.xxhash64("row")).alias("row"))
    return found.where("n = 1").select("row.*").unionByName(again.select("row.*"))


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: documents without a letter, or unlike every language learned, go.

    The model learns from a bounded sample of the stage's documents and their given ``lang``. A document is unlike all
    when its best ridge output lies below the level of the labelled rows (``Model.level``), however many languages there
    are; a short text stays. Null and empty texts go, repeated rows are judged one by one, an empty table gives no rows; without any labelled row
    no language is known and all documents go.
    """
    return language.judged(docs, language.fit(docs, F.col("lang"))).where("known").select("row.*")


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Exact dedup: of texts equal but for the case of A-Z the row with the largest doc_id stays.

    One of rows that repeat id and text stays; a null text is an empty one, a null id smaller than all others; an empty
    table gives no rows.
    """
    kept = exact.exact_duplicates(docs).where("kept").select(ID, F.col("text_sha256").alias(HASH))
    low = F.translate(F.coalesce("text", F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return _chosen(docs, F.col(ID), F.sha2(low, 256), kept, _shared_ids(docs).isEmpty())


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """MinHash near-dedup on shingles of five words: of each component the document with the smallest key stays.

    The key is the doc_id; rows that share one, or have none, are told apart by a hash of id and text in its place. One of
    rows that repeat id and text stays; documents without words are linked with nothing and stay; an empty table gives no rows.
    """
    shared = _shared_ids(docs)
    unique = shared.isEmpty()
    rows = docs.select(F.struct(*docs.columns).alias("row"))
    text, key = F.coalesce("row.text", F.lit("")), F.col(f"row.{ID}")
    if not unique:
        rows = rows.join(shared, key.eqNullSafe(F.col("shared_id")), "left")
        key = F.when(F.col("times").isNull(), key).otherwise(F.xxhash64(key, text))
    kept = near.near_duplicates(rows.select(key.alias(ID), text.alias("text"))).where("kept or n_shingles = 0").select(ID, HASH)
    return _chosen(rows, key, F.xxhash64(text), kept, unique).select("row.*")


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Substring dedup: passages that an earlier document has are cut out; a document with no words left goes.

    Documents that lose nothing keep their text as it is, null too, the others keep their words, joined by one space. Rows of
    one id take nothing from one another; an empty table gives no rows.
    """
    out = substring.cut(docs, substring.duplicate_spans(docs, whole_rows=True))
    return out.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packing: the pieces of sequences of at most 4096 tokens. Null texts are empty, repeated rows are packed one by one, an
    empty table gives no pieces."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", keep_languages),
    ("exact_dedup", drop_exact_copies),
    ("minhash_near_dedup", drop_near_copies),
    ("substring_dedup", drop_repeated_passages),
    ("packing", pack_sequences),
]

#: The language model and the tokenizer can't be written in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
