"""Document fingerprints: homomorphic multiset hashes, sums of wide vectors hashed from paragraphs modulo powers of two.

Column expressions and joins alone; texts never leave the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import id_out, keyed, ranges, settled

#: Exact lanes: sums modulo 2**EXACT_BITS of a seeded 64-bit hash of every paragraph.
EXACT, EXACT_BITS = 8, 56
#: Likeness lanes: longs of two COUNT_BITS-bit counters; a counter counts the pieces whose hash has its bit. A text of
#: Spark has less than 2**31 bytes and a piece takes two with its line break, so that no counter of a text wraps.
PACKS, PER_PACK, COUNT_BITS = 60, 2, 30
#: Consecutive words of a paragraph, from its start, that make up a piece.
PIECE_WORDS = 4

_EXACT_MASK = (1 << EXACT_BITS) - 1
_PACK_MASK = (1 << PER_PACK * COUNT_BITS) - 1
_ONES = sum(1 << (COUNT_BITS * k) for k in range(PER_PACK))


def _summed(items: Column, value, mask: int) -> Column:
    return F.aggregate(items, F.lit(0).cast("long"), lambda total, x: (total + value(x)).bitwiseAND(mask))


def with_vector(df: DataFrame, text: Column, name: str) -> DataFrame:
    """Add the multiset hash of a text: array<long> of EXACT lanes, PACKS packed counters and the number of pieces.

    Paragraphs are the lines; the empty text has one, which is empty. For likeness a paragraph stands for its pieces,
    so that a changed word changes one piece of it. Each entry is a sum over paragraphs, whatever their order.
    """
    paragraphs, pieces = f"_{name}_paragraphs", f"_{name}_pieces"
    pattern = rf"(?:\S++[ \t]*+){{1,{PIECE_WORDS}}}"
    df = df.withColumns({
        paragraphs: F.split(text, "\n"),
        pieces: F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda p: F.xxhash64(F.rtrim(p)))})
    bits = [f"_{name}_bits_{k}" for k in range(PACKS // COUNT_BITS)]
    for k, c in enumerate(bits):
        df = df.withColumn(c, F.transform(pieces, lambda h: F.xxhash64(F.lit(k), h)))

    def exact(i: int) -> Column:
        return _summed(F.col(paragraphs), lambda p: F.xxhash64(F.lit(i), p).bitwiseAND(_EXACT_MASK), _EXACT_MASK)

    def pack(i: int) -> Column:
        again, shift = divmod(i, COUNT_BITS)
        return F.aggregate(f"_{name}_bits_{again}", F.lit(0).cast("long"),
                           lambda total, h: total + F.shiftrightunsigned(h, shift).bitwiseAND(_ONES))

    lanes = [*map(exact, range(EXACT)), *map(pack, range(PACKS)), F.size(pieces).cast("long")]
    return df.withColumn(name, F.array(*lanes)).drop(paragraphs, pieces, *bits)


def _modulo(i: Column) -> Column:
    return F.when(i < EXACT, F.lit(_EXACT_MASK)).otherwise(F.lit(_PACK_MASK))


def plus(a: Column, b: Column) -> Column:
    """The hash of two multisets together, as after the paragraphs of b were inserted into a."""
    return F.transform(F.zip_with(a, b, lambda x, y: x + y), lambda x, i: x.bitwiseAND(_modulo(i)))


def minus(a: Column, b: Column) -> Column:
    """The hash of a without the paragraphs of b, as after their deletion."""
    return F.transform(F.zip_with(a, b, lambda x, y: x - y), lambda x, i: x.bitwiseAND(_modulo(i)))


def as_text(vector: Column) -> Column:
    """Fixed-width hexadecimal form; equal vectors have equal forms."""
    return F.lower(F.array_join(F.transform(vector, lambda x: F.lpad(F.hex(x), 15, "0")), ""))


def _signed(vector: Column) -> Column:
    """One signed number per likeness counter: pieces whose hash has its bit less those without."""
    one = (1 << COUNT_BITS) - 1
    return F.flatten(F.transform(F.slice(vector, EXACT + 1, PACKS), lambda pack: F.array(*[
        (2 * F.shiftrightunsigned(pack, COUNT_BITS * k).bitwiseAND(one) - F.element_at(vector, -1)).cast("double")
        for k in range(PER_PACK)])))


def with_likeness(df: DataFrame, pairs: dict[str, tuple[str, str]]) -> DataFrame:
    """Add for each name the likeness (0 to 1) of two vector columns.

    The signed counters are random projections of the multisets of pieces, so their cosine estimates that of the
    multisets: 1 for equal ones, about 0 without a common piece, with a standard error of about 0.09.
    """
    needed = sorted({c for pair in pairs.values() for c in pair})
    df = df.withColumns({f"_signed_{c}": _signed(F.col(c)) for c in needed})

    def dot(a: str, b: str) -> Column:
        return F.aggregate(F.zip_with(f"_signed_{a}", f"_signed_{b}", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)

    df = df.withColumns({f"_norm_{c}": F.sqrt(dot(c, c)) for c in needed})

    def cosine(a: str, b: str) -> Column:
        norm = F.col(f"_norm_{a}") * F.col(f"_norm_{b}")
        share = F.when(norm > 0, dot(a, b) / norm).otherwise(F.lit(0.0))
        return F.when(F.col(a) == F.col(b), F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), share)))

    df = df.withColumns({name: cosine(a, b) for name, (a, b) in pairs.items()})
    return df.drop(*[f"_{kind}_{c}" for kind in ("signed", "norm") for c in needed])


def _whole(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = keyed(docs, id_col, text_col).withColumn("text", F.coalesce("text", F.lit("")))
    return rows.withColumn("h", F.xxhash64("text"))


def followed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", partitions: int | None = None) -> DataFrame:
    """doc_id, h, before_id, before_h, before_chars: the document in front of each, by id; that of the first is the last.

    Only ids, hashes and lengths are sorted, in ranges that are written once; a range learns the end of the one before from
    a table with one row per range.
    """
    order = ["doc_id", "h"]
    n = partitions or ranges(docs.sparkSession, docs.count())
    ids = _whole(docs, id_col, text_col).select(*order, F.char_length("text").alias("chars")).distinct()
    ranged = settled(ids.repartitionByRange(n, *order).withColumn("range", F.spark_partition_id()))
    me = F.struct(*order, "chars")
    ends = ranged.groupBy("range").agg(F.max(me).alias("end"))
    whole = Window.orderBy("range")     # one row per range
    ends = ends.select("range", F.coalesce(F.lag("end").over(whole), F.last("end").over(
        whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("end"))
    inside = F.lag(me).over(Window.partitionBy("range").orderBy(*order))
    out = ranged.withColumn("before", inside).join(F.broadcast(ends), "range")
    out = out.withColumn("before", F.coalesce("before", "end"))
    return out.select(*order, F.col("before.doc_id").alias("before_id"), F.col("before.h").alias("before_h"),
                      F.col("before.chars").alias("before_chars"))


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every document.

    The edited text has its last floor(n_chars / 2) code points replaced by the first as many (or all) of the next
    document in ascending order of ids; after the last comes the first. Null texts are empty; a null id comes before all
    others; documents of one id follow one another by text hash; rows that repeat both id and text come out once.
    Other columns are not read; an empty table gives no rows.

    Texts are shuffled once, by id; a document sends to the one in front of it only what that one takes over and its own
    vector.
    """
    rows = _whole(docs, id_col, text_col).groupBy("doc_id", "h").agg(F.first("text").alias("text"))
    after = with_vector(rows.join(followed(docs, id_col, text_col), ["doc_id", "h"]), F.col("text"), "next_vector")
    after = after.select(F.col("before_id").alias("doc_id"), F.col("before_h").alias("h"), "next_vector",
                         F.left("text", F.floor(F.col("before_chars") / 2).cast("int")).alias("taken"))
    out = rows.join(after, ["doc_id", "h"]).withColumn("n_chars", F.char_length("text"))
    out = out.withColumn("edited", F.concat(F.left("text", F.ceil(F.col("n_chars") / 2).cast("int")), "taken"))
    out = with_vector(with_vector(out, F.col("text"), "vector"), F.col("edited"), "edited_vector")
    out = with_likeness(out.withColumn("edited_sha256", F.sha2("edited", 256)).drop("text", "taken", "edited"),
                        {"near_edited": ("vector", "edited_vector"), "near_next": ("vector", "next_vector")})
    return out.select(id_out(), F.col("n_chars").cast("long").alias("n_chars"), "edited_sha256",
                      as_text(F.col("vector")).alias("fingerprint"),
                      as_text(F.col("edited_vector")).alias("edited_fingerprint"), "near_edited", "near_next")
