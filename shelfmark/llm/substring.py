"""Repeated passages: a relative Lempel-Ziv parse of every document against an index of the corpus's phrases."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import WordHashes, grams, id_out, key_columns, keyed, raw, word_blocks

#: Words of an anchor, the unit by which a phrase is routed to its block of the index.
ANCHOR_WORDS = 7
#: Bits of a text's hash that tell rows of one id apart.
ROW_MASK = 0x7FFFFFFF


def _sliding(x: np.ndarray, n: int, op) -> np.ndarray:
    """op over every n consecutive values, by doubling."""
    have, out = 1, x
    while have * 2 <= n:
        out = op(out[:-have], out[have:])
        have *= 2
    return op(out[:len(x) - n + 1], out[n - have:]) if have < n else out


def _lowest(words: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """The anchor hashes of a document, and for each window of words the lowest anchor hash inside."""
    anchors = grams(words, ANCHOR_WORDS)
    return anchors, _sliding(anchors, window - ANCHOR_WORDS + 1, np.minimum)


#: Rows of what a task sends on: one of a key that others must be asked for, one that speaks for several documents of
#: its block, one that is settled already and only passes through.
ASK, MANY, SETTLED = 0, 1, 2


def _anchors(window: int):
    """(h, doc_id, kind): the lowest anchor of every window. Equal windows have equal lowest anchors.

    An anchor that several documents of a block have is shared whatever the others hold: its rows are settled, and one
    row tells the others. So however many documents have an anchor, each block asks with one row.
    """
    def run(batches):
        for ids, lengths, words in word_blocks(batches):
            ends = np.cumsum(lengths)
            found = [np.unique(_lowest(words[e - n:e], window)[1]) if n >= window else words[:0] for n, e in zip(lengths, ends)]
            h = np.concatenate(found).view(np.int64)
            docs = np.repeat(ids, [len(f) for f in found])
            order = np.argsort(h, kind="stable")
            h, docs = h[order], docs[order]
            first = np.r_[True, h[1:] != h[:-1]][:len(h)]
            several = np.diff(np.r_[np.flatnonzero(first), len(h)]) > 1
            kind = np.where(np.repeat(several, np.diff(np.r_[np.flatnonzero(first), len(h)])), SETTLED, ASK)
            tell = np.flatnonzero(first)[several]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.r_[h, h[tell]]), pa.array(np.r_[docs, docs[tell]]),
                 pa.array(np.r_[kind, np.full(len(tell), MANY)].astype(np.int32))], ["h", "doc_id", "kind"])
    return run


def _shared(batches):
    """(doc_id, h) of the anchors that several documents have, from rows sorted by anchor, settled ones last."""
    known, waiting = None, None         # the anchor of the last row if it is shared; the last row if that is open
    for batch in batches:
        h, docs, kind = (batch.column(i).to_numpy() for i in range(3))
        done = kind == SETTLED
        out = [(docs[done], h[done])]
        h, docs, kind = h[~done], docs[~done], kind[~done]
        if waiting is not None:
            h, docs, kind = (np.r_[x, y] for x, y in zip(waiting, (h, docs, kind)))
            waiting = None
        if len(h):
            starts = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
            sizes = np.diff(np.r_[starts, len(h)])
            shared = (sizes > 1) | (np.maximum.reduceat(kind, starts) == MANY)
            shared[0] |= known is not None and known == h[0]
            if not shared[-1]:
                waiting = (h[-1], docs[-1], kind[-1])
            known = h[-1] if shared[-1] else None
            good = np.repeat(shared, sizes) & (kind == ASK)
            out.append((docs[good], h[good]))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], ["doc_id", "h"])


def _phrases(window: int):
    """(phrase, doc_id, at, source): the windows of a document whose lowest anchor is shared; at holds row and position.

    Of a phrase's documents in a block the first one asks the others; the rest have it as their source.
    """
    def flush(held):
        phrase, docs, at = (np.concatenate(c) for c in zip(*held))
        order = np.lexsort((docs, phrase))
        phrase, docs, at = phrase[order], docs[order], at[order]
        starts = np.flatnonzero(np.r_[True, phrase[1:] != phrase[:-1]][:len(phrase)])
        first = np.repeat(docs[starts], np.diff(np.r_[starts, len(phrase)]))
        return pa.RecordBatch.from_arrays([pa.array(phrase), pa.array(docs), pa.array(at), pa.array(first, mask=docs == first)],
                                          ["phrase", "doc_id", "at", "source"])

    def run(batches):
        memo, held, n = WordHashes(), [], 0
        for batch in batches:
            columns = [batch.column(i) for i in range(4)]
            for doc_id, row, text, shared in zip(columns[0].to_pylist(), columns[1].to_pylist(), columns[2], columns[3]):
                found = (text.as_py() or "").encode().split()
                if len(found) < window:
                    continue
                words = np.fromiter(map(memo.__getitem__, found), np.uint64, len(found))
                at = np.flatnonzero(np.isin(_lowest(words, window)[1].view(np.int64), shared.values.to_numpy()))
                held.append((grams(words, window)[at].view(np.int64), np.full(len(at), doc_id), at + (row << 32)))
                n += len(at)
                if n >= 1 << 18:
                    yield flush(held)
                    held, n = [], 0
        if held:
            yield flush(held)
    return run


def _hits(batches):
    """(doc_id, at, source) of the phrases that an earlier document has, from rows sorted by phrase and document."""
    phrase, first = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        done = batch.column(3).is_valid()
        settled, asking = batch.filter(done), batch.filter(pc.invert(done))
        keys, docs = asking.column(0).to_numpy(), asking.column(1).to_numpy()
        if len(keys):
            starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
            firsts = docs[starts].copy()
            if phrase is not None and phrase == keys[0]:
                firsts[0] = first
            phrase, first = keys[-1], firsts[-1]
            source = np.repeat(firsts, np.diff(np.r_[starts, len(keys)]))
            late = pa.array(docs > source)
            yield pa.RecordBatch.from_arrays([asking.column(1).filter(late), asking.column(2).filter(late),
                                              pa.array(source).filter(late)], ["doc_id", "at", "source"])
        yield settled.select(["doc_id", "at", "source"])


def parse(at: np.ndarray, source: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Greedy factors (start, length, source): runs of neighbouring phrase starts with the same source.

    A phrase that lies across the boundary of two factors has a start of its own, with whatever source it has, so
    it is a factor too; factors may overlap and together cover every repeated phrase.
    """
    order = np.argsort(at, kind="stable")
    at, source = at[order], source[order]
    first = np.flatnonzero(np.r_[True, (at[1:] != at[:-1] + 1) | (source[1:] != source[:-1])])
    last = np.r_[first[1:], len(at)] - 1
    return at[first], at[last] - at[first] + window, source[first]


def _factors(window: int):
    def run(batches):
        for batch in batches:
            out = [[], [], [], []]
            for at, source in zip(batch.column(1), batch.column(2)):
                start, length, origin = parse(at.values.to_numpy(), source.values.to_numpy(), window)
                for column, value in zip(out, (start >> 32, start & 0xFFFFFFFF, length, origin)):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.list_(pa.int64())) for c in out)],
                                             ["doc_id", "rows", "starts", "lengths", "sources"])
    return run


def _rows(docs, id_col, text_col, whole_rows):
    """With ``row``, which tells rows of one id apart, and the other columns as ``rest`` where they are wanted."""
    rest = [F.struct(*[c for c in docs.columns if c != text_col]).alias("rest")] if whole_rows else []
    return docs.select(*key_columns(id_col, text_col), *rest).withColumn("row", F.xxhash64("text").bitwiseAND(ROW_MASK))


def duplicate_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, window: int = 13,
                    whole_rows: bool = False) -> DataFrame:
    """doc_id, rows, starts, lengths, sources: the factors of every document that repeats earlier ones, in words.

    Words are runs without ASCII blanks, unchanged. A factor of at least ``window`` words also stands in a document
    with a smaller id (``sources``: one that holds its phrases); what repeats inside one document alone, or
    in rows of the same id, is no factor (``rows`` tells which row of the id a factor lies in). Null and short texts
    have none. Null ids count as NULL_ID, before all others.

    The longest factor is a whole document, so a text that an earlier document equals becomes one at once. For the
    others the index is a table of phrases (``window`` consecutive words) and the ids that hold them, in blocks by
    hash; a block of documents enters a phrase once, for the first of them that has it. Only phrases whose anchor - the lowest hash among the short word runs inside - occurs in several
    documents enter it. The texts are shuffled by id once: all joins with them, those of ``without_spans`` and (with
    ``whole_rows``) of ``cut`` too, are on the id alone and share that exchange.
    """
    if window < ANCHOR_WORDS:
        raise ValueError(f"window must be at least {ANCHOR_WORDS}")
    rows = _rows(docs, id_col, text_col, whole_rows)
    twins = keyed(docs, id_col, text_col).where("text is not null").select(
        "doc_id", F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(1), "text").alias("t2"))
    firsts = twins.groupBy("t1", "t2").agg(F.min("doc_id").alias("source"))
    copies = (twins.join(firsts, ["t1", "t2"]).where("doc_id > source").groupBy("doc_id")
              .agg(F.collect_set(F.struct(F.col("t1").bitwiseAND(ROW_MASK).alias("row"), "source")).alias("copies")))
    mine = F.filter("copies", lambda c: c.row == F.col("row"))
    originals = rows.join(copies.withColumnRenamed("doc_id", "copy_id"),
                          (F.col("doc_id") == F.col("copy_id")) & (F.size(mine) > 0), "left_anti")
    n_words = F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+"))
    whole = (rows.join(copies, "doc_id").withColumn("source", F.get(mine, 0).source)
             # counted for copies alone, above the exchange
             .withColumn("n", F.when(F.col("source").isNotNull(), n_words.cast("long"))).where(f"n >= {window}")
             .groupBy("doc_id").agg(*[F.collect_list(c).alias(c) for c in ("row", "n", "source")]).select(
                 "doc_id", F.col("row").alias("rows"), F.transform("row", lambda r: F.lit(0).cast("long")).alias("starts"),
                 F.col("n").alias("lengths"), F.col("source").alias("sources")))

    settled = F.col("kind") == SETTLED
    anchors = originals.select("doc_id", "text").mapInArrow(_anchors(window), "h long, doc_id long, kind int")
    routed = (anchors.repartition(F.when(settled, F.xxhash64("doc_id", "h")).otherwise(F.col("h")))
              .sortWithinPartitions(settled, "h").mapInArrow(_shared, "doc_id long, h long")
              .groupBy("doc_id").agg(F.collect_list("h").alias("shared")))
    phrases = (originals.join(routed, "doc_id").select("doc_id", "row", "text", "shared", *["rest"] * whole_rows)
               .mapInArrow(_phrases(window), "phrase long, doc_id long, at long, source long"))
    hits = (phrases.repartition(F.when(F.col("source").isNull(), F.col("phrase")).otherwise(F.xxhash64("doc_id", "at")))
            .sortWithinPartitions("phrase", "doc_id").mapInArrow(_hits, "doc_id long, at long, source long"))
    factors = (hits.groupBy("doc_id").agg(F.collect_list("at").alias("at"), F.collect_list("source").alias("source"))
               .mapInArrow(_factors(window), "doc_id long, rows array<long>, starts array<long>, lengths array<long>, "
                           "sources array<long>"))
    return factors.unionByName(whole).groupBy("doc_id").agg(
        *[F.flatten(F.collect_list(c)).alias(c) for c in ("rows", "starts", "lengths", "sources")])


def _kept_words(text: bytes, row: int, rows, starts, lengths) -> tuple[int, int, bytes]:
    """(words, words removed, the others joined by one space)"""
    words = text.split()
    n = len(words)
    if starts.is_valid:
        own = rows.values.to_numpy() == row
        edge = np.zeros(n + 1, np.int64)
        a = starts.values.to_numpy()[own]
        np.add.at(edge, a, 1)
        np.add.at(edge, a + lengths.values.to_numpy()[own], -1)
        words = [w for w, covered in zip(words, np.cumsum(edge)) if not covered]
    return n, n - len(words), b" ".join(words)


def _without_spans(batches):
    for batch in batches:
        rows = [_kept_words(text, row.as_py(), *spans) for text, row, *spans in
                zip(raw(batch.column(1)), *(batch.column(i) for i in range(2, 6)))]
        words, removed, kept = zip(*rows) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(words, pa.int64()), pa.array(removed, pa.int64()),
             pa.array(kept, pa.binary()).cast(pa.string()), *batch.columns[6:]],
            ["doc_id", "n_words", "n_removed", "kept_text", "given", "rest"][:batch.num_columns - 2])


def _applied(docs, spans, id_col, text_col, whole_rows):
    joined = _rows(docs, id_col, text_col, whole_rows).join(spans, "doc_id", "left")    # on the id alone: one exchange
    columns, schema = ["doc_id", "text", "row", "rows", "starts", "lengths"], "doc_id long, n_words long, n_removed long, kept_text string"
    if whole_rows:
        columns += [F.col("text").alias("given"), "rest"]
        schema += f", given string, rest {joined.schema['rest'].dataType.simpleString()}"
    return joined.select(*columns).mapInArrow(_without_spans, schema)


def without_spans(docs: DataFrame, spans: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, kept_text of every document: words outside the spans, joined by one space."""
    return _applied(docs, spans, id_col, text_col, False).withColumn("doc_id", id_out())


def cut(docs: DataFrame, spans: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The columns of ``docs``, the spans cut out of the texts; rows that lose all their words go.

    A text that loses nothing stays as it is, also null or blank; of the others the kept words are joined by one space.
    """
    out = _applied(docs, spans, id_col, text_col, True)
    out = out.where("n_removed = 0 or n_removed < n_words")
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("given"))
    return out.select(*[text.alias(c) if c == text_col else F.col("rest")[c].alias(c) for c in docs.columns])
