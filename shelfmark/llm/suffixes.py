"""Repeated byte strings by prefix-free parsing: phrases between rolling-hash triggers, suffix arrays over their dictionary.

A text is parsed into phrases where the trigger changes. The trigger of a window of bytes is the least rolling hash inside,
so it depends on the window alone; a phrase is the bytes of consecutive windows with one trigger, and neighbouring phrases
overlap by all but one byte of a window. So every window lies in exactly one phrase, equal windows lie in phrases of equal
triggers, and no phrase is longer than 2 * window - GRAM bytes, whatever the text. The dictionary holds each phrase once and
the parse its places; a suffix array of the dictionary, to the depth of a window, and the order of the places in the parse
give the corpus order in which a window stands directly behind its first occurrence.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import NULL_ID, id_out, key_columns, mixed, raw

#: Bytes of the rolling hash.
GRAM = 32
#: Bytes of text hashed at once; a longer text is parsed in portions that overlap by a window.
PORTION = 1 << 20
#: Bytes of text in a block, within which equal phrases are settled before any of them travels.
BLOCK_BYTES = 4 << 20
#: Occurrences from which the windows of a trigger travel one by one, each by its own hash, rather than together.
HOT = 4096
#: Phrases for which one suffix array is built.
DICTIONARY = 1 << 13
#: Bits of a text's hash that tell rows of one id apart; rows without an id have all 64.
ROW_MASK = 0x7FFFFFFF

_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_PLACE = np.uint64((1 << 24) - 1)


def _joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mixed(a * _FACTOR + b)


def _rolling(text: bytes) -> np.ndarray:
    """Hash of the GRAM bytes from each position on."""
    eight = np.ndarray((len(text) - 7,), "<u8", text, 0, (1,)).astype(np.uint64)
    h = mixed(eight)
    for n in (8, 16):
        h = _joined(h[:-n], h[n:])
    return h


def _least(x: np.ndarray, n: int) -> np.ndarray:
    """The least of every n consecutive values, by doubling."""
    have, out = 1, x
    while have * 2 <= n:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    return np.minimum(out[:len(x) - n + 1], out[n - have:]) if have < n else out


def phrases(text: bytes, window: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Portions of the parse: starts of phrases, their numbers of windows, trigger hashes, and the rolling hashes from the
    portion's first byte on (for ``window_hashes``; its place in the text is the first start)."""
    for base in range(0, len(text) - window + 1, PORTION):
        part = text[base:base + PORTION + window - 1]
        h = _rolling(part)
        # the place breaks ties, so the first of equal hashes is the trigger
        least = _least(h & ~_PLACE | np.arange(len(h), dtype=np.uint64), window - GRAM + 1)
        first = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
        trigger = h[(least[first] & _PLACE).astype(np.int64)]
        yield base + first, np.diff(np.r_[first, len(least)]), trigger, h


def window_hashes(h: np.ndarray, at: np.ndarray, window: int, seed: int = 0) -> np.ndarray:
    """Hash of the windows that start ``at``, from those of the grams inside."""
    out = h[at] ^ np.uint64(seed)
    for k in [*range(GRAM, window - GRAM, GRAM), window - GRAM]:
        out = _joined(out, h[at + k])
    return out


def _texts(batches: Iterable[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Blocks of (doc_id, row or slot, text as bytes, further columns as they are) from batches of those columns."""
    block, held = [], 0
    for batch in batches:
        for doc_id, row, text, *more in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                            batch.column(2).cast(pa.large_binary()), *batch.columns[3:]):
            text = text.as_py() or b""
            block.append((doc_id, row, text, *more))
            held += len(text)
            if held >= BLOCK_BYTES:
                yield block
                block, held = [], 0
    if block:
        yield block


#: Rows about triggers: one that asks whether others have it, one that speaks for a block where it comes often enough,
#: one that is known to be hot already and only passes through.
ASK, TELL, DONE = 0, 1, 2


def _triggers(window: int, often: int):
    """(h, doc_id, slot, kind, n): the triggers of each document, n times in it."""
    def run(batches):
        for block in _texts(batches):
            docs, found, times = [], [], []
            for number, (_, _, text) in enumerate(block):
                parts = [t for _, _, t, _ in phrases(text, window)]
                if parts:
                    h, n = np.unique(np.concatenate(parts), return_counts=True)
                    found.append(h)
                    times.append(n)
                    docs.append(np.full(len(h), number))
            if not found:
                continue
            ids, rows = (np.array([r[k] for r in block], np.int64) for k in (0, 1))
            h, docs, times = np.concatenate(found), np.concatenate(docs), np.concatenate(times)
            keys, inverse = np.unique(h, return_inverse=True)
            total = np.bincount(inverse, times, len(keys)).astype(np.int64)
            hot = total >= often
            tell, none = keys[hot], np.zeros(hot.sum(), np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.r_[h, tell].view(np.int64)), pa.array(np.r_[ids[docs], none]), pa.array(np.r_[rows[docs], none]),
                 pa.array(np.r_[np.where(hot[inverse], DONE, ASK), none + TELL].astype(np.int32)),
                 pa.array(np.r_[np.where(hot[inverse], 0, times), total[hot]].astype(np.int32))], ["h", "doc_id", "slot", "kind", "n"])
    return run


def _shared(often: int):
    """(doc_id, slot, h, hot) of the triggers that come more than once, from rows sorted by trigger, those DONE last.

    A trigger's rows are held back until they make it hot, so fewer than ``often`` are held.
    """
    names = ["doc_id", "slot", "h", "hot"]

    def batch_of(found):
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.bool_())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found) if found else [()] * 4, kinds)], names)

    def run(batches):
        key, waiting, total = None, [], 0

        def flush():
            return [(d, r, key, False) for d, r in waiting] if 1 < total < often else []

        for batch in batches:
            h, docs, rows, kind, n = (batch.column(i).to_numpy() for i in range(5))
            done = kind == DONE
            yield pa.RecordBatch.from_arrays([pa.array(docs[done]), pa.array(rows[done]), pa.array(h[done]), pa.array(np.ones(done.sum(), bool))],
                                             names)
            h, docs, rows, kind, n = (c[~done] for c in (h, docs, rows, kind, n))
            if not len(h):
                continue
            # triggers of a single row, not at the edges of the batch, need no look
            single = np.r_[True, h[1:] != h[:-1]] & np.r_[h[1:] != h[:-1], True] & (n == 1)
            single[0] = single[-1] = False
            out = []
            for x, d, r, k, m in zip(*(c[~single].tolist() for c in (h, docs, rows, kind, n))):
                if x != key:
                    out += flush()
                    key, waiting, total = x, [], 0
                total += m
                if k == ASK:
                    waiting.append((d, r))
                if total >= often:
                    out += [(*w, key, True) for w in waiting]
                    waiting = []
            yield batch_of(out)
        yield batch_of(flush())
    return run


PARSE = "key long, print long, doc_id long, row long, at long, n int, hot boolean"


def _spread(docs: np.ndarray, rows: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A key for rows that meet no others."""
    return mixed(docs.view(np.uint64) ^ mixed(rows.view(np.uint64) + at.view(np.uint64))).view(np.int64)


def _runs(starts: np.ndarray, n: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of the phrases that begin a run of adjoining ones of a text, and the windows of each run."""
    head = np.flatnonzero(np.r_[True, (texts[1:] != texts[:-1]) | (starts[1:] != starts[:-1] + n[:-1])])
    return head, np.add.reduceat(n, head)


def _parse(window: int):
    """The phrases of shared triggers with their hashes (``print``), n windows from ``at`` on, of documents sorted by id and row.

    Phrases meet by trigger, those of hot triggers by their own hash. Of a block's equal phrases the first one travels; the
    others are settled, all their windows repeat, and they travel as runs without a hash.
    """
    names = [c.split()[0] for c in PARSE.split(", ")]

    def run(batches):
        before = None
        for block in _texts(batches):
            at, sizes, triggers, prints, texts, hots = [], [], [], [], [], []
            for number, (doc_id, row, text, shared, hot) in enumerate(block):
                if (doc_id, row) == before:         # repeats both id and text
                    continue
                before = doc_id, row
                shared, hot = (np.sort(x.values.to_numpy().view(np.uint64)) for x in (shared, hot))
                for start, n, trigger, h in phrases(text, window):
                    warm = np.isin(trigger, hot) if len(hot) else np.zeros(len(trigger), bool)
                    pick = np.isin(trigger, shared) | warm
                    s, m, own = start[pick], n[pick], trigger[pick]
                    first, last = (window_hashes(h, x - start[0], window) for x in (s, s + m - 1))
                    at.append(s)
                    sizes.append(m)
                    triggers.append(own)
                    hots.append(warm[pick])
                    prints.append(_joined(_joined(first, last), m.astype(np.uint64) ^ own))
                    texts.append(np.full(len(s), number))
            if not at:
                continue
            at, sizes, triggers, prints, texts, hots = map(np.concatenate, (at, sizes, triggers, prints, texts, hots))
            ids, rows = (np.array([r[k] for r in block], np.int64) for k in (0, 1))
            lead = np.zeros(len(prints), bool)
            lead[np.unique(prints, return_index=True)[1]] = True
            t, key = texts[lead], np.where(hots, prints, triggers)[lead]
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.view(np.int64)), pa.array(prints[lead].view(np.int64)), pa.array(ids[t]), pa.array(rows[t]),
                 pa.array(at[lead]), pa.array(sizes[lead].astype(np.int32)), pa.array(hots[lead])], names)
            if not lead.all():
                t, a = texts[~lead], at[~lead]
                head, total = _runs(a, sizes[~lead], t)
                t, a = t[head], a[head]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_spread(ids[t], rows[t], a)), pa.nulls(len(a), pa.int64()), pa.array(ids[t]), pa.array(rows[t]),
                     pa.array(a), pa.array(total.astype(np.int32)), pa.array(np.zeros(len(a), bool))], names)
    return run


#: What a phrase comes to: all its windows repeat, or it is an entry to compare with the other entries of its trigger, or an
#: entry of a hot trigger, to compare window by window.
REPEATS, ENTRY, HOT_ENTRY = 0, 1, 2
MARKED = "doc_id long, row long, at long, n int, kind int, trigger long"


def _dictionary(batches):
    """The dictionary, from phrases sorted by (key, print, doc_id, row, at): of equal ones the first is an entry, all others repeat.

    An entry that is the only one of its trigger has no window in common with another and drops out. One row is carried from
    batch to batch: the entry of a trigger whose second may follow.
    """
    names = [c.split()[0] for c in MARKED.split(", ")]
    last = None                 # (key, print) of the last phrase
    open_trigger, waiting = None, None      # the last trigger, and its entry while that is the only one

    def marked(batch, kind):
        return pa.RecordBatch.from_arrays([*batch.columns[2:6], pa.array(np.full(batch.num_rows, kind, np.int32)), batch.column(0)], names)

    for batch in batches:
        settled = batch.filter(batch.column(1).is_null())
        if settled.num_rows:
            yield marked(settled, REPEATS)
        batch = batch.filter(batch.column(1).is_valid())
        if not batch.num_rows:
            continue
        keys, prints = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        first = np.r_[(keys[0], prints[0]) != last, (keys[1:] != keys[:-1]) | (prints[1:] != prints[:-1])]
        last = keys[-1], prints[-1]
        yield marked(batch.filter(pa.array(~first)), REPEATS)
        hot = batch.column(6).to_numpy(zero_copy_only=False)
        yield marked(batch.filter(pa.array(first & hot)), HOT_ENTRY)
        entries = batch.filter(pa.array(first & ~hot))
        if not entries.num_rows:
            continue
        if waiting is not None:
            entries = pa.Table.from_batches([waiting, entries]).combine_chunks().to_batches()[0]
        triggers = entries.column(0).to_numpy()
        starts = np.flatnonzero(np.r_[True, triggers[1:] != triggers[:-1]])
        sizes = np.diff(np.r_[starts, len(triggers)])
        several = np.repeat((sizes > 1) | ((triggers[starts] == open_trigger) & (waiting is None)), sizes)
        waiting = None if several[-1] else entries.slice(len(triggers) - 1)
        open_trigger = triggers[-1]
        yield marked(entries.filter(pa.array(several)), ENTRY)


ENTRIES = "key long, doc_id long, row long, at long, n int, phrase binary"


def _entries(window: int):
    """The bytes of entries, by trigger; of hot ones the windows instead, each by its hash and with eight bytes of a second
    one; and runs of windows that repeat, without a phrase. Documents are sorted by id and row."""
    names = [c.split()[0] for c in ENTRIES.split(", ")]

    def run(batches):
        before, out = None, [[] for _ in range(6)]

        def flush():
            columns = [np.concatenate(c) if c else np.empty(0, np.int64) for c in out[:5]]
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32())
            batch = pa.RecordBatch.from_arrays([*(pa.array(c, k) for c, k in zip(columns, kinds)), pa.array(out[5], pa.binary())], names)
            for c in out:
                c.clear()
            return batch

        def add(key, doc_id, row, at, n, phrases_):
            for c, x in zip(out, (key, np.full(len(at), doc_id), np.full(len(at), row), at, n)):
                c.append(x)
            out[5].extend(phrases_)

        for batch in batches:
            for doc_id, row, text, *marks in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                                 batch.column(2).cast(pa.large_binary()), *batch.columns[3:]):
                if (doc_id, row) == before:
                    continue
                before = doc_id, row
                rows, at, n, kind, trigger = (m.values.to_numpy() for m in marks)
                order = np.argsort(at, kind="stable")
                order = order[rows[order] == row]
                at, n, kind, trigger = at[order], n[order], kind[order], trigger[order]
                data = text.as_py()
                cut = kind == ENTRY
                add(trigger[cut], doc_id, row, at[cut], n[cut], [data[a:a + k + window - 1] for a, k in zip(at[cut].tolist(), n[cut].tolist())])
                for a, k in zip(at[kind == HOT_ENTRY].tolist(), n[kind == HOT_ENTRY].tolist()):
                    h, inside = _rolling(data[a:a + k + window - 1]), np.arange(k)
                    second = window_hashes(h, inside, window, 1).tobytes()
                    add(window_hashes(h, inside, window).view(np.int64), doc_id, row, a + inside, np.ones(k, np.int32),
                        [second[8 * i:8 * i + 8] for i in range(k)])
                again = kind == REPEATS
                if again.any():
                    head, total = _runs(at[again], n[again], np.zeros(again.sum(), np.int8))
                    a = at[again][head]
                    spread = _spread(np.full(len(a), doc_id, np.int64), np.full(len(a), row, np.int64), a)
                    add(spread, doc_id, row, a, total.astype(np.int32), [None] * len(a))
                if len(out[5]) >= 20_000:
                    yield flush()
        yield flush()
    return run


def suffix_array(dictionary: np.ndarray, starts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes that begin at ``starts`` of the joined dictionary, to the depth of a window, equal ones as given;
    and in that order whether a suffix differs from the one before."""
    rows = np.lib.stride_tricks.sliding_window_view(dictionary, window)[starts]
    whole = rows.view(f"S{window}").ravel()     # compared byte by byte: all have the same length
    order = np.argsort(whole, kind="stable")
    inner = whole[order]
    return order, np.r_[True, inner[1:] != inner[:-1]][:len(order)]


def repeats(keys: np.ndarray, n: np.ndarray, content: pa.BinaryArray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(phrase, first window, windows): the runs of windows that stand earlier too, of phrases of n windows sorted by key and place."""
    heads = np.r_[True, keys[1:] != keys[:-1]]
    pick = np.flatnonzero(~(heads & np.r_[heads[1:], True]))        # the others have nothing to compare with
    if not len(pick):
        return (pick,) * 3
    n, content = n[pick], content.take(pa.array(pick))
    offsets = np.frombuffer(content.buffers()[1], np.int32)[content.offset:content.offset + len(content)].astype(np.int64)
    # windows of all phrases, in the order of the parse: equal ones keep that order in the suffix array, and equal
    # windows have one key, so that the first of them is the first in the corpus
    phrase = np.repeat(np.arange(len(n)), n)
    inside = np.arange(len(phrase)) - np.repeat(np.cumsum(n) - n, n)
    order, differs = suffix_array(np.frombuffer(content.buffers()[2], np.uint8), offsets[phrase] + inside, window)
    hit = np.sort(order[~differs])
    if not len(hit):
        return (hit,) * 3
    first = np.flatnonzero(np.r_[True, (hit[1:] != hit[:-1] + 1) | (phrase[hit[1:]] != phrase[hit[:-1]])])
    return pick[phrase[hit[first]]], inside[hit[first]], np.diff(np.r_[first, len(hit)])


RUNS = "doc_id long, row long, at long, n long"


def _corpus_order(window: int, dictionary: int):
    """Runs of repeated windows from dictionary entries sorted by (key, doc_id, row, at); those without a phrase are settled.

    Fewer than ``often`` entries have one trigger, so a suffix array takes little more than ``dictionary`` phrases.
    """
    names = [c.split()[0] for c in RUNS.split(", ")]

    def solved(table: pa.Table) -> pa.RecordBatch:
        keys, docs, rows, at, n = (table.column(i).to_numpy() for i in range(5))
        phrase, skip, size = repeats(keys, n, table.column(5).combine_chunks(), window)
        found = [docs[phrase], rows[phrase], at[phrase] + skip, size.astype(np.int64)]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found], names)

    def run(batches):
        held, count, last = [], 0, None
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(5)), 0).to_numpy()
            for kind, pick in ((0, sizes == 0), (8, sizes == 8)):
                own = batch.filter(pa.array(pick))
                if kind and own.num_rows:           # windows of hot triggers: those that have an equal one before them
                    hashes = list(zip(own.column(0).to_pylist(), own.column(5).to_pylist()))
                    again = [x == y for x, y in zip(hashes, [last, *hashes])]
                    last = hashes[-1]
                    own = own.filter(pa.array(again))
                if own.num_rows:
                    yield pa.RecordBatch.from_arrays([*own.columns[1:4], own.column(4).cast(pa.int64())], names)
            batch = batch.filter(pa.array(sizes >= window))
            if not batch.num_rows:
                continue
            held.append(batch)
            count += batch.num_rows
            if count >= dictionary:
                table = pa.Table.from_batches(held)
                edge = int(np.argmax(table.column(0).to_numpy() == batch.column(0)[-1].as_py()))    # the last key may go on
                if edge:
                    yield solved(table.slice(0, edge))
                held, count = table.slice(edge).combine_chunks().to_batches(), len(table) - edge
        if held:
            yield solved(pa.Table.from_batches(held))
    return run


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, slot, row, text: row tells texts of one id apart, slot spreads the rows without an id and is 0 for others."""
    h, null = F.xxhash64("text"), F.col("doc_id") == NULL_ID
    return docs.select(*key_columns(id_col, text_col)).select(
        "doc_id", F.when(null, h).otherwise(0).alias("slot"), F.when(null, h).otherwise(h.bitwiseAND(ROW_MASK)).alias("row"), "text")


#: By these documents and what is known of them are joined.
KEYS = ["doc_id", "slot"]
#: A document, and its order in the corpus.
DOCUMENT = ["doc_id", "row"]


def _by_document(rows: DataFrame, columns: list[str]) -> DataFrame:
    """One row per KEYS with the columns as lists, from rows with doc_id and row."""
    slot = F.when(F.col("doc_id") == NULL_ID, F.col("row")).otherwise(0).alias("slot")
    return rows.groupBy("doc_id", slot).agg(*[F.collect_list(c).alias(f"{c}s") for c in columns])


def repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, window: int = 100,
                  often: int = HOT, dictionary: int = DICTIONARY) -> DataFrame:
    """doc_id, row, at, n: runs of n window starts whose ``window`` bytes of UTF-8 also start earlier in the corpus.

    Earlier is a smaller id (null ids first, as NULL_ID) or, in the same document, an earlier start; texts of one id come one
    after the other by hash (``row``), rows that repeat id and text are one document. Windows never cross documents; null
    and short texts have none. An empty table gives no rows, other columns are not read.

    First the triggers alone are shuffled, and only phrases of a trigger that comes more than once go on. Equal phrases are
    settled in their block of documents, then across blocks by their hash: the first is the dictionary's, of all others
    every window repeats. Entries of the dictionary meet by trigger, where suffix arrays compare them byte by byte; of a
    trigger that comes ``often`` their windows meet one by one, by hash, so that no task gets a trigger's many phrases.
    Phrases and these windows are equal by 64 and 128 bits of hash. Texts are shuffled by id once, for this and for
    ``without_runs``.
    """
    if window < 2 * GRAM:
        raise ValueError(f"window must be at least {2 * GRAM}")
    rows = _rows(docs, id_col, text_col)
    done, hot = F.col("kind") == DONE, F.col("hot")
    triggers = rows.select(*KEYS, "text").mapInArrow(_triggers(window, often), "h long, doc_id long, slot long, kind int, n int")
    shared = (triggers.repartition(F.when(done, F.xxhash64(*KEYS, "h")).otherwise(F.col("h"))).sortWithinPartitions(done, "h")
              .mapInArrow(_shared(often), "doc_id long, slot long, h long, hot boolean").groupBy(*KEYS)
              .agg(F.collect_set(F.when(~hot, F.col("h"))).alias("shared"), F.collect_set(F.when(hot, F.col("h"))).alias("hot")))
    found = (rows.join(shared, KEYS).select(*DOCUMENT, "text", "shared", "hot")
             .sortWithinPartitions(*DOCUMENT).mapInArrow(_parse(window), PARSE))
    marked = found.repartition("key").sortWithinPartitions("key", "print", *DOCUMENT, "at").mapInArrow(_dictionary, MARKED)
    marks = ["row", "at", "n", "kind", "trigger"]
    entries = (rows.join(_by_document(marked, marks), KEYS).select(*DOCUMENT, "text", *[f"{c}s" for c in marks])
               .sortWithinPartitions(*DOCUMENT).mapInArrow(_entries(window), ENTRIES))
    return (entries.repartition("key").sortWithinPartitions("key", *DOCUMENT, "at")
            .mapInArrow(_corpus_order(window, dictionary), RUNS))


def _cut(window: int):
    def run(batches):
        for batch in batches:
            sizes, kept, spans = [], [], []
            for text, row, *marks in zip(raw(batch.column(1)), batch.column(2).to_pylist(), *batch.columns[3:]):
                sizes.append(len(text))
                count = 0
                if marks[0].is_valid:
                    own = marks[0].values.to_numpy() == row
                    at, n = (m.values.to_numpy()[own] for m in marks[1:])
                    edge = np.zeros(len(text) + 1, np.int64)
                    np.add.at(edge, at, 1)
                    np.add.at(edge, at + n + window - 1, -1)
                    gone = np.cumsum(edge[:-1]) > 0
                    count = int((gone & ~np.r_[False, gone[:-1]]).sum())
                    text = np.frombuffer(text, np.uint8)[~gone].tobytes()
                kept.append(text)
                spans.append(count)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array([a - len(k) for a, k in zip(sizes, kept)], pa.int64()),
                 pa.array(spans, pa.int64()), pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])
    return run


def without_runs(docs: DataFrame, runs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, window: int = 100) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept of every document: the bytes that no window of a run covers.

    Overlapping or touching covers are one span; a cut may fall inside a character, so what is kept is binary. Null texts
    are empty; repeated rows each come out.
    """
    joined = (_rows(docs, id_col, text_col).join(_by_document(runs, ["row", "at", "n"]), KEYS, "left")
              .select("doc_id", "text", "row", "rows", "ats", "ns"))
    return joined.mapInArrow(_cut(window), "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary").withColumn("doc_id", id_out())
