"""Packing token sequences into windows: combinations of lengths weighted by non-negative least squares."""

from __future__ import annotations

import re
import zlib
from array import array
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from shelfmark.llm.common import MEMO_WORDS, id_out, keyed


#: Code points of whole texts whose words are looked up together.
BLOCK_CHARS = 1 << 22


@dataclass(frozen=True)
class Settings:
    """``window`` tokens a sequence; lengths are counted in ``bins`` classes; a combination has up to ``depth`` of them.

    A block of about ``block`` tokens of whole documents is packed by itself, which bounds a task's memory.
    """

    window: int = 4096
    bins: int = 32
    depth: int = 4
    block: int = 1 << 23
    end_id: int = 2


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


#: Texts that need no Unicode normalisation: printable ASCII, ASCII blanks and the letters of Latin-1, composed.
_PLAIN = re.compile("[ -~\\x09-\\x0DÀ-ÖØ-öø-ÿ]*")
#: The tokenizer's own split, for such words in lower case.
_PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")


def _byte_letters() -> dict[int, str]:
    """The letter byte-level vocabularies write for each byte: itself where it prints, else one beyond the bytes."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


class _WordIds:
    """Ids of runs of text between ASCII blanks, as little-endian bytes."""

    def __init__(self, path: str):
        self.tokenizer = _tokenizer(path)
        self.tokenize, self.letters = self.tokenizer.model.tokenize, _byte_letters()
        self.words: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def split(self, text: str) -> list[str]:
        """Words; those of a plain text in lower case, which changes none of its ids."""
        if _PLAIN.fullmatch(text) and "<|" not in text:
            return text.lower().split()
        return [w.decode() for w in text.encode().split()]

    def word(self, text: str) -> bytes:
        # plain words go to the tokenizer's merges without its (slow) text handling
        if _PLAIN.fullmatch(text) and "<|" not in text:
            get = self.parts.get
            return b"".join([get(p) or self.part(p) for p in _PARTS.findall(text.lower())])
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def part(self, part: str) -> bytes:
        shown = part if part.isascii() else part.encode().decode("latin-1").translate(self.letters)
        self.parts[part] = ids = array("I", [t.id for t in self.tokenize(shown)]).tobytes()
        return ids

    def block(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts; words seen before are looked up."""
        split = [self.split(t) for t in texts]
        new = set().union(*split).difference(self.words)
        if len(self.words) + len(new) > 2 * MEMO_WORDS:         # bounds the memory; the block's words are done again
            self.words, self.parts = {}, {}
            new = set().union(*split)
        self.words.update((w, self.word(w)) for w in new)
        return [b"".join(map(self.words.__getitem__, own)) for own in split]


def _encoded(batches, path):
    """(id, ids as bytes) of every row."""
    words, ids, texts, held = _WordIds(path), [], [], 0
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            ids.append(doc_id)
            texts.append(text or "")
            held += len(texts[-1])
            if held >= BLOCK_CHARS:
                yield from zip(ids, words.block(texts))
                ids, texts, held = [], [], 0
    yield from zip(ids, words.block(texts))


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit integers) of every whole text; null texts have none.

    For vocabularies that drop blanks: a text's ids are those of its runs between ASCII blanks, one after the other.
    """
    def run(batches):
        for doc_id, data in _encoded(batches, path):
            yield pa.RecordBatch.from_arrays([pa.array([doc_id], pa.int64()), pa.array([data], pa.binary())], ["doc_id", "ids"])
    return keyed(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids binary").withColumn("doc_id", id_out())


def combinations(bins: int, depth: int) -> np.ndarray:
    """Ways to fill ``bins`` classes exactly with 2 to ``depth`` lengths, longest first: one row of counts per way."""
    found = []

    def add(chosen, left, largest, parts):
        if left == 0 and len(chosen) > 1:
            row = np.zeros(bins, np.int64)
            np.add.at(row, np.array(chosen) - 1, 1)
            found.append(row)
        elif left and parts:
            for size in range(min(left, largest), (left + parts - 1) // parts - 1, -1):
                add([*chosen, size], left - size, size, parts - 1)

    add([], bins, bins - 1, depth)
    return np.array(found, np.int64).reshape(-1, bins)


def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 400) -> np.ndarray:
    """x >= 0 that nearly minimises |a x - b|, by the active-set method of Lawson and Hanson."""
    x, active = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    gradient = a.T @ b
    tolerance = 1e-9 * max(float(np.abs(gradient).max(initial=0)), 1.0)
    for _ in range(rounds):
        free = np.where(active, -np.inf, gradient)
        if not len(free) or free.max() <= tolerance:
            break
        active[free.argmax()] = True
        while active.any():
            z = np.zeros_like(x)
            z[active] = np.linalg.lstsq(a[:, active], b, rcond=None)[0]
            low = active & (z <= tolerance)
            if not low.any():
                break
            step = (x[low] / np.maximum(x[low] - z[low], 1e-300)).min()
            x = x + min(step, 1.0) * (z - x)
            active &= x > tolerance
            x[~active] = 0.0
        x = np.where(active, z, 0.0)
        gradient = a.T @ (b - a @ x)
    return x


def plan(lengths: np.ndarray, s: Settings) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) that cover documents of the given lengths.

    1. A document longer than a window gives whole windows; what is left of it is a rest like any short document.
    2. Rests are counted by length class, rounded up. Non-negative least squares finds how often each combination of
       classes that fills a window is repeated to use up the counts; the numbers are rounded down and realised.
    3. Rests without a combination are packed greedily: longest first they fill the gaps that the rounding of the
       classes left, and then windows of their own, cut wherever one is full. The last tokens make up sequences of
       powers of two, so that nothing is padded.
    """
    window, width = s.window, s.window // s.bins
    pieces, sequence = [], 0
    rests = []
    for doc, n in enumerate(lengths.tolist()):
        full = n // window * window
        for start in range(0, full, window):
            pieces.append((doc, start, window, sequence, 0))
            sequence += 1
        if n > full:
            rests.append((doc, full, n - full))
    classes = [[] for _ in range(s.bins)]
    for rest in sorted(rests, key=lambda r: r[2]):
        classes[-(-rest[2] // width) - 1].append(rest)
    ways = combinations(s.bins, s.depth)
    counts = np.array([len(c) for c in classes], float)
    gaps = []
    if len(ways) and counts.any():
        scale = 1 / np.sqrt(counts + 1)         # a rare class counts as much as a frequent one
        repeats = np.floor(nnls((ways * scale).T, counts * scale) + 1e-9).astype(int)
        for way in np.argsort(-repeats, kind="stable"):
            sizes = np.repeat(np.arange(s.bins), ways[way])
            for _ in range(repeats[way]):
                if any(len(classes[c]) < k for c, k in enumerate(ways[way]) if k):
                    break                       # rounding asked for more than there is
                offset = 0
                for c in sizes[::-1]:
                    doc, start, n = classes[c].pop()
                    pieces.append((doc, start, n, sequence, offset))
                    offset += n
                if offset < window:
                    gaps.append((sequence, offset))
                sequence += 1
    left = [rest for own in reversed(classes) for rest in reversed(own)]
    total = sum(n for _, _, n in left)
    room = sum(window - offset for _, offset in gaps)
    if room > total:            # too little left to fill every gap: the sequences with the widest gaps are taken apart
        gaps.sort(key=lambda g: g[1])
        apart, k = set(), 0
        while room > total and k < len(gaps):
            apart.add(gaps[k][0])
            room -= window - gaps[k][1]
            total += gaps[k][1]
            k += 1
        gaps = gaps[k:]
        left += [(d, a, n) for d, a, n, q, _ in pieces if q in apart]
        pieces = [p for p in pieces if p[3] not in apart]
    # the room there is, in order: gaps, whole windows, powers of two
    rest = total - room
    rooms = [(q, o, window - o) for q, o in gaps]
    rooms += [(sequence + i, 0, window) for i in range(rest // window)]
    sequence += rest // window
    for bit in reversed(range(window.bit_length())):
        if rest % window >> bit & 1:
            rooms.append((sequence, 0, 1 << bit))
            sequence += 1
    at = iter(rooms)
    q, offset, free = next(at, (0, 0, 0))
    for doc, start, n in left:
        while n:
            if not free:
                q, offset, free = next(at)
            take = min(n, free)
            pieces.append((doc, start, take, q, offset))
            start, n, offset, free = start + take, n - take, offset + take, free - take
    return pieces


COLUMNS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def _pack(path: str, s: Settings):
    end = np.array([s.end_id], "<u4").tobytes()

    def block(ids, data, base):
        lengths = np.array([len(d) // 4 for d in data], np.int64)
        pieces = plan(lengths, s)
        doc, start, length, sequence, offset = (np.array(c, np.int64) for c in zip(*pieces))
        crc = [zlib.crc32(memoryview(data[d])[4 * a:4 * (a + n)]) for d, a, n, *_ in pieces]
        used, sequence = np.unique(sequence, return_inverse=True)
        return len(used), pa.RecordBatch.from_arrays(
            [pa.array([ids[d] for d in doc], pa.int64()), pa.array(start), pa.array(length), pa.array(crc, pa.int64()),
             pa.array(lengths[doc]), pa.array(base + sequence), pa.array(offset)], COLUMNS)

    def run(batches):
        # a task's sequences are numbered within its partition, so a task that runs again gives the same numbers
        base = TaskContext.get().partitionId() << 40
        ids, data, held = [], [], 0
        for doc_id, found in _encoded(batches, path):
            ids.append(doc_id)
            data.append(found + end)
            held += len(data[-1])
            if held >= 4 * s.block:
                n, out = block(ids, data, base)
                yield out
                ids, data, held, base = [], [], 0, base + n
        if ids:
            yield block(ids, data, base)[1]
    return run


def pack(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", *,
         settings: Settings = Settings()) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset of every piece of every document.

    A document's ids are the tokenizer's (``path``) without special tokens, then ``end_id``; null and empty texts have
    that one alone. Every id lies in exactly one piece, pieces of a sequence follow one another from the offset 0, and a
    sequence holds ``window`` ids or a power of two, so none needs padding. Each task packs the documents it reads, in
    blocks: no shuffle. Repeated ids are packed row by row; a null id comes out null; an empty table gives no pieces.
    """
    return (keyed(docs, id_col, text_col)
            .mapInArrow(_pack(path, settings), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
                                               "sequence_id long, offset long")
            .withColumn("doc_id", id_out()))
