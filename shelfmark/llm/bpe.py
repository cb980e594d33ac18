"""Byte-level BPE over given ranks: merges replayed in rank order over the distinct words of a block of texts."""

from __future__ import annotations

import base64
import hashlib
import heapq
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from shelfmark.llm.common import MEMO_WORDS, id_out, keyed, raw

#: Code points of a block of whole texts whose new words are encoded together; a longer text is a block of its own.
BLOCK_CHARS = 1 << 22


class Vocabulary:
    """Ranks of a tiktoken file and the pairs of tokens that make up another."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.tokens = dict((int(rank), base64.b64decode(token)) for token, rank in map(bytes.split, f))
        self.ranks = {token: rank for rank, token in self.tokens.items()}
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = []              # two tokens that make up a third, and which
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                left, right = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs.append((left << 32 | right, rank))
        pairs.sort()
        self.pairs, self.made = (np.array(c, np.int64) for c in zip(*pairs))
        # a token with which a lower rank can be made: its merges go one by one in a word
        apart = self.made < np.maximum(self.pairs >> 32, self.pairs & 0xFFFFFFFF)
        self.early = {int(x) for x in (self.pairs[apart] >> 32)} | {int(x) for x in (self.pairs[apart] & 0xFFFFFFFF)}

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """What the pairs make; -1: nothing."""
        pair = left << 32 | right
        at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        return np.where((self.pairs[at] == pair) & (left >= 0) & (right >= 0), self.made[at], -1)

    def replay(self, words: list[bytes]) -> list[bytes]:
        """The ids of every word as little-endian 32-bit integers.

        All words lie in one array of ids. An inverted index leads from the merge of a pair to its positions; merges
        are applied to all their positions in rank order, from left to right in a word, and only the two pairs around
        a merged position are entered anew.
        """
        if not words:
            return []
        sizes = np.array([len(w) for w in words], np.int64)
        ids = self.single[np.frombuffer(b"".join(words), np.uint8)]
        ends = np.cumsum(sizes)
        word = np.repeat(np.arange(len(words)), sizes)
        after, before = np.arange(1, len(ids) + 1), np.arange(-1, len(ids) - 1)
        full = sizes > 0
        after[ends[full] - 1] = -1
        before[(ends - sizes)[full]] = -1
        index: dict[int, list[np.ndarray]] = {}
        todo: list[int] = []

        def enter(ranks: np.ndarray, places: np.ndarray) -> None:
            good = ranks >= 0
            ranks, places = ranks[good], places[good]
            if len(ranks):
                order = np.argsort(ranks, kind="stable")
                ranks, places = ranks[order], places[order]
                cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
                for r, own in zip(ranks[np.r_[0, cuts]].tolist(), np.split(places, cuts)):
                    if r not in index:
                        index[r] = []
                        heapq.heappush(todo, r)
                    index[r].append(own)

        starts = np.flatnonzero(after >= 0)
        enter(self.rank(ids[starts], ids[starts + 1]), starts)
        while todo:
            r = heapq.heappop(todo)
            found = index.pop(r)
            i = np.unique(np.concatenate(found))
            i = i[(ids[i] >= 0) & (after[i] >= 0)]
            i = i[self.rank(ids[i], ids[after[i]]) == r]        # else an earlier merge took a part of the pair
            if not len(i):
                continue
            linked = np.r_[False, after[i[:-1]] == i[1:]]
            if linked.any():            # overlapping pairs: every second one from the left
                k = np.arange(len(i))
                i = i[(k - np.maximum.accumulate(np.where(linked, 0, k))) % 2 == 0]
            if r in self.early:
                first = np.r_[True, word[i[1:]] != word[i[:-1]]]
                rest, i = i[~first], i[first]
                enter(np.full(len(rest), r), rest)
            j = after[i]
            ids[i], ids[j] = r, -1
            after[i] = k = after[j]
            inner = k >= 0
            before[k[inner]] = i[inner]
            left = before[i]
            outer = left >= 0
            enter(np.r_[self.rank(ids[i[inner]], ids[k[inner]]), self.rank(ids[left[outer]], ids[i[outer]])],
                  np.r_[i[inner], left[outer]])
        left = ids >= 0
        packed = ids[left].astype("<u4").tobytes()
        bounds = np.r_[0, np.cumsum(left)][np.r_[0, ends]] * 4
        return [packed[a:b] for a, b in zip(bounds.tolist(), bounds[1:].tolist())]

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """Read once per worker."""
    return Vocabulary(path)


def _encode(path: str, pattern: str):
    def run(batches):
        vocab, split = vocabulary(path), regex.compile(pattern)
        memo: dict[str, bytes] = {}

        def block(ids, texts):
            pieces = [split.findall(t) for t in texts]
            new = list({p for own in pieces for p in own}.difference(memo))
            if len(memo) + len(new) > MEMO_WORDS:
                memo.clear()            # bounds the memory; the block's words are encoded again
                new = list({p for own in pieces for p in own})
            data = [p.encode() for p in new]
            whole = [vocab.ranks.get(d) for d in data]          # a word that is a token needs no merge
            memo.update((p, r.to_bytes(4, "little")) for p, r in zip(new, whole) if r is not None)
            parts = [(p, d) for p, d, r in zip(new, data, whole) if r is None]
            memo.update(zip([p for p, _ in parts], vocab.replay([d for _, d in parts])))
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([b"".join(map(memo.__getitem__, own)) for own in pieces], pa.binary())],
                ["doc_id", "ids"])

        ids, texts, held = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                ids.append(doc_id.as_py())
                texts.append(text.as_py() or "")
                held += len(texts[-1])
                if held >= BLOCK_CHARS:
                    yield block(ids, texts)
                    ids, texts, held = [], [], 0
        if ids:
            yield block(ids, texts)
    return run


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit integers) of every whole text, as byte-level BPE encodes them.

    Each match of ``pattern`` is encoded by itself, without special tokens. Null texts are empty and have no ids.
    Rows are encoded one by one, so repeated ids do not matter; a null id comes out null.
    """
    return (keyed(docs, id_col, text_col).mapInArrow(_encode(path, pattern), "doc_id long, ids binary")
            .withColumn("doc_id", id_out()))


def _decode(path: str):
    def run(batches):
        vocab = vocabulary(path)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([vocab.decode(np.frombuffer(x, "<u4")) for x in raw(batch.column(1))], pa.binary())],
                ["doc_id", "data"])
    return run


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id, data: the bytes of the ids (null: none)."""
    return encoded.select(id_col, ids_col).mapInArrow(_decode(path), "doc_id long, data binary")


def _digests(path: str):
    def run(batches):
        vocab = vocabulary(path)
        for batch in batches:
            rows = [(len(x) // 4, hashlib.sha256(x).hexdigest(),
                     hashlib.sha256(vocab.decode(np.frombuffer(x, "<u4"))).hexdigest()) for x in raw(batch.column(1))]
            n, ids, data = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()),
                                              pa.array(data, pa.string())],
                                             ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return run


def digests(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of encoded rows; the second digest is of the decoded bytes."""
    return encoded.select("doc_id", "ids").mapInArrow(
        _digests(path), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
