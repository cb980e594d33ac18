"""Fill-in-middle: documents cut into pieces that a secondary sort assembles, and sorts back to check the result."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import id_out, keyed

#: What opens a part of the output.
MARKS = {"prefix": b"<P>", "suffix": b"<S>", "middle": b"<M>"}
#: The parts in the order of each form, and the order of the parts in the text.
FORMS = {"plain": ("prefix",), "psm": ("prefix", "suffix", "middle"), "spm": ("suffix", "prefix", "middle")}
IN_TEXT = {"prefix": 0, "middle": 1, "suffix": 2}
#: Units of a piece.
PIECE_UNITS = 4096
#: Bytes of pieces a task holds before it sends them on.
BATCH_BYTES = 4 << 20

KEYS = ["doc_id", "row"]
PIECES = "doc_id long, row long, at long, form string, n long, prefix_chars long, middle_chars long, data binary"
DIGESTS = "doc_id long, row long, at long, form string, n long, prefix_chars long, middle_chars long, sha256 string, data binary"


def units(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the units (runs of ASCII letters, else single code points) in UTF-8, and of the code points."""
    b = np.frombuffer(text, np.uint8)
    letter = ((b | 32) >= 97) & ((b | 32) <= 122)
    code = (b & 0xC0) != 0x80
    inside = letter.copy()
    inside[1:] &= letter[:-1]
    inside[:1] = False
    return np.flatnonzero(code & ~inside), code


def _cut(text: bytes, rolls: tuple[int, ...]) -> tuple[str, int, dict[str, tuple[int, int]], np.ndarray, np.ndarray]:
    """form, units, part -> (first, end) in units, starts of units, code point starts"""
    starts, code = units(text)
    n = len(starts)
    first, second, plain, order = rolls
    if not text or any(m in text for m in MARKS.values()) or plain % 100 >= 90:
        return "plain", n, {"prefix": (0, n)}, starts, code
    a, b = sorted((first % (n + 1), second % (n + 1)))
    return "spm" if order % 100 < 20 else "psm", n, {"prefix": (0, a), "middle": (a, b), "suffix": (b, n)}, starts, code


def _pieces(size: int):
    """A row per chunk of ``size`` units of a document, ``at`` its position in the output; a part's first chunk opens with its mark."""
    names = [c.split()[0] for c in PIECES.split(", ")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            columns = [batch.column(i) for i in range(3)]
            rolls = batch.column(3).to_pylist()
            for doc_id, row, text, own in zip(columns[0].to_pylist(), columns[1].to_pylist(), columns[2].cast(pa.large_binary()), rolls):
                text = text.as_py() or b""
                form, n, parts, starts, code = _cut(text, own)
                ends = np.r_[starts, len(text)]
                chars = {p: int(code[ends[a]:ends[b]].sum()) for p, (a, b) in parts.items()} if form != "plain" else {}
                at = 0
                for part in FORMS[form]:
                    a, b = parts[part]
                    for k in range(a, max(b, a + 1), size):      # an empty part has a piece too, its mark
                        data = text[ends[k]:ends[min(k + size, b)]]
                        if form != "plain" and k == a:
                            data = MARKS[part] + data
                        rows.append((doc_id, row, at, form, n, chars.get("prefix"), chars.get("middle"), data))
                        held += len(data) + 64
                        at += 1
                if held >= BATCH_BYTES:
                    yield _batch(rows, names, PIECES)
                    rows, held = [], 0
        if rows:
            yield _batch(rows, names, PIECES)
    return run


_ARROW = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}


def _batch(rows: list[tuple], names: list[str], schema: str) -> pa.RecordBatch:
    kinds = [_ARROW[c.split()[1]] for c in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def _stream(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """Sorted pieces one by one, whatever the batches."""
    for batch in batches:
        yield from zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns)))


def _assembled(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces in output order fed to one digest a document; out they go with their place in the text instead.

    That place is told from the output alone: outside the plain form no text has a mark, so a piece that begins with one
    opens a part. The document's last piece is followed by a row with the digest for each time the document came.
    """
    names = [c.split()[0] for c in DIGESTS.split(", ")]
    rows, held, key, digest, last = [], 0, None, None, None
    part = count = copies = 0

    def end():
        return [(*key, -1, *last[3:7], digest.hexdigest(), None)] * copies

    for piece in _stream(batches):
        form, data = piece[3], piece[7]
        if piece[:2] != key:
            if key is not None:
                rows += end()
            key, digest, part, count, copies = piece[:2], hashlib.sha256(), 0, 0, 1
        elif piece[2] == last[2]:       # of a row that repeats both id and text
            copies += not piece[2]
            continue
        last = piece
        digest.update(data)
        if form != "plain":
            for name, mark in MARKS.items():
                if data.startswith(mark):
                    part, count, data = IN_TEXT[name], 0, data[len(mark):]
                    break
        if data:
            rows.append((*key, part << 40 | count, *piece[3:7], None, data))
            held += len(data) + 64
        count += 1
        if held >= BATCH_BYTES:
            yield _batch(rows, names, DIGESTS)
            rows, held = [], 0
    if key is not None:
        yield _batch(rows + end(), names, DIGESTS)


def _restored(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces in text order fed to a second digest a document; one row a document, the one that leads it here."""
    out = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"
    names = [c.split()[0] for c in out.split(", ")]
    rows, lead, digest, copies = [], None, None, 0

    def done():
        doc_id, _, _, form, n, prefix, middle, sha, _ = lead
        return [(doc_id, n, form, prefix, middle, sha, digest.hexdigest())] * copies

    for piece in _stream(batches):
        if piece[2] < 0 and piece == lead:
            copies += 1
        elif piece[2] < 0:
            if lead is not None:
                rows += done()
            lead, digest, copies = piece, hashlib.sha256(), 1
            if len(rows) >= 10_000:
                yield _batch(rows, names, out)
                rows = []
        else:
            digest.update(piece[8])
    if lead is not None:
        yield _batch(rows + done(), names, out)


def rolls(id_col: str = "doc_id", seed: str = "1") -> Column:
    """Four unsigned 32-bit numbers drawn from the id: the first digits of the SHA-256 of ``seed:id``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    return F.array(*[F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)])


def output_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: str = "1", *,
                  piece_units: int = PIECE_UNITS) -> DataFrame:
    """doc_id, row, at, form, n, prefix_chars, middle_chars, data: the transformed texts, a row per piece of piece_units units.

    Joined by ``at`` the pieces of a document are its output; ``row`` tells texts of one id apart. Every partition holds
    whole documents in that order; rows that repeat both id and text have their pieces side by side.
    """
    rows = keyed(docs, id_col, text_col).withColumn("row", F.xxhash64("text"))
    own = rolls("_given", seed)
    rows = rows.withColumn("_given", id_out()).select("doc_id", "row", "text", own.alias("rolls"))
    return rows.mapInArrow(_pieces(piece_units), PIECES).repartition(*KEYS).sortWithinPartitions(*KEYS, "at")


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: str = "1", *,
                  piece_units: int = PIECE_UNITS) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256 of every document.

    A text is cut into n units, runs of ASCII letters or single other code points. Numbers drawn from the id (``rolls``)
    give the cuts and the form: psm and spm put the suffix, or suffix and prefix, before the middle; empty texts, texts
    with a mark and a tenth of the others stay plain, their prefix_chars and middle_chars null. Null texts are empty, a
    null id draws as the empty string; repeated rows each come out; other columns are not read; an empty table gives no rows.

    Pieces are keyed by document and output position, partitioned by document and sorted within the partition, the form of
    ``repartitionAndSortWithinPartitions`` for DataFrames, and stream into one digest a document; sorted again within
    the same partition, now by the place that the output itself tells, they stream into the digest of the restored text.
    So texts are shuffled once, and no task holds more than a few megabytes of pieces besides the sorter, which spills.
    """
    assembled = output_pieces(docs, id_col, text_col, seed, piece_units=piece_units).mapInArrow(_assembled, DIGESTS)
    out = assembled.sortWithinPartitions(*KEYS, "at").mapInArrow(
        _restored, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, "
        "restored_sha256 string")
    return out.withColumn("doc_id", id_out())
