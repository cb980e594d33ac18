"""Language of a text: blended-spectrum presence kernels, Nystroem landmarks, one-versus-rest kernel ridge regression."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from shelfmark.operators.lanes import attach_group

UNDETERMINED = "und"


@dataclass(frozen=True)
class Settings:
    """``sample`` bounds the labelled rows the model is fitted on; ``landmarks`` of them span the feature space."""

    longest: int = 3                # n-grams of 1 to this many code points
    bits: int = 15                  # hashed n-gram dimensions, as a power of two
    sample: int = 4000
    landmarks: int = 400
    ridge: float = 1e-3
    sharpness: float = 6.0          # of the share a language has among the scores
    enough: int = 64                # n-grams from which a text can be unlike all languages
    strange: float = 0.002          # share of such labelled rows that reach less in their language than the level
    margin: float = 0.2             # by which the level is lowered then


_NOT_LETTERS = regex.compile(r"\P{L}++")


def present(text: str, s: Settings) -> np.ndarray:
    """Sorted hashed n-grams that occur in the lower-cased text; all that is no letter counts as one blank."""
    letters = _NOT_LETTERS.sub(" ", f" {text.lower()} ")
    if letters == " ":
        return np.empty(0, np.int64)
    points = np.frombuffer(letters.encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    seen = np.zeros(1 << s.bits, bool)
    code = np.zeros(len(points), np.uint64)
    for n in range(1, s.longest + 1):
        code = code[:len(points) - n + 1] * np.uint64(0x100000001B3) + points[n - 1:]
        seen[((code + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - s.bits)] = True
    return np.flatnonzero(seen)


def _presence(s: Settings):
    def run(batches):
        for batch in batches:
            rows = [np.packbits(np.bincount(present(t.as_py() or "", s), minlength=1 << s.bits).astype(np.uint8)).tobytes()
                    for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary()), batch.column(1)], ["bits", "label"])
    return run


@dataclass(frozen=True)
class Model:
    """Languages and, per hashed n-gram, the weight it adds to each: kernel products folded over the landmarks.

    ``level`` is the ridge output that all but ``Settings.strange`` of the rows learned from reach in their language, less
    a margin. It doesn't depend on the number of languages, as a share among them would.
    """

    settings: Settings
    languages: list[str]
    weights: np.ndarray
    level: float = 0.0

    def scores(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(kernel ridge outputs, number of n-grams) of a batch: one product of its presence rows with the weights."""
        found = [present(t, self.settings) for t in texts]
        sizes = np.array([len(f) for f in found])
        total = np.zeros((len(texts), len(self.languages)))
        full = np.flatnonzero(sizes)
        if len(full) and self.languages:
            starts = np.r_[0, np.cumsum(sizes[full])[:-1]]
            total[full] = np.add.reduceat(self.weights[np.concatenate([found[i] for i in full])], starts)
            total[full] /= np.sqrt(sizes[full])[:, None]
        return total, sizes


def fit(docs: DataFrame, label: Column, id_col: str = "doc_id", text_col: str = "text",
        settings: Settings = Settings()) -> Model:
    """Fit on at most ``settings.sample`` rows with an id, a label and a text; bit rows of 2**bits / 8 bytes reach the driver.

    Rows are picked by the hash of id and text, the first of every language, then the second of every language and so on,
    so that a rare language is learned too; of repeated rows one is picked. The kernel of two texts is the number of n-grams (1 to ``longest`` code points, hashed) present in both over the
    root of the product of their sizes. Landmarks are spread over the languages. No usable rows: no languages.
    """
    s = settings
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), label.cast("string").alias("label"),
                       F.col(text_col).cast("string").alias("text")).where("doc_id is not null and label is not null and text is not null")
    rows = rows.withColumn("h", F.xxhash64("doc_id", "text"))
    ids = rows.select("doc_id", "label", "h")
    # the lowest hashes of a label, about twice the sample whatever its rows, are ranked
    share = F.pmod("h", F.lit(1 << 30)) / (1 << 30)
    ids = attach_group(ids, ["label"], ["doc_id", "h"], {"n": ("count", F.lit(1))}).where(share < 2 * s.sample / F.col("n")).drop("n")
    ids = ids.withColumn("turn", F.row_number().over(Window.partitionBy("label").orderBy(F.pmod("h", F.lit(1 << 30)), "h")))
    ids = ids.orderBy("turn", "h").limit(s.sample).select("doc_id", "label", "h").distinct()
    picked = rows.join(F.broadcast(ids), ["doc_id", "label", "h"]).dropDuplicates(["doc_id", "label", "h"])     # bounded by sample
    rows = picked.select("text", "label").mapInArrow(_presence(s), "bits binary, label string").collect()
    rows = [r for r in rows if any(r["bits"])]
    if not rows:
        return Model(s, [], np.zeros((1 << s.bits, 0)))
    # one array in place of thousands of objects, unpacked a few rows at a time: the driver has little memory
    bits, labels = np.frombuffer(b"".join(r["bits"] for r in rows), np.uint8).reshape(len(rows), -1), [r["label"] for r in rows]
    del rows
    order = sorted(range(len(labels)), key=lambda i: (hashlib.md5(bits[i]).digest(), labels[i]))
    bits, labels = bits[order], [labels[i] for i in order]
    languages = sorted(set(labels))

    def rows_of(picked) -> np.ndarray:
        x = np.empty((len(picked), 1 << s.bits), np.float32)
        for i in range(0, len(picked), 64):
            part = np.unpackbits(bits[picked[i:i + 64]], axis=1)
            np.divide(part, np.sqrt(part.sum(axis=1, keepdims=True, dtype=np.float32)), out=x[i:i + 64])
        return x

    y = np.array([[1.0 if label == c else -1.0 for c in languages] for label in labels])
    turn = {c: 0 for c in languages}
    ranks = []
    for label in labels:        # the first of every language, then the second of every language, and so on
        ranks.append(turn[label])
        turn[label] += 1
    marks = np.argsort(ranks, kind="stable")[:s.landmarks]
    landmarks = rows_of(marks)
    values, vectors = np.linalg.eigh((landmarks @ landmarks.T).astype(np.float64))
    good = values > 1e-6
    project = vectors[:, good] / np.sqrt(values[good])          # landmarks -> Nystroem features
    features = np.empty((len(labels), len(marks)))
    for i in range(0, len(labels), 256):
        features[i:i + 256] = rows_of(range(i, min(i + 256, len(labels)))) @ landmarks.T
    features = features @ project
    weight = 1 / y.shape[0] / np.maximum((y > 0).mean(axis=0), 1e-9)        # rare languages count as much as frequent ones
    row_weight = (np.where(y > 0, 1.0, 0.0) * weight).sum(axis=1, keepdims=True)
    gram = features.T @ (features * row_weight) + s.ridge * np.eye(features.shape[1])
    ridge = np.linalg.solve(gram, features.T @ (y * row_weight))
    own = (features @ ridge)[np.arange(len(labels)), y.argmax(axis=1)]
    long = np.bitwise_count(bits).sum(axis=1, dtype=np.int64) >= s.enough
    level = float(np.quantile(own[long], s.strange)) - s.margin if long.any() else -np.inf
    return Model(s, languages, landmarks.T @ (project @ ridge).astype(np.float32), level)


def _score(model: Model, text_col: str):
    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                texts = part.column(1) if part.num_columns > 1 else part.column(0).field(text_col)
                total, sizes = model.scores([t.as_py() or "" for t in texts])
                if model.languages:
                    e = np.exp(model.settings.sharpness * (total - total.max(axis=1, keepdims=True)))
                    share, best = (e / e.sum(axis=1, keepdims=True)).max(axis=1), total.argmax(axis=1)
                    known = (sizes > 0) & ((sizes < model.settings.enough) | (total.max(axis=1) >= model.level))
                    names = [model.languages[b] if n else UNDETERMINED for b, n in zip(best, sizes)]
                    share = np.where(sizes > 0, share, 0.0)
                else:
                    names, share = [UNDETERMINED] * part.num_rows, np.zeros(part.num_rows)
                    known = np.zeros(part.num_rows, bool)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(names, pa.string()), pa.array(share), pa.array(known)],
                                                 ["row", "lang_pred", "score", "known"])
    return run


def judged(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """row (all columns of ``docs`` as a struct), lang_pred, score (0 to 1), known of every row.

    The score is the language's share among all. A text is known if it has a letter and, where it has ``Settings.enough``
    n-grams, its best ridge output reaches the model's level.

    The whole text is read; nothing but the text is. Null texts and texts without a letter are ``und`` with the score 0,
    as is everything where the model has no languages. Repeated rows and ids are scored one by one; an empty table gives
    no rows.
    """
    row = F.struct(*docs.columns).alias("row")
    kind = docs.select(row).schema["row"].dataType.simpleString()
    # a text that is a string already is sent once, with its row
    sent = docs.select(row) if docs.schema[text_col].dataType == StringType() else docs.select(row, F.col(text_col).cast("string").alias("text"))
    return sent.mapInArrow(_score(model, text_col), f"row {kind}, lang_pred string, score double, known boolean")


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score of every row, as ``judged`` gives them."""
    return judged(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), model).select(
        "row.doc_id", "lang_pred", "score")
