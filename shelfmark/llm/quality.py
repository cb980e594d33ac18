"""Quality of a text: logistic regression over hashed word n-grams, trained by follow-the-regularised-leader."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import MEMO_WORDS, id_out, keyed


@dataclass(frozen=True)
class Settings:
    """``sample`` bounds the labelled rows that are learned from, ``entries`` their n-grams; the rest are FTRL's constants."""

    bits: int = 18
    sample: int = 4000
    entries: int = 8_000_000
    epochs: int = 6
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.002
    l2: float = 0.01
    scale: float = 12.0         # of the shares of n-grams in a text


_TOKEN = re.compile(r"\w+|[^\w\s]+")


def _shape(token: str) -> str:
    if not token[0].isalnum():
        return token[:3]
    if token.isdigit():
        return "0"
    if len(token) > 1 and token.isupper():
        return "AA"
    return "Aa" if token[0].isupper() else "aa"


class _Tokens(dict):
    """Memo of (hash of a token, hash of its shape)."""

    def __missing__(self, token):
        if len(self) >= MEMO_WORDS:
            self.clear()
        self[token] = value = (xxhash.xxh3_64_intdigest(token.encode("utf-8", "replace")) << 64
                               | xxhash.xxh3_64_intdigest(_shape(token).encode("utf-8", "replace"), seed=1))
        return value


def features(text: str, memo: _Tokens, s: Settings) -> np.ndarray:
    """Hashed word n-grams of the whole text, one entry per occurrence.

    Tokens are words and runs of punctuation. There are n-grams of one and two tokens, of one to three token shapes
    (case, digits, the punctuation itself) and one for a token that follows itself at a distance of one or two.
    """
    tokens = _TOKEN.findall(text)
    if not tokens:
        return np.empty(0, np.int64)
    packed = b"".join([memo[t].to_bytes(16, "little") for t in tokens])
    pairs = np.frombuffer(packed, np.uint64).reshape(-1, 2)
    shape, word = pairs[:, 0], pairs[:, 1]
    k = np.uint64(0x9E3779B97F4A7C15)
    again = [np.full(int((word[d:] == word[:-d]).sum()), 77 + d, np.uint64) for d in (1, 2) if len(word) > d]
    grams = [word, (word[:-1] * k + word[1:]) * k, shape, (shape[:-1] * k + shape[1:]) * k ^ k,
             ((shape[:-2] * k + shape[1:-1]) * k + shape[2:]) * k, *again]
    mixed = np.concatenate(grams) * np.uint64(0xD1B54A32D192ED03)
    return (mixed >> np.uint64(64 - s.bits)).astype(np.int64)


def _sampled(s: Settings):
    def run(batches):
        memo = _Tokens()
        for batch in batches:
            found = [np.unique(features(t.as_py() or "", memo, s), return_counts=True) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([f.astype(np.int32).tobytes() for f, _ in found], pa.binary()),
                 pa.array([n.astype(np.int32).tobytes() for _, n in found], pa.binary()), batch.column(1), batch.column(2)],
                ["f", "n", "label", "h"])
    return run


@dataclass(frozen=True)
class Model:
    settings: Settings
    weights: np.ndarray
    bias: float


def ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], s: Settings) -> Model:
    """FTRL-proximal over (features, values, label) rows, epoch after epoch; classes weigh the same."""
    size = (1 << s.bits) + 1
    z, n = np.zeros(size), np.zeros(size)

    def weights(f):
        w = -(z[f] - np.sign(z[f]) * s.l1) / ((s.beta + np.sqrt(n[f])) / s.alpha + s.l2)
        return np.where(np.abs(z[f]) <= s.l1, 0.0, w)

    good = max(sum(y for _, _, y in rows), 1)
    class_weight = {1: len(rows) / 2 / good, 0: len(rows) / 2 / max(len(rows) - good, 1)}
    for epoch in range(s.epochs):
        for i in np.random.default_rng(epoch).permutation(len(rows)):
            f, x, y = rows[i]
            f, x = np.r_[f, size - 1], np.r_[x, 1.0]
            w = weights(f)
            p = 1 / (1 + np.exp(-np.clip(w @ x, -30, 30)))
            g = (p - y) * x * class_weight[y]
            sigma = (np.sqrt(n[f] + g * g) - np.sqrt(n[f])) / s.alpha
            z[f] += g - sigma * w
            n[f] += g * g
    w = weights(np.arange(size))
    return Model(s, w[:-1].astype(np.float32), float(w[-1]))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        settings: Settings = Settings()) -> Model:
    """Learn from at most ``settings.sample`` labelled rows, picked by hash; their n-gram counts alone reach the driver.

    Of these rows, in hash order, those are taken whose different n-grams stay within ``settings.entries`` together, 8 bytes
    each, so that long texts can't fill the driver. Rows with a null id, label or text teach nothing, repeated rows count
    once; an id that is labelled both 0 and 1 counts with both. No rows: every score is 0.5.
    """
    s = settings
    # labels are narrow: the sample is drawn from their ids before any text is touched
    picked = (labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
              .where("doc_id is not null and label in (0, 1)"))
    picked = picked.distinct().orderBy(F.xxhash64("doc_id"), "label").limit(s.sample)
    rows = keyed(docs, id_col, text_col).join(F.broadcast(picked), "doc_id").where("text is not null")    # bounded by sample
    rows = rows.withColumn("h", F.xxhash64("doc_id", "text")).dropDuplicates(["h", "label"]).orderBy("h", "label").limit(s.sample)
    rows = rows.select("text", "label", "h").mapInArrow(_sampled(s), "f binary, n binary, label int, h long")
    held = F.sum(F.length("f") / 4).over(Window.orderBy("h", "label"))      # at most ``sample`` rows
    rows = rows.withColumn("held", held).where(F.col("held") <= s.entries).select("f", "n", "label").collect()
    found = sorted((bytes(r["f"]), bytes(r["n"]), r["label"]) for r in rows)
    counts = [(np.frombuffer(f, np.int32).astype(np.int64), np.frombuffer(n, np.int32), y) for f, n, y in found]
    return ftrl([(f, s.scale * n / max(n.sum(), 1), y) for f, n, y in counts], s)


def _score(model: Model):
    def run(batches):
        s, memo = model.settings, _Tokens()
        for batch in batches:
            margins = []
            for text in batch.column(1):
                f = features(text.as_py() or "", memo, s)
                # a sparse dot product: every occurrence adds its weight
                margins.append(s.scale * float(model.weights[f].sum(dtype=np.float64)) / len(f) if len(f) else 0.0)
            score = 1 / (1 + np.exp(-np.clip(np.array(margins) + model.bias, -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], ["doc_id", "score"])
    return run


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score (0 to 1, higher is better) of every row from its whole text alone.

    Null, empty and blank texts have the score of the bias. Repeated rows and ids are scored one by one; other columns are
    not read, an empty table gives no rows.
    """
    return (keyed(docs, id_col, text_col).mapInArrow(_score(model), "doc_id long, score double").withColumn("doc_id", id_out()))
