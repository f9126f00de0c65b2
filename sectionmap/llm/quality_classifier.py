"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages (64 words each; the last one shorter).  Every
passage becomes a vector of surface statistics, a tanh layer encodes it, gated
attention (tanh times sigmoid) weighs the passages, and a logistic unit scores
the weighted sum.  Only document labels are known: the gradient reaches the
passages through the attention.

The model is fitted in one task on at most about ``sample`` labelled documents
(the bound is the parameter; documents are drawn by hash); every document is
scored, whole.

Defined results: a null or wordless text is one passage of zeros; rows without a
label are not learned from; with no label to learn from, or one class only, the
score is the share of label 1 (0.5 without any); repeated rows score alike; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import pickle
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sectionmap.llm.bytes import LOWER, NONBLANK, mix64, slices, word_hashes
from sectionmap.llm.common import stage

PASSAGE = 64
SLICE = 1 << 20
HIDDEN, GATE = 16, 8
SYMBOLS = b"#*$%&|<>{}[]~^_=+\\@/"
N_FEATURES = 14


def _class(members: bytes) -> np.ndarray:
    out = np.zeros(256, np.float32)
    out[list(members)] = 1
    return out


CLASSES = np.stack([
    _class(bytes(range(65, 91))), _class(bytes(range(97, 123))), _class(b"0123456789"), _class(SYMBOLS), _class(b"!?"),
    _class(b".,;:"), _class(bytes(range(128, 256)))])


def passages(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(features, passages per row): one row of statistics per passage."""
    words, counts = word_hashes(LOWER[data], offsets, NONBLANK)
    bags = np.maximum(-(-counts // PASSAGE), 1)
    total = int(bags.sum())
    out = np.zeros((total, N_FEATURES), np.float32)
    if not len(words):
        return out, bags
    bag_first = np.cumsum(bags) - bags
    row = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(len(words)) - np.repeat(np.cumsum(counts) - counts, counts)
    passage = bag_first[row] + place // PASSAGE
    inside = NONBLANK[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    filled = offsets[:-1][np.diff(offsets) > 0]
    begins[filled] = inside[filled]
    word_of_byte = np.cumsum(begins) - 1
    at = passage[np.maximum(word_of_byte, 0)]
    n = np.bincount(passage, minlength=total).astype(np.float32)
    kept = at[inside]
    size = np.maximum(np.bincount(kept, minlength=total), 1)
    for k in range(len(CLASSES)):
        out[:, k] = np.bincount(kept, CLASSES[k][data[inside]], minlength=total) / size
    some = np.maximum(n, 1)
    length = np.bincount(word_of_byte[inside], minlength=len(words))
    out[:, 7] = np.log1p(n) / 4
    out[:, 8] = size / some / 8
    out[:, 9] = np.sqrt(np.maximum(np.bincount(passage, length.astype(float) ** 2, minlength=total) / some - (size / some) ** 2, 0)) / 8
    again = np.zeros(len(words))
    again[1:] = (words[1:] == words[:-1]) & (passage[1:] == passage[:-1])
    out[:, 10] = np.bincount(passage, again, minlength=total) / some
    key = np.unique(mix64(words) ^ mix64(passage.astype(np.uint64)), return_index=True)[1]
    out[:, 11] = np.bincount(passage[key], minlength=total) / some
    out[:, 12] = np.bincount(at, data == 10, minlength=total) / some
    one = length == 1
    out[:, 13] = np.bincount(passage, one, minlength=total) / some
    return out, bags


class Model:
    """Gated attention over encoded passages, fitted by Adam on whole bags."""

    def __init__(self, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.mean, self.scale = np.zeros(N_FEATURES), np.ones(N_FEATURES)
        self.w = {
            "E": rng.normal(0, 0.3, (N_FEATURES, HIDDEN)), "e": np.zeros(HIDDEN),
            "V": rng.normal(0, 0.3, (HIDDEN, GATE)), "U": rng.normal(0, 0.3, (HIDDEN, GATE)), "a": rng.normal(0, 0.3, GATE),
            "c": rng.normal(0, 0.3, HIDDEN), "b": np.zeros(1)}
        self.constant: float | None = None

    def forward(self, x: np.ndarray, bags: np.ndarray):
        w = self.w
        x = (x - self.mean) / self.scale
        first = np.cumsum(bags) - bags
        h = np.tanh(x @ w["E"] + w["e"])
        t, g = np.tanh(h @ w["V"]), 1 / (1 + np.exp(-(h @ w["U"])))
        s = (t * g) @ w["a"]
        s = np.exp(s - np.repeat(np.maximum.reduceat(s, first), bags))
        att = s / np.repeat(np.add.reduceat(s, first), bags)
        z = np.add.reduceat(att[:, None] * h, first)
        return x, h, t, g, att, z, 1 / (1 + np.exp(-np.clip(z @ w["c"] + w["b"][0], -30, 30)))

    def score(self, x: np.ndarray, bags: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(bags), self.constant)
        return self.forward(x, bags)[-1]

    def fit(self, x: np.ndarray, bags: np.ndarray, y: np.ndarray, steps: int = 400, rate: float = 0.02, decay: float = 1e-4) -> Model:
        if not len(y) or y.min() == y.max():
            self.constant = float(y.mean()) if len(y) else 0.5
            return self
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-3
        first = np.cumsum(bags) - bags
        m = {k: np.zeros_like(v) for k, v in self.w.items()}
        v2 = {k: np.zeros_like(v) for k, v in self.w.items()}
        for step in range(1, steps + 1):
            w = self.w
            xs, h, t, g, att, z, p = self.forward(x, bags)
            dl = (p - y) / len(y)
            dz = dl[:, None] * w["c"]
            dzp = np.repeat(dz, bags, 0)
            datt = (dzp * h).sum(1)
            ds = att * (datt - np.repeat(np.add.reduceat(att * datt, first), bags))
            dt, dg = ds[:, None] * g * w["a"] * (1 - t * t), ds[:, None] * t * w["a"] * g * (1 - g)
            dh = (att[:, None] * dzp + dt @ w["V"].T + dg @ w["U"].T) * (1 - h * h)
            grad = {"E": xs.T @ dh, "e": dh.sum(0), "V": h.T @ dt, "U": h.T @ dg, "a": (t * g).T @ ds, "c": z.T @ dl, "b": np.array([dl.sum()])}
            for k in w:
                d = grad[k] + decay * w[k]
                m[k] = 0.9 * m[k] + 0.1 * d
                v2[k] = 0.999 * v2[k] + 0.001 * d * d
                w[k] = w[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v2[k] / (1 - 0.999**step)) + 1e-8)
        return self


def _fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    xs, bags, ys = [np.zeros((0, N_FEATURES))], [np.zeros(0, np.int64)], [np.zeros(0)]
    for batch in batches:
        label = batch.column("quality").to_numpy(zero_copy_only=False)
        for lo, hi, data, offsets in slices(batch.column("text"), SLICE):
            x, n = passages(data, offsets)
            xs.append(x)
            bags.append(n)
            ys.append(label[lo:hi].astype(float))
    model = Model().fit(np.concatenate(xs), np.concatenate(bags), np.concatenate(ys))
    yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps((model.w, model.mean, model.scale, model.constant))], pa.binary())], ["model"])


def learn(docs: DataFrame, labels: DataFrame, sample: int = 4000) -> Model:
    """The model fitted on documents with a quality label, about ``sample`` at most."""
    known = labels.where(F.col("quality").isin(0, 1)).select(F.col("doc_id").alias("_d"), "quality")
    n = known.count()
    drawn = known.where(F.pmod(F.xxhash64("_d", F.lit(11)), F.lit(1_000_000)) < max(1.0, 1e6 * sample / max(n, 1)))
    drawn = stage(docs.sparkSession, drawn, "drawn")  # its size is known now, so a small one is broadcast
    rows = docs.select("doc_id", "text").join(drawn, F.col("doc_id") == F.col("_d")).select("doc_id", "text", "quality")
    # One task fits the sample, in a fixed order.
    got = rows.repartition(1).sortWithinPartitions("doc_id", "text", "quality").select("text", "quality").mapInArrow(_fit, "model binary").collect()
    model = Model()
    if got:
        model.w, model.mean, model.scale, model.constant = pickle.loads(bytes(got[0][0]))
    else:
        model.constant = 0.5
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score (0 to 1, higher: label 1 likelier) of every document."""
    packed = pickle.dumps((model.w, model.mean, model.scale, model.constant))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model()
        m.w, m.mean, m.scale, m.constant = pickle.loads(packed)
        for batch in batches:
            for lo, hi, data, offsets in slices(batch.column("text"), SLICE):
                x, bags = passages(data, offsets)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, hi - lo), pa.array(m.score(x, bags).astype(np.float64))],
                                                 ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(judge, docs.select("doc_id").schema.add("score", "double"))
