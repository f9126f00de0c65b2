"""Language identification with hyperdimensional profiles.

Every letter has a random +1/-1 vector (derived from its code point).  A letter
trigram is the product of its letters' vectors, rotated by their place; a
document is the sum of its trigram vectors; a language's prototype is the sum of
its documents' unit vectors, less the mean of all prototypes.  A document goes
to the prototype with the largest cosine.  Texts are read whole.

Prototypes are learned on a sample of at most about ``sample`` labelled documents
(the bound is the parameter; documents are drawn by hash).

Defined results: a null text, or one without a letter, is ``und`` with score 0;
rows without a language are not learned from; with nothing to learn from every
document is ``und`` (``has_letter``, where asked for, tells the two apart); ties
go to the first language in code-point order; repeated rows are judged alike; an
empty table gives an empty result.
"""

from __future__ import annotations

import pickle
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sectionmap.llm.common import stage

DIMS = 1024
UNKNOWN = "und"
BLOCK = 4096  # trigrams multiplied at once
def letter_vectors(codes: np.ndarray) -> np.ndarray:
    """One row of +1/-1 per code point."""
    return np.stack([np.random.Generator(np.random.PCG64(int(c))).integers(0, 2, DIMS, dtype=np.int8) * 2 - 1 for c in codes]).astype(np.int8)


class Encoder:
    """Trigram vectors, kept for the life of a task up to a bounded number."""

    MOST = 60_000

    def __init__(self) -> None:
        self.letters: dict[int, np.ndarray] = {}
        self.kind = np.full(0x110000, -1, np.int8)  # of each code point: a letter or not, once seen
        self.known = np.zeros(0, np.int64)
        self.vectors = np.zeros((0, DIMS), np.int8)

    def letter(self, c: int) -> np.ndarray:
        if c not in self.letters:
            self.letters[c] = letter_vectors(np.array([c]))[0]
        return self.letters[c]

    def look_up(self, grams: np.ndarray) -> np.ndarray:
        """Rows of ``self.vectors`` for sorted distinct trigrams."""
        if len(self.known) + len(grams) > self.MOST:
            self.known, self.vectors = np.zeros(0, np.int64), np.zeros((0, DIMS), np.int8)
        new = np.setdiff1d(grams, self.known, assume_unique=True)
        if len(new):
            made = np.stack([np.roll(self.letter(int(g) >> 42), 2) * np.roll(self.letter((int(g) >> 21) & 0x1FFFFF), 1)
                             * self.letter(int(g) & 0x1FFFFF) for g in new])
            both = np.append(self.known, new)
            order = np.argsort(both)
            self.known, self.vectors = both[order], np.concatenate([self.vectors, made])[order]
        return np.searchsorted(self.known, grams)

    def counts(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """(distinct trigrams, counts) of the letters, a run of other characters
        being one blank; no trigram without a letter in the middle."""
        if not text:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        code = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
        unseen = np.unique(code[self.kind[code] < 0])
        self.kind[unseen] = [chr(c).isalpha() for c in unseen]
        letter = self.kind[code] > 0
        code = np.where(letter, code, 32)
        keep = letter.copy()
        keep[1:] |= letter[:-1]
        code = np.concatenate([[32], code[keep], [32]])
        if len(code) < 3 or not letter.any():
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        grams = (code[:-2] << 42) | (code[1:-1] << 21) | code[2:]
        return np.unique(grams[code[1:-1] != 32], return_counts=True)

    def encode(self, texts: list) -> tuple[np.ndarray, np.ndarray]:
        """(unit vectors, whether the text has a letter)."""
        out = np.zeros((len(texts), DIMS), np.float32)
        for lo in range(0, len(texts), 64):
            found = [self.counts(t) for t in texts[lo:lo + 64]]
            grams = np.unique(np.concatenate([g for g, _ in found]))
            if not len(grams):
                continue
            table = np.zeros((len(found), len(grams)), np.float32)
            for i, (g, n) in enumerate(found):
                table[i, np.searchsorted(grams, g)] = n
            for at in range(0, len(grams), BLOCK):
                out[lo:lo + 64] += table[:, at:at + BLOCK] @ self.vectors_of(grams[at:at + BLOCK])
        norm = np.linalg.norm(out, axis=1)
        has = norm > 0
        out[has] /= norm[has, None]
        return out, has

    def vectors_of(self, grams: np.ndarray) -> np.ndarray:
        at = self.look_up(grams)
        return self.vectors[at].astype(np.float32)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    enc, sums = Encoder(), {}
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        for lo in range(0, batch.num_rows, 256):
            vectors, _ = enc.encode(batch.column("text").slice(lo, 256).to_pylist())
            for lang in set(langs[lo:lo + 256]):
                pick = [i for i, x in enumerate(langs[lo:lo + 256]) if x == lang]
                sums[lang] = sums.get(lang, 0) + vectors[pick].sum(0, dtype=np.float64)
    # Rounded, so that the sum does not depend on the order of the partitions.
    names = sorted(sums)
    yield pa.RecordBatch.from_arrays([
        pa.array(names, pa.string()),
        pa.array([np.round(sums[k] * 2**20).astype(np.int64).tolist() for k in names], pa.list_(pa.int64()))], ["lang", "sums"])


def learn(docs: DataFrame, sample: int = 20_000) -> tuple[list[str], np.ndarray]:
    """(languages, centred unit prototypes) from rows with text and lang."""
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text", "lang")
    n = known.count()
    part = known.where(F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1_000_000)) < max(1.0, 1e6 * sample / max(n, 1)))
    summed = (part.select("text", "lang").mapInArrow(_sums, "lang string, sums array<bigint>")
              .select("lang", F.posexplode("sums").alias("at", "s")).groupBy("lang", "at").agg(F.sum("s").alias("s"))
              .groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("at", "s"))).alias("v"))
              .select("lang", F.col("v.s").alias("v")).orderBy("lang").collect())  # one row per language
    names = [r["lang"] for r in summed]
    if not names:
        return [], np.zeros((0, DIMS), np.float32)
    p = np.array([r["v"] for r in summed], np.float64)
    p /= np.maximum(np.linalg.norm(p, axis=1, keepdims=True), 1e-12)
    if len(names) > 1:
        p = p - p.mean(0)
    p /= np.maximum(np.linalg.norm(p, axis=1, keepdims=True), 1e-12)
    return names, p.astype(np.float32)


def identify(docs: DataFrame, names: list[str], prototypes: np.ndarray, letters: bool = False) -> DataFrame:
    """``docs`` with lang_pred and score: the softmax share of the best cosine;
    with ``letters`` also has_letter, whether the text has one."""
    packed = pickle.dumps((names, prototypes))
    made = ["lang_pred", "score", *(["has_letter"] if letters else [])]
    cols = [c for c in docs.columns if c not in made]
    schema = docs.select(*cols).schema.add("lang_pred", "string").add("score", "double")
    if letters:
        schema = schema.add("has_letter", "boolean")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, protos = pickle.loads(packed)
        enc = Encoder()
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                vectors, has = enc.encode(part.column("text").to_pylist())
                more = [pa.array(has, pa.bool_())] if letters else []
                if langs:
                    cos = vectors @ protos.T
                    best = cos.argmax(1)
                    score = 1 / np.exp(16 * (cos - cos.max(1, keepdims=True))).sum(1)
                else:
                    has, best, score = np.zeros(len(has), bool), np.zeros(len(has), int), np.zeros(len(has))
                pred = [langs[b] if h else UNKNOWN for b, h in zip(best, has)]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(pred, pa.string()), pa.array(np.where(has, score, 0.0).astype(np.float64)), *more],
                    [*part.schema.names, *made])

    return docs.select(*cols).mapInArrow(judge, schema)


def held_out(doc_id: Column) -> Column:
    """Rows that nothing is learned from; a null id has no checksum and is not one of them."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))
