"""Alignment of the tokens that two tokenizers make of the same text.

A is a byte-level BPE (``tokenizers`` JSON) that reads space + text, B a
sentencepiece model that adds that space itself.  Both encode the whole text; the
bytes of their tokens, joined, must be the bytes of space + text, else the row has no
tokens.  Byte offsets where a token of A and one of B both end cut the tokens into
groups, and the two tokens that end there are linked.

Whitespace-token anchors: where tokens marked with a space begin at one offset in A and
in B, the tokens before them end together.  These verified ends split a text into windows
of token ids, mostly of one word.  A window with one token of A or of B is one group; the
others are cut at the ends that their tokens share, all windows of a text at once.
(``Windows`` aligns them one by one and keeps each: the tests compare both.)

Link counts: every task writes, beside its rows, the pair totals of each of its batches;
Spark adds those up.  A pair's rank among the pairs of its B id follows from one maximum
per B id (at most the vocabulary of B).  Rows look up the ``HOT_PAIRS`` most frequent
pairs at most in a broadcast (16 bytes each, a proven bound) and meet the others in a
join on the pair, where no key is frequent.  No row and no link is left out.

Defined cases: null and empty texts, and texts whose joined bytes differ (a tokenizer that
normalises, a literal U+2581), have zeros and '' as groups.  Strings of special tokens are
plain text.  Repeated rows and null ids stay, one row out for each row in.  An empty table
gives an empty result.  A text is encoded as a whole: its tokens must fit a worker.
"""

from __future__ import annotations

import gc
import hashlib
import os
from array import array
from typing import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructType

from sectionmap.llm.byte_level import SPLIT, read_vocabulary, token_bytes
from sectionmap.llm.common import stage

#: Windows of a generation, two of which a task keeps, and the most ids (A and B) of one that is kept.
KEPT_WINDOWS, KEPT_IDS = 1 << 18, 48
#: Pairs that are broadcast to the rows.
HOT_PAIRS = 1 << 17
#: Texts that are encoded together: so many, or so many characters.
TEXTS, CHARS = 256, 1 << 20
#: A pair of ids in 64 bits.
ID_BITS = 31
#: Between the ids of A and B in a window's key.
CUT = -1
NONE = np.zeros(0, np.int64)


class Windows(dict):
    """Alignments of windows by their id tuples, packed as 32-bit ids with ``CUT``
    between A's and B's: groups as ``a1,a2|b1;...``, and the linked pairs, one for each
    shared end.  A missing one is computed.

    A key's value is the place of its alignment in ``texts``, ``first`` and ``pairs``.  ``trim``
    begins a new generation when this one is full; what was met in the last one is
    taken over when it is met again, the rest is forgotten."""

    def __init__(self, a_sizes: Sequence[int], b_sizes: Sequence[int]):
        super().__init__()
        self.a_sizes, self.b_sizes = a_sizes, b_sizes
        self.names = list(map(str, range(max(len(a_sizes), len(b_sizes)))))
        self.old: dict[bytes, tuple[str, list[int]]] = {}
        self.texts: list[str] = []
        self.first, self.pairs = array("q", [0]), array("q")

    def __missing__(self, key: bytes) -> int:
        found = self.old.get(key)
        if found is None:
            ids = memoryview(key).cast("i").tolist()
            cut = ids.index(CUT)
            found = self.align(ids[:cut], ids[cut + 1:])
        at = len(self.texts)
        self.texts.append(found[0])
        self.pairs.extend(found[1])
        self.first.append(len(self.pairs))
        if len(key) <= 4 * KEPT_IDS:
            self[key] = at
        return at

    def links(self, places: np.ndarray) -> np.ndarray:
        """The linked pairs of the alignments at these places, one after the other."""
        first = np.frombuffer(self.first, np.int64)
        n = first[places + 1] - first[places]
        ends = np.cumsum(n)
        return np.frombuffer(self.pairs, np.int64)[np.arange(ends[-1]) + np.repeat(first[places] - ends + n, n)]

    def trim(self) -> None:
        """Begin a new generation if this one is full; places given before are void."""
        if len(self.texts) >= KEPT_WINDOWS:
            self.old = {k: (self.texts[v], self.pairs[self.first[v]:self.first[v + 1]].tolist()) for k, v in self.items()}
            self.clear()
            self.texts, self.first, self.pairs = [], array("q", [0]), array("q")

    def align(self, a: list[int], b: list[int]) -> tuple[str, list[int]]:
        a_text, b_text = list(map(self.names.__getitem__, a)), list(map(self.names.__getitem__, b))
        if len(a) == 1 or len(b) == 1:  # both end with the window, nowhere before
            return f"{','.join(a_text)}|{','.join(b_text)}", [a[-1] << ID_BITS | b[-1]]
        groups, links = [], []
        a_size, b_size = list(map(self.a_sizes.__getitem__, a)), list(map(self.b_sizes.__getitem__, b))
        j = b_end = a_end = i0 = j0 = 0
        for i, size in enumerate(a_size, 1):
            a_end += size
            while b_end < a_end:
                b_end += b_size[j]
                j += 1
            if b_end == a_end:
                groups.append(f"{','.join(a_text[i0:i])}|{','.join(b_text[j0:j])}")
                links.append(a[i - 1] << ID_BITS | b[j - 1])
                i0, j0 = i, j
        return ";".join(groups), links


def packed(a: np.ndarray, b: np.ndarray, a_first: np.ndarray, b_first: np.ndarray) -> list[bytes]:
    """The key of each window: A's ids, ``CUT``, B's ids.  ``first`` holds the first token
    of each window and the number of tokens."""
    n = len(a_first) - 1
    window = np.arange(n)
    out = np.full(len(a) + len(b) + n, CUT, np.int32)
    of_a, of_b = np.repeat(window, np.diff(a_first)), np.repeat(window, np.diff(b_first))
    out[np.arange(len(a)) + b_first[of_a] + of_a] = a
    out[np.arange(len(b)) + a_first[of_b + 1] + of_b + 1] = b
    ends = (4 * (a_first + b_first + np.arange(n + 1))).tolist()
    whole = out.tobytes()
    return [whole[i:j] for i, j in zip(ends, ends[1:])]


def window_starts(a_ends: np.ndarray, b_ends: np.ndarray, a_marked: np.ndarray, b_marked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First token of each window in A and in B, with the numbers of tokens at the end.
    ``ends`` are byte offsets; an anchor is an offset at which marked tokens of both begin."""
    begins = np.zeros(int(a_ends[-1]) + 1, bool)
    begins[b_ends[:-1][b_marked[1:]]] = True
    starts = a_ends[:-1][a_marked[1:]]
    anchors = starts[begins[starts]]
    a_first = np.searchsorted(a_ends, anchors) + 1
    b_first = np.searchsorted(b_ends, anchors) + 1
    return np.concatenate([[0], a_first, [len(a_ends)]]), np.concatenate([[0], b_first, [len(b_ends)]])


class Encoders:
    """Both tokenizers with the bytes, sizes and space marks of their ids."""

    def __init__(self, a_file: bytes, b_file: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task's core is the one it has
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a_file.decode())
        self.a.encode_special_tokens = True
        self.quick = _ranked(a_file)
        self.b = SentencePieceProcessor(model_proto=b_file)
        self.a_bytes = token_bytes(a_file)
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(self.b.id_to_piece(list(range(self.b.get_piece_size()))))]
        self.a_sizes, self.b_sizes = list(map(len, self.a_bytes)), list(map(len, self.b_bytes))
        self.a_size, self.b_size = np.array(self.a_sizes), np.array(self.b_sizes)
        self.a_mark = np.array([t.startswith(b" ") for t in self.a_bytes])
        self.b_mark = np.array([t.startswith(b" ") for t in self.b_bytes])
        # The text of each id of A inside and at the end of a group, then of B.
        self.texts = np.array([b"%d%c" % (i, mark) for n, marks in ((len(self.a_bytes), b",|"), (len(self.b_bytes), b",;")) for mark in marks for i in range(n)])

    def encode(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray] | None]:
        """Token ids of A and B for each text, None where the joined bytes are not the text's.
        A ranked vocabulary only merges the bytes of the text, so their number tells; others are joined."""
        if self.quick:
            firsts = [self.quick.encode_to_numpy(" " + t, disallowed_special=()) for t in texts]
        else:
            firsts = [e.ids for e in self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]
        for text, a, b in zip(texts, firsts, self.b.encode(texts, num_threads=1)):
            a = np.asarray(a, np.int32)
            whole = (" " + text).encode()
            same = int(self.a_size[a].sum()) == len(whole) and b"".join(map(self.b_bytes.__getitem__, b)) == whole
            same = same and (self.quick is not None or b"".join(map(self.a_bytes.__getitem__, a)) == whole)
            yield (a, np.array(b, np.int32)) if text and same else None


def _ranked(a_file: bytes):
    """The same vocabulary for the faster tiktoken library, if its ids are in the order of the
    merges (then they are ranks); None otherwise.  Both split alike for every code point (tested)."""
    import tiktoken

    symbols, ranks, made, _ = read_vocabulary(a_file)
    n = len(symbols) + len(ranks)
    if sorted(symbols) != list(range(256)) or any(made[r] != 256 + r for r in made):
        return None
    return tiktoken.Encoding("ranked", pat_str=SPLIT, mergeable_ranks={b: i for i, b in enumerate(token_bytes(a_file)[:n])}, special_tokens={})


def _packs(column: pa.Array) -> Iterator[list[str]]:
    """Consecutive texts of a column, null as empty, in packs of bounded size."""
    pack, size = [], 0
    for value in column:
        pack.append(value.as_py() or "")
        size += len(pack[-1])
        if len(pack) >= TEXTS or size >= CHARS:
            yield pack
            pack, size = [], 0
    if pack:
        yield pack


def align(docs: DataFrame, a_file: bytes, b_file: bytes, keep: Sequence[str] = ("doc_id",), text: str = "text", digest: bool = False) -> DataFrame:
    """One row for each row of ``docs``: ``keep`` columns, __row (a number of its own),
    n_a, n_b, n_groups, n_links, groups (or their sha256), pairs and seen (the linked
    pairs and how often).  Rows without __row hold pair totals; see ``link_counts``.
    Written once: both tokenizers run once a text."""
    files = docs.sparkSession.sparkContext.broadcast((a_file, b_file))
    rows = docs.select(*keep, F.col(text).cast("string").alias("__text"))
    schema = StructType(rows.schema.fields[:-1])
    figures = ["n_a", "n_b", "n_groups", "n_links"]
    for name, kind in (("__row", LongType()), *((f, LongType()) for f in figures), ("groups", StringType()),
                       ("pairs", ArrayType(LongType())), ("seen", ArrayType(LongType()))):
        schema = schema.add(name, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()  # no cycles are made
        encoders = Encoders(*files.value)
        number = TaskContext.get().partitionId() << 33
        arrow = pa.schema([*rows_schema, *(pa.field(f, pa.int64()) for f in ["__row", *figures]), pa.field("groups", pa.string()),
                           pa.field("pairs", pa.list_(pa.int64())), pa.field("seen", pa.list_(pa.int64()))])
        for batch in batches:
            first, totals = 0, []
            for pack in _packs(batch.column(batch.num_columns - 1)):
                rows = [_aligned(ids, encoders, digest) for ids in encoders.encode(pack)]
                out = list(zip(*rows))
                totals.append(_added([r[-2] for r in rows], [r[-1] for r in rows]))
                ends = pa.array(np.concatenate([[0], np.cumsum([len(x) for x in out[-1]])]).astype(np.int32))
                kept = [c.slice(first, len(pack)).cast(arrow.field(i).type) for i, c in enumerate(batch.columns[:-1])]
                numbers = pa.array(range(number, number + len(pack)), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [*kept, numbers, *(pa.array(c, pa.int64()) for c in out[:4]), pa.array(out[4], pa.string()),
                     *(pa.ListArray.from_arrays(ends, pa.array(np.concatenate(c))) for c in out[5:])], schema=arrow)
                first, number = first + len(pack), number + len(pack)
            codes, seen = _added(*zip(*totals)) if totals else ([], [])
            if len(codes):
                none = [pa.nulls(1, f.type) for f in arrow]
                none[-2:] = [pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), pa.array(c)) for c in (codes, seen)]
                yield pa.RecordBatch.from_arrays(none, schema=arrow)

    from pyspark.sql.pandas.types import to_arrow_schema
    rows_schema = list(to_arrow_schema(StructType([f for f in schema.fields[:len(keep)]])))
    return stage(docs.sparkSession, rows.mapInArrow(run, StructType([f.__class__(f.name, f.dataType, True) for f in schema.fields])), "aligned")


def _added(codes: Sequence[np.ndarray], seen: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes of several lists with their added counts."""
    table = pa.table({"code": np.concatenate(codes), "n": np.concatenate(seen)})
    added = table.group_by("code", use_threads=False).aggregate([("n", "sum")])
    return added.column("code").to_numpy(), added.column("n_sum").to_numpy()


def group_ends(a: np.ndarray, b: np.ndarray, encoders: Encoders) -> tuple[np.ndarray, np.ndarray]:
    """The last token of every group in A and in B: the last one of each window, and in a window
    with several tokens of both those that end together before."""
    a_ends, b_ends = np.cumsum(encoders.a_size[a]), np.cumsum(encoders.b_size[b])
    a_first, b_first = window_starts(a_ends, b_ends, encoders.a_mark[a], encoders.b_mark[b])
    a_count, b_count = np.diff(a_first), np.diff(b_first)
    several = (a_count > 1) & (b_count > 1)
    shared = np.zeros(int(a_ends[-1]) + 1, bool)
    shared[b_ends[np.repeat(several, b_count)]] = True
    last = np.repeat(several, a_count) & shared[a_ends]
    last[a_first[1:] - 1] = True
    a_last = np.flatnonzero(last)
    return a_last, np.searchsorted(b_ends, a_ends[a_last])


def group_text(a: np.ndarray, b: np.ndarray, a_last: np.ndarray, b_last: np.ndarray, encoders: Encoders) -> bytes:
    """``a1,a2|b1;...``: the tokens of each group of A, then of B, from a table of their texts."""
    n_a, n_b = len(encoders.a_bytes), len(encoders.b_bytes)
    codes = np.empty(len(a) + len(b), np.int64)
    # A token of A stands behind the B tokens of the groups before, one of B behind the A tokens of its group, too.
    a_at = np.arange(len(a)) + np.repeat(np.concatenate([[0], b_last[:-1] + 1]), np.diff(a_last, prepend=-1))
    b_at = np.arange(len(b)) + np.repeat(a_last + 1, np.diff(b_last, prepend=-1))
    codes[a_at] = a
    codes[a_at[a_last]] += n_a
    codes[b_at] = b + np.int64(2 * n_a)
    codes[b_at[b_last]] += n_b
    return encoders.texts[codes].tobytes().translate(None, b"\0")[:-1]


def _aligned(ids, encoders: Encoders, digest: bool) -> tuple:
    """(n_a, n_b, n_groups, n_links, groups, pairs, times) of a text's token ids."""
    if ids is None:
        return 0, 0, 0, 0, "", NONE, NONE
    a, b = ids
    a_last, b_last = group_ends(a, b, encoders)
    pairs, seen = np.unique(a[a_last].astype(np.int64) << ID_BITS | b[b_last], return_counts=True)
    groups = group_text(a, b, a_last, b_last, encoders)
    # Tokens have at least one byte, so each shared end closes one group and links one pair.
    return len(a), len(b), len(a_last), len(a_last), hashlib.sha256(groups).hexdigest() if digest else groups.decode(), pairs, seen


def link_counts(aligned: DataFrame) -> DataFrame:
    """(pair, n, best) corpus-wide; best: no other pair of the B id has more links."""
    spark = aligned.sparkSession
    totals = (aligned.where(F.col("__row").isNull()).select(F.explode(F.arrays_zip("pairs", "seen")).alias("e"))
              .groupBy(F.col("e.pairs").alias("pair")).agg(F.sum("e.seen").alias("n")))
    counts = stage(spark, totals, "pairs").withColumn("__b", F.col("pair").bitwiseAND(F.lit((1 << ID_BITS) - 1)))
    # One row a B id: at most its vocabulary.
    most = counts.groupBy("__b").agg(F.max("n").alias("__most"))
    return stage(spark, counts.join(F.broadcast(most), "__b").select("pair", "n", (F.col("n") == F.col("__most")).alias("best")), "pairs")


def hot_floor(counts: DataFrame, most: int = HOT_PAIRS) -> int:
    """The smallest power of two that at most ``most`` pairs reach."""
    steps = counts.groupBy(F.floor(F.log2("n")).cast("int").alias("step")).count().orderBy(F.desc("step")).collect()
    floor, seen = 1 << 62, 0
    for r in steps:
        seen += r["count"]
        if seen > most:
            break
        floor = 1 << r["step"]
    return floor


def score(aligned: DataFrame, counts: DataFrame, keep: Sequence[str] = ("doc_id",), hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """The rows of ``aligned`` with n_best (links whose pair is best for its B id) and
    count_sum (corpus-wide counts over the links)."""
    spark = aligned.sparkSession
    floor = hot_floor(counts, hot_pairs)
    hot = sorted(tuple(r) for r in counts.where(F.col("n") >= floor).collect())
    shipped = spark.sparkContext.broadcast((np.array([h[0] for h in hot], np.int64), np.array([h[1] for h in hot], np.int64),
                                            np.array([h[2] for h in hot], bool)))
    rows = aligned.where(F.col("__row").isNotNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, n, best = shipped.value
        for batch in batches:
            numbers, pairs, seen = batch.columns
            row = np.repeat(np.arange(len(pairs)), pairs.value_lengths().to_numpy(zero_copy_only=False))
            codes = pairs.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            times = seen.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            at = np.searchsorted(keys, codes)
            known = np.zeros(len(codes), bool)
            inside = at < len(keys)
            known[inside] = keys[at[inside]] == codes[inside]
            at, in_row, t = at[known], row[known], times[known]
            sums, bests = np.zeros(len(pairs), np.int64), np.zeros(len(pairs), np.int64)
            np.add.at(sums, in_row, n[at] * t)
            np.add.at(bests, in_row, best[at] * t)
            rest = np.concatenate([[0], np.cumsum(np.bincount(row[~known], minlength=len(pairs)))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [numbers, pa.array(bests), pa.array(sums), pa.ListArray.from_arrays(rest, pa.array(codes[~known])),
                 pa.ListArray.from_arrays(rest, pa.array(times[~known]))], names=["__row", "best", "sum", "pairs", "seen"])

    looked = stage(spark, rows.select("__row", "pairs", "seen").mapInArrow(
        run, "__row long, best long, sum long, pairs array<long>, seen array<long>"), "looked")
    left = looked.select("__row", F.explode(F.arrays_zip("pairs", "seen")).alias("e")).select("__row", "e.pairs", "e.seen")
    rare = counts.where(F.col("n") < floor).withColumnRenamed("pair", "pairs")
    more = left.join(rare, "pairs").select("__row", (F.col("seen") * F.col("best").cast("long")).alias("best"),
                                           (F.col("seen") * F.col("n")).alias("sum"))
    sums = looked.select("__row", "best", "sum").unionByName(more).groupBy("__row").agg(F.sum("best").alias("__best"), F.sum("sum").alias("__sum"))
    return rows.join(sums, "__row").select(*keep, "n_a", "n_b", "n_groups", "n_links", F.col("__best").alias("n_best"),
                                           F.col("__sum").alias("count_sum"), "groups")
