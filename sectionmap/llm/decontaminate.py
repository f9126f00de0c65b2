"""Benchmark decontamination: suffix arrays over shards of the training texts.

Each task cuts its documents into shards of a few MB, turns them into word
hashes and sorts the suffixes of each shard into a suffix array (suffixes whose
first two words occur nowhere in the benchmark cannot match and are left out of
the sort).  Every benchmark suffix of ``width`` words (a shorter item is one
suffix) is found by binary search; the equal range gives all
occurrences and their places.  Occurrences that follow one another in the document and in an
item are one longest match of that item (its place in both, and its words); the
words of a match are compared byte by byte, so equal hashes alone are no match.  ``spans``
are the words that matches cover, whatever their items.  Benchmark items are searched in blocks of bounded size, so the
benchmark may grow: with more than one block, the rows are numbered in a written
table, the driver reads one block at a time from another and each block's matches
are written; spans are merged per row.  Each block reads the documents once.

In an item that repeats itself a match is followed along the first place of each suffix.

Defined results: a null or blank text has no words and is clean; an item without
words matches nothing; repeated rows are separate rows with equal results,
whatever the number of blocks; the items with a null id count as one item, null
in the list (so in the SQL: counted, but no part of the ids' hash); an empty
benchmark leaves every document clean; other columns are ignored.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sectionmap.llm.bytes import ALNUM, LOWER, mix64, runs_of, slices, word_hashes
from sectionmap.llm.common import stage
from sectionmap.session import scratch_dir

SHARD = 4 << 20
SPAN = "array<struct<start:bigint,words:bigint>>"
MATCH = "array<struct<item_id:bigint,item_start:bigint,start:bigint,words:bigint>>"
FOUND = f"n_words bigint, spans {SPAN}, items array<bigint>, matches {MATCH}"


class Tests:
    """The benchmark's distinct suffixes, cut at ``width`` words."""

    def __init__(self, item_ids: list[int | None], texts: list[str], width: int):
        self.width = width
        # Owners are places in ``ids``, where a null id is the last one.
        ids = sorted(set(item_ids), key=lambda i: (i is None, i or 0))
        self.ids, place = pa.array(ids, pa.int64()), {i: at for at, i in enumerate(ids)}
        rows, lengths, owners, places = [], [], [], []
        #: The bytes of each text's words and where they end, to compare matches with.
        self.texts: list[tuple[bytes, np.ndarray, np.ndarray]] = []
        for first, end, data, offsets in slices(pa.array(texts, pa.large_string()), 1 << 62):
            words, counts = word_hashes(LOWER[data], offsets, ALNUM)
            at = 0
            for i, n in enumerate(counts):
                w = words[at:at + n]
                at += n
                self.texts.append(word_bytes(LOWER[data[offsets[i]:offsets[i + 1]]]))
                size = min(int(n), width)
                for j in range(int(n) - size + 1 if n else 0):
                    row = np.zeros(width, np.uint64)
                    row[:size] = w[j:j + size]
                    rows.append(row)
                    lengths.append(size)
                    owners.append(len(self.texts) - 1)
                    places.append(j)
        self.item_of = np.array([place[i] for i in item_ids], np.int64)
        self.suffixes = np.array(rows, np.uint64).reshape(-1, width)
        self.lengths = np.array(lengths, np.int64)
        self.owners, self.places = np.array(owners, np.int64), np.array(places, np.int64)
        key = np.concatenate([self.lengths[:, None].astype(np.uint64), self.suffixes], 1)
        _, pick, group = np.unique(key, axis=0, return_index=True, return_inverse=True)
        group = group.reshape(-1)
        # Each text once a suffix, at its first place.
        order = np.lexsort((self.places, self.owners, group))
        first = np.ones(len(order), bool)
        first[1:] = (group[order[1:]] != group[order[:-1]]) | (self.owners[order[1:]] != self.owners[order[:-1]])
        order = order[first]
        self.owners, self.places = self.owners[order], self.places[order]
        self.owned = np.append(0, np.cumsum(np.bincount(group[order], minlength=len(pick)))).astype(np.int64)
        self.suffixes, self.lengths = self.suffixes[pick], self.lengths[pick]
        long = self.lengths > 1
        self.singles = np.unique(self.suffixes[~long, 0])
        self.pairs = np.unique(_pair(self.suffixes[long, 0], self.suffixes[long, 1])) if width > 1 else np.zeros(0, np.uint64)


def word_bytes(low: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
    """(bytes, word starts, word ends) of a lower-cased text."""
    inside = np.concatenate([[False], ALNUM[low], [False]])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    return low.tobytes(), edge[::2], edge[1::2]


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix64(a * np.uint64(31) + b)


def _member(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    if not len(among):
        return np.zeros(len(values), bool)
    at = np.searchsorted(among, values)
    return among[np.minimum(at, len(among) - 1)] == values


def suffix_array(words: np.ndarray, row: np.ndarray, tests: Tests) -> tuple[np.ndarray, np.ndarray]:
    """(starts, first ``width`` words of each) of the suffixes that may match, in
    lexicographic order; past the end of a row words are 0."""
    n, width = len(words), tests.width
    may = _member(words, tests.singles)
    if n > 1:
        may[:-1] |= _member(_pair(words[:-1], words[1:]), tests.pairs) & (row[:-1] == row[1:])
    starts = np.flatnonzero(may)
    keys = np.zeros((len(starts), width), np.uint64)
    for j in range(width):
        at = np.minimum(starts + j, max(n - 1, 0))
        same = (starts + j < n) & (row[at] == row[starts])
        keys[:, j] = np.where(same, words[at], 0)
    order = np.lexsort(keys.T[::-1])
    return starts[order], keys[order]


def _search(keys: np.ndarray, tests: Tests, side: str) -> np.ndarray:
    """For every test suffix the first place in the suffix array not below it
    (``left``) or above all suffixes that begin with it (``right``)."""
    lo = np.zeros(len(tests.suffixes), np.int64)
    hi = np.full(len(tests.suffixes), len(keys), np.int64)
    past = np.arange(tests.width)[None, :] >= tests.lengths[:, None]
    every = np.arange(len(lo))
    while (open_ := lo < hi).any():
        mid = (lo + hi) // 2
        have = keys[np.minimum(mid, len(keys) - 1)]
        differ = (have != tests.suffixes) & ~past
        at = differ.argmax(1)
        equal = ~differ.any(1)
        below = have[every, at] < tests.suffixes[every, at]
        go = np.where(equal, side == "right", below) & open_
        lo = np.where(go, mid + 1, lo)
        hi = np.where(open_ & ~go, mid, hi)
    return lo


def longest(row: np.ndarray, owner: np.ndarray, place: np.ndarray, at: np.ndarray, n: np.ndarray) -> np.ndarray:
    """(document row, text, place in it, start, words) of the longest matches: windows of
    one text that follow one another on the same diagonal are one."""
    diagonal = at - place
    order = np.lexsort((at, diagonal, owner, row))
    row, owner, place, at, n, diagonal = (x[order] for x in (row, owner, place, at, n, diagonal))
    new = np.ones(len(row), bool)
    same = (row[1:] == row[:-1]) & (owner[1:] == owner[:-1]) & (diagonal[1:] == diagonal[:-1]) & (at[1:] <= at[:-1] + n[:-1])
    new[1:] = ~same
    begin = np.flatnonzero(new)
    last = np.append(begin[1:], len(row))[:len(begin)] - 1
    return np.stack([row[begin], owner[begin], place[begin], at[begin], at[last] + n[last] - at[begin]])


def match_shard(words: np.ndarray, counts: np.ndarray, tests: Tests) -> np.ndarray:
    """(document row, text of the tests, place in it, start among ``words``, words) of every
    longest run of equal word hashes."""
    row = np.repeat(np.arange(len(counts)), counts)
    starts, keys = suffix_array(words, row, tests)
    if not len(starts) or not len(tests.suffixes):
        return np.zeros((5, 0), np.int64)
    lo, hi = _search(keys, tests, "left"), _search(keys, tests, "right")
    n = hi - lo
    test = np.repeat(np.arange(len(n)), n)
    at = starts[np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
    own = tests.owned[test + 1] - tests.owned[test]
    mine = np.repeat(tests.owned[test], own) + np.arange(own.sum()) - np.repeat(np.cumsum(own) - own, own)
    hit = np.repeat(np.arange(len(test)), own)
    return longest(row[at[hit]], tests.owners[mine], tests.places[mine], at[hit], tests.lengths[test[hit]])


def _verbatim(matches: np.ndarray, tests: Tests, texts: dict[int, bytes], firsts: np.ndarray) -> np.ndarray:
    """The matches whose words have the same bytes in both texts."""
    keep, parsed = np.ones(matches.shape[1], bool), {}
    for k, (row, owner, place, at, n) in enumerate(matches.T.tolist()):
        if row not in parsed:
            parsed = {row: word_bytes(np.frombuffer(texts[row], np.uint8))}  # rows come in order
        (a, a_begin, a_end), (b, b_begin, b_end) = parsed[row], tests.texts[owner]
        at -= int(firsts[row])
        keep[k] = all(a[x:y] == b[v:w] for x, y, v, w in zip(a_begin[at:at + n].tolist(), a_end[at:at + n].tolist(),
                                                             b_begin[place:place + n].tolist(), b_end[place:place + n].tolist()))
    return matches[:, keep]


def _lists(owner: np.ndarray, rows: int, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(np.bincount(owner, minlength=rows))).astype(np.int32)), values)


def _matcher(tests: Tests):
    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in slices(batch.column("text"), SHARD):
                low = LOWER[data]
                words, counts = word_hashes(low, offsets, ALNUM)
                firsts = np.cumsum(counts) - counts
                found = match_shard(words, counts, tests)
                texts = {int(r): low[offsets[r]:offsets[r + 1]].tobytes() for r in np.unique(found[0])}
                row, text, place, at, n = found = _verbatim(found, tests, texts, firsts)
                edge = np.zeros(len(words) + 1, np.int64)
                np.add.at(edge, at, 1)
                np.add.at(edge, at + n, -1)
                begin, stop = runs_of(np.cumsum(edge[:-1]) > 0, firsts)
                owner = np.repeat(np.arange(len(counts)), counts)[begin] if len(begin) else np.zeros(0, np.int64)
                item = tests.item_of[text] if len(text) else text
                both = np.unique(np.stack([row, item], 1), axis=0) if len(row) else np.zeros((0, 2), np.int64)
                spans = pa.StructArray.from_arrays([pa.array(begin - firsts[owner]), pa.array(stop - begin)], ["start", "words"])
                matches = pa.StructArray.from_arrays([tests.ids.take(pa.array(item)), pa.array(place), pa.array(at - firsts[row]), pa.array(n)],
                                                     ["item_id", "item_start", "start", "words"])
                names = [n for n in batch.schema.names if n != "text"]
                yield pa.RecordBatch.from_arrays([
                    *[batch.column(n).slice(first, end - first) for n in names], pa.array(counts.astype(np.int64)),
                    _lists(owner, len(counts), spans), _lists(both[:, 0], len(counts), tests.ids.take(pa.array(both[:, 1]))),
                    _lists(row, len(counts), matches)], [*names, "n_words", "spans", "items", "matches"])
    return match


def _merge_spans(spans):
    """Union of spans of one document, as a native expression: spans sorted by
    start; a span that begins inside the ones before it extends them."""
    ordered = F.array_sort(F.array_distinct(F.flatten(spans)))
    empty = F.expr(f"cast(array() as {SPAN})")

    def step(acc, s):
        last = F.try_element_at(acc, F.lit(-1))
        end = last["start"] + last["words"]
        joined = F.struct(last["start"].alias("start"), (F.greatest(end, s["start"] + s["words"]) - last["start"]).alias("words"))
        return F.when((F.size(acc) > 0) & (s["start"] <= end), F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(joined))).otherwise(
            F.concat(acc, F.array(s)))
    return F.aggregate(ordered, empty, step)


def find_matches(docs: DataFrame, benchmark: DataFrame, width: int = 10, block_bytes: int = 4 << 20) -> DataFrame:
    """One row per document: doc_id, text_hash, n_words, spans (matched words,
    merged), items (ids with a match) and matches (the longest one of every item and
    place: item_id, item_start, start, words)."""
    spark = docs.sparkSession
    items = benchmark.select("item_id", F.coalesce("text", F.lit("")).alias("text")).dropDuplicates()
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-size // block_bytes))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")

    def search(rows: DataFrame, block: DataFrame) -> DataFrame:
        got = block.select("item_id", "text").collect()  # about block_bytes of text, whatever the benchmark's size
        kept = ", ".join(f"{c} bigint" for c in rows.columns if c != "text")
        return rows.mapInArrow(_matcher(Tests([r[0] for r in got], [r[1] for r in got], width)), f"{kept}, {FOUND}")

    if blocks == 1:
        return search(rows, items)
    dealt, matches = scratch_dir(spark, "blocks"), scratch_dir(spark, "matches")
    (items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
     .repartition("block").write.partitionBy("block").parquet(dealt))
    dealt = spark.read.schema(items.schema.add("block", "long")).parquet(dealt)
    # Written, so that a row has the same number whenever it is read.
    rows = stage(spark, rows.withColumn("row", F.monotonically_increasing_id()), "rows")
    for b in range(blocks):
        found = search(rows, dealt.where(F.col("block") == b))
        # Every row once, and after that only rows with a match.
        found.where((F.size("spans") > 0) | F.lit(b == 0)).write.mode("append").parquet(matches)
    return spark.read.schema(found.schema).parquet(matches).groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.first("text_hash").alias("text_hash"),
        F.max("n_words").alias("n_words"), _merge_spans(F.collect_list("spans")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.flatten(F.collect_list("matches")).alias("matches")).drop("row")


def decontaminate(docs: DataFrame, benchmark: DataFrame, width: int = 10) -> DataFrame:
    """The documents without any match, all columns kept."""
    hit = (find_matches(docs, benchmark, width).where(F.size("spans") > 0)
           .select(F.col("doc_id").alias("__hit_id"), F.col("text_hash").alias("__hit_text")).dropDuplicates())
    same = docs["doc_id"].eqNullSafe(F.col("__hit_id")) & (F.xxhash64(docs["text"]) == F.col("__hit_text"))
    return docs.join(hit, same, "left_anti")
