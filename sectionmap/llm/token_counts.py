"""Token counts of whole texts without token ids (byte-level BPE).

A text is cut into the pieces that the vocabulary's split pattern makes.  A piece
starts as its bytes in a doubly linked list; a heap holds the rank and place of
every adjacent pair that can merge.  The lowest rank (of equal ranks the leftmost)
is popped, its two symbols become one, and the pairs with its new neighbours are
pushed; entries whose pair has changed meanwhile are passed over.  The count is
the number of initial symbols minus the number of merges.  n symbols take
O(n log n) steps, so one word of megabytes is no special case.

Counts of pieces are kept in a table of bounded size per task, since pieces repeat.
One narrow stage, no shuffle; the vocabulary (about 1 MB) is the only broadcast.

Defined cases: null and empty texts have 0 bytes and 0 tokens.  A string of an added
token inside a text is that one token, as the library does by default.  Repeated rows
and null ids stay as they are, one row out for each row in.  Memory beside the batch:
about 100 bytes a byte of the longest piece.
"""

from __future__ import annotations

import heapq
from array import array
from typing import Iterator, Sequence

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructType

from sectionmap.llm.byte_level import newer_letters, read_vocabulary, splitter

#: Kept piece counts per task, and the longest piece (characters) that is kept.
KEPT_PIECES, KEPT_CHARS = 1 << 19, 48
#: Characters of a text that are split at once; the next cut is at the end of a word.
PART = 1 << 20
ROWS = 256


class PieceCounts(dict):
    """Piece -> number of tokens, counted when first asked for."""

    def __init__(self, symbols: list[int], ranks: dict[int, int], made: dict[int, int]):
        super().__init__()
        self.symbols, self.ranks, self.made = symbols, ranks, made

    def __missing__(self, piece: str) -> int:
        n = self.count(piece.encode())
        if len(piece) <= KEPT_CHARS:
            if len(self) >= KEPT_PIECES:
                self.clear()
            self[piece] = n
        return n

    def count(self, piece: bytes) -> int:
        """Initial symbols minus merges of one piece."""
        size, ranks, made = len(piece), self.ranks, self.made
        symbols = array("l", [self.symbols[b] for b in piece])
        after, before = array("l", range(1, size + 1)), array("l", range(-1, size - 1))
        heap = []
        for at in range(size - 1):
            rank = ranks.get(symbols[at] << 32 | symbols[at + 1])
            if rank is not None:
                heap.append(rank << 40 | at)
        heapq.heapify(heap)
        merges = 0
        while heap:
            top = heapq.heappop(heap)
            rank, at = top >> 40, top & ((1 << 40) - 1)
            right = after[at]
            # A symbol that was merged into its left neighbour is -1.
            if symbols[at] < 0 or right >= size or ranks.get(symbols[at] << 32 | symbols[right]) != rank:
                continue
            symbols[at], symbols[right] = made[rank], -1
            merges += 1
            follows = after[at] = after[right]
            if follows < size:
                before[follows] = at
                rank = ranks.get(symbols[at] << 32 | symbols[follows])
                if rank is not None:
                    heapq.heappush(heap, rank << 40 | at)
            left = before[at]
            if left >= 0:
                rank = ranks.get(symbols[left] << 32 | symbols[at])
                if rank is not None:
                    heapq.heappush(heap, rank << 40 | left)
        return size - merges


def parts(text: str, most: int = PART) -> Iterator[str]:
    """Consecutive parts of a text whose pieces are the pieces of the text: no piece
    runs from a non-blank into a blank, so a part may end there."""
    seam = regex.compile(r"\S(?=\s)")
    at = 0
    while len(text) - at > most:
        found = seam.search(text, at + most - 1)
        if found is None:
            break
        yield text[at:found.end()]
        at = found.end()
    yield text[at:] if at else text


def count_tokens(docs: DataFrame, vocabulary: bytes, keep: Sequence[str] = ("doc_id",), text: str = "text", limit: int = 512) -> DataFrame:
    """``keep`` columns with n_bytes (UTF-8), n_tokens and over_limit (n_tokens > limit)
    of every whole text; ``vocabulary`` is the content of the JSON file.  Other columns
    of ``docs`` are not read, so their names may clash with the new ones."""
    shipped = docs.sparkSession.sparkContext.broadcast((vocabulary, newer_letters()))
    rows = docs.select(*keep, F.col(text).cast("string").alias("__text"))
    schema = StructType(rows.schema.fields[:-1])
    for name, kind in (("n_bytes", LongType()), ("n_tokens", LongType()), ("over_limit", BooleanType())):
        schema = schema.add(name, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols, ranks, made, added = read_vocabulary(shipped.value[0])
        tokens_of = PieceCounts(symbols, ranks, made).__getitem__
        find = splitter(*shipped.value)
        special = regex.compile("|".join(map(regex.escape, sorted(added, key=len, reverse=True)))) if added else None
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            n_bytes, n_tokens = [], []
            for first in range(0, len(column), ROWS):
                for value in column.slice(first, ROWS):
                    value = value.as_py() or ""
                    n_bytes.append(len(value.encode()))
                    between = special.split(value) if special else [value]
                    n_tokens.append(len(between) - 1 + sum(sum(map(tokens_of, find(p))) for s in between for p in parts(s)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64()),
                 pa.array([n > limit for n in n_tokens], pa.bool_())], names=schema.names)

    return rows.mapInArrow(run, schema)
