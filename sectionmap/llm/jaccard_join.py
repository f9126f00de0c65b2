"""N-gram Jaccard join by chosen paths: near duplicates on word shingles.

A document is its set of five-word shingles (ASCII-lower-cased words between
blanks).  Documents with equal sets are one node.  In each of several runs a set
samples a few of its shingles by a hash threshold; nodes that share one meet in
its bucket.  Buckets above ``small`` split again: each member extends the path
by tokens of its sketch, at places that the path chooses.  In small buckets all pairs are compared by
sketch (64 minhashes); in large ones members are first compared with a few
pivots, and those very close to one leave with a link to it.  The runs are as
many as the target recall needs.  What the sketches connect is then decided
exactly: the texts of each candidate group come together once and all pairs get
their true Jaccard similarity.

Groups beyond ``block`` members are compared block against block in separate
tasks, and so are buckets that stay large after the last split, so no task holds
an unbounded group.

Defined results: a null or blank text has no shingles, no links and a class of
its own; a text of one to four words is one shingle; a null id sorts after all
others, as the largest id; repeated rows are linked like copies, and rows that
share an id but not the text are told apart by the text; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import math
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sectionmap.llm.bytes import LOWER, NONBLANK, mix64, slices, window_hashes, word_hashes
from sectionmap.llm.common import join_hot, shuffle_width, stage
from sectionmap.llm.components import components, roots

WIDTH = 5
SKETCH = 64
SLICE = 2 << 20
BRANCH = 6  # tokens a set samples in a run
STEPS = 2  # tokens that extend a path in a large bucket
PIVOTS = 8
SIMILAR, CLOSE, SIMILAR_PIVOTS = 0.45, 0.75, 0.25  # shares of equal minhashes; 64 of them err by 0.06
_rng = np.random.default_rng(77)
ODD = _rng.integers(1, 2**63, SKETCH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SIGNATURE = [("doc_id", pa.int64()), ("text_hash", pa.int64()), ("n", pa.int64()), ("node", pa.binary()), ("tokens", pa.list_(pa.int64())), ("sketch", pa.binary())]


def runs_for(recall: float, threshold: float) -> int:
    """A run misses a pair at the threshold with probability exp(-BRANCH * threshold)."""
    return max(1, math.ceil(math.log(1 / (1 - recall)) / (BRANCH * threshold)))


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(shingle, row), distinct and sorted by row."""
    words, counts = word_hashes(LOWER[data], offsets, NONBLANK)
    h, row = window_hashes(words, counts, WIDTH)
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    return h[new], row[new]


def _signatures(runs: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in slices(batch.column("text"), SLICE):
                h, row = shingle_sets(data, offsets)
                n = np.bincount(row, minlength=hi - lo)
                some = np.flatnonzero(n)
                at = (np.cumsum(n) - n)[some]
                node, sketch = np.zeros((hi - lo, 2), np.uint64), np.zeros((hi - lo, SKETCH), np.uint16)
                picked: list[np.ndarray] = []
                if len(some):
                    node[some, 0] = np.add.reduceat(mix64(h ^ np.uint64(0x51)), at)
                    node[some, 1] = np.bitwise_xor.reduceat(mix64(h ^ np.uint64(0xA7)), at)
                    for k in range(SKETCH):
                        sketch[some, k] = mix64(np.minimum.reduceat(h * ODD[k], at)).astype(np.uint16)
                    bound = np.minimum(BRANCH / n[row], 1.0)
                    for r in range(runs):
                        v = mix64(h ^ np.uint64(1009 * (r + 1)))
                        picked.append(np.stack([row[s := np.flatnonzero(v / 2.0**64 < bound)], mix64(v[s] + np.uint64(r)).view(np.int64)]))
                both = np.concatenate(picked, 1) if picked else np.zeros((2, 0), np.int64)
                both = both[:, np.argsort(both[0], kind="stable")]
                ends = np.append(0, np.cumsum(np.bincount(both[0], minlength=hi - lo))).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(lo, hi - lo).cast(pa.int64()), batch.column("text_hash").slice(lo, hi - lo),
                    pa.array(n.astype(np.int64)),
                    pa.array([x.tobytes() for x in node], pa.binary()), pa.ListArray.from_arrays(pa.array(ends), pa.array(both[1])),
                    pa.array([s.tobytes() for s in sketch], pa.binary())], [c for c, _ in SIGNATURE])
    return sign


def _groups(batches: Iterator[pa.RecordBatch], key: list[str]) -> Iterator[pa.Table]:
    """Tables of whole key groups, many at a time; the partition is sorted by key."""
    held: pa.Table | None = None
    for batch in batches:
        t = pa.Table.from_batches([batch])
        held = t if held is None else pa.concat_tables([held, t])
        last = [held.column(k)[held.num_rows - 1].as_py() for k in key]
        n = held.num_rows
        keep = n
        while keep and [held.column(k)[keep - 1].as_py() for k in key] == last:
            keep -= 1
        if keep:
            yield held.slice(0, keep)
            held = held.slice(keep)
    if held is not None and held.num_rows:
        yield held


def _similar(s: np.ndarray, i: int) -> np.ndarray:
    """Members after ``i`` with a similar sketch; a quarter of it rules most out."""
    j = np.flatnonzero((s[i + 1:, :SKETCH // 4] == s[i, :SKETCH // 4]).sum(1) >= SKETCH // 16) + i + 1
    return j[(s[j] == s[i]).sum(1) >= SIMILAR * SKETCH]


def _bucket_links(batches):
    """Star links (a, b) of the members of a bucket whose sketches agree."""
    for t in _groups(batches, ["path", "i", "j"]):
        keys = np.stack([t.column(c).to_numpy() for c in ("path", "i", "j")])
        nodes = t.column("node").to_pylist()
        sketches = np.frombuffer(b"".join(t.column("sketch").to_pylist()), np.uint16).reshape(-1, SKETCH)
        cut = np.flatnonzero(np.append(True, (keys[:, 1:] != keys[:, :-1]).any(0)))
        out_a, out_b = [], []
        for lo, hi in zip(cut, np.append(cut[1:], len(nodes))):
            s = sketches[lo:hi]
            pairs = [_similar(s, i) for i in range(hi - lo - 1)]
            if not pairs or not sum(map(len, pairs)):
                continue
            root = roots(hi - lo, np.repeat(np.arange(len(pairs)), [len(p) for p in pairs]), np.concatenate(pairs))
            for i in np.flatnonzero(root != np.arange(hi - lo)):
                out_a.append(nodes[lo + root[i]])
                out_b.append(nodes[lo + i])
        yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.binary()), pa.array(out_b, pa.binary())], ["a", "b"])


def candidate_links(nodes: DataFrame, small: int = 800, depth: int = 3, slice_size: int = 2048) -> DataFrame:
    """(a, b): star links between nodes that may be near duplicates.

    nodes: (node, n, tokens, sketch), one row per distinct set.
    """
    spark = nodes.sparkSession
    width = shuffle_width(spark)
    members = nodes.select("node", F.explode("tokens").alias("path"))
    links = []
    for level in range(depth + 1):
        sizes = members.groupBy("path").agg(F.count("*").alias("members")).where("members > 1")
        met = stage(spark, members.join(sizes, "path").join(nodes.select("node", "n", "sketch"), "node")
                    .select("path", "members", "node", "n", "sketch"), "met")
        ready = met.where(F.col("members") <= small).select("path", F.lit(0).alias("i"), F.lit(0).alias("j"), "node", "n", "sketch")
        large = met.where(F.col("members") > small)
        more = not large.isEmpty()
        if more and level == depth:  # slice against slice, every pair of slices
            slices_ = F.ceil(F.col("members") / slice_size).cast("int")
            dealt = large.withColumn("slices", slices_).withColumn("slice", F.pmod(F.xxhash64("node"), F.col("slices")).cast("int"))
            dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
            ready = ready.unionByName(dealt.select("path", F.least("slice", "other").alias("i"), F.greatest("slice", "other").alias("j"),
                                                   "node", "n", "sketch"))
        links.append(stage(spark, ready.repartition(width, "path", "i", "j").sortWithinPartitions("path", "i", "j", "node")
                           .mapInArrow(_bucket_links, "a binary, b binary"), "links"))
        if not more or level == depth:
            break
        # Large buckets: a few members per bucket are pivots; what is close to one leaves.
        # The choice depends on the nodes alone, so buckets of one group share their pivots.
        salt = F.pmod(F.xxhash64("node"), F.lit(PIVOTS))
        pivots = (large.groupBy("path", salt.alias("salt")).agg(F.min(F.struct(F.xxhash64("node"), "node", "n", "sketch")).alias("p"))
                  .groupBy("path").agg(F.collect_list(F.struct("p.node", "p.n", "p.sketch")).alias("pivots")))
        compared = stage(spark, large.join(pivots, "path").select("path", "node", "n", "sketch", "pivots")
                         .mapInArrow(_pivot_links, "node binary, links array<binary>, children array<bigint>"), "pivots")
        links.append(compared.select(F.explode("links").alias("a"), F.col("node").alias("b")))
        members = compared.select("node", F.explode("children").alias("path"))
    out = links[0]
    for more_links in links[1:]:
        out = out.unionByName(more_links)
    return out


def _pivot_links(batches):
    """Members against their bucket's pivots: a link to each pivot whose sketch is
    similar; members that are not very close to any pivot extend the path.

    A member within 0.25 of a pivot may leave: what is within 0.2 of it is within
    0.45 of that pivot, so it is linked to the pivot, or leaves for one that is
    within 0.7 of it and so linked to it."""
    for batch in batches:
        nodes = np.array(batch.column("node").to_pylist(), object)
        path = batch.column("path").to_numpy().view(np.uint64)
        sketch = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), np.uint16).reshape(-1, SKETCH)
        lists = batch.column("pivots")
        flat = lists.flatten()
        pivot_nodes = np.array(flat.field("node").to_pylist(), object)
        pivot_sketch = np.frombuffer(b"".join(flat.field("sketch").to_pylist()), np.uint16).reshape(-1, SKETCH)
        counts = lists.value_lengths().to_numpy()
        owner = np.repeat(np.arange(len(nodes)), counts)
        score = np.zeros(len(owner))
        for lo in range(0, len(owner), 100_000):
            score[lo:lo + 100_000] = (sketch[owner[lo:lo + 100_000]] == pivot_sketch[lo:lo + 100_000]).mean(1)
        first = np.cumsum(counts) - counts
        best = np.maximum.reduceat(score, first) if len(score) else score
        close = best >= CLOSE
        is_pivot = np.zeros(len(nodes), bool)
        is_pivot[owner[pivot_nodes == nodes[owner]]] = True
        # Pivots link among themselves; a member that leaves links to its best pivot, others to all similar ones.
        wanted = np.where(is_pivot, SIMILAR_PIVOTS, np.where(close, best, SIMILAR))
        near = np.flatnonzero((score >= wanted[owner]) & (pivot_nodes != nodes[owner]))
        go = np.flatnonzero(~close)
        # The places tried next are those whose hash under the path is smallest, the same for all members.
        order = mix64(path[go][:, None] ^ (np.arange(SKETCH, dtype=np.uint64) * np.uint64(7919))[None, :])
        place = np.argpartition(order, STEPS, axis=1)[:, :STEPS] if len(go) else np.zeros((0, STEPS), np.int64)
        value = np.take_along_axis(sketch[go], place, 1).astype(np.uint64)
        child = mix64(path[go][:, None] + mix64(value + place.astype(np.uint64) * np.uint64(1 << 20)))
        link_ends = np.append(0, np.cumsum(np.bincount(owner[near], minlength=len(nodes)))).astype(np.int32)
        child_ends = np.append(0, np.cumsum(np.where(close, 0, STEPS))).astype(np.int32)
        yield pa.RecordBatch.from_arrays([
            pa.array(nodes, pa.binary()), pa.ListArray.from_arrays(pa.array(link_ends), pa.array(pivot_nodes[near], pa.binary())),
            pa.ListArray.from_arrays(pa.array(child_ends), pa.array(child.reshape(-1).view(np.int64)))], ["node", "links", "children"])


def _exact(threshold: float):
    """True Jaccard similarity of all pairs of a group (or of two of its blocks):
    (node, root, links): star links and each node's linked documents."""
    def verify(batches):
        for t in _groups(batches, ["label", "i", "j"]):
            rows = list(zip(*(t.column(c).to_pylist() for c in ("label", "i", "j", "node"))))
            # Repeated rows of a node's text: one of them is enough.
            t = t.take([k for k in range(len(rows)) if not k or rows[k] != rows[k - 1]])
            labels = t.column("label").to_pylist()
            i_s, j_s, mine = (t.column(c).to_numpy() for c in ("i", "j", "block"))
            nodes, copies = t.column("node").to_pylist(), t.column("copies").to_numpy()
            sets: list = []
            for _, _, data, offsets in slices(t.column("text"), SLICE):
                h, row = shingle_sets(data, offsets)
                at = np.searchsorted(row, np.arange(len(offsets)))
                sets += [h[at[k]:at[k + 1]] for k in range(len(offsets) - 1)]
            key = [(labels[k], i_s[k], j_s[k]) for k in range(len(labels))]
            lo = 0
            out = []
            while lo < len(key):
                hi = lo
                while hi < len(key) and key[hi] == key[lo]:
                    hi += 1
                out += _pairs(sets[lo:hi], nodes[lo:hi], copies[lo:hi], mine[lo:hi], i_s[lo], j_s[lo], threshold)
                lo = hi
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], kind) for k, kind in enumerate((pa.binary(), pa.binary(), pa.int64()))],
                                             ["node", "root", "links"])
    return verify


def _pairs(sets, nodes, copies, mine, i, j, threshold):
    n = len(sets)
    size = np.array([len(s) for s in sets])
    values, index = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(n), size)
    common = np.zeros((n, n), np.float32)
    order = np.argsort(index, kind="stable")
    index, owner = index[order], owner[order]
    cuts = np.searchsorted(index, np.arange(0, len(values) + 4096, 4096))
    for block, (lo, hi) in enumerate(zip(cuts[:-1], cuts[1:])):
        x = np.zeros((n, 4096), np.float32)
        x[owner[lo:hi], index[lo:hi] - block * 4096] = 1
        common += x @ x.T
    linked = common >= threshold * (size[:, None] + size[None, :] - common) - 1e-6
    np.fill_diagonal(linked, False)
    if i != j:  # two blocks: only pairs across them
        linked &= mine[:, None] != mine[None, :]
    a, b = np.nonzero(np.triu(linked))
    root = roots(n, a, b)
    links = linked @ copies
    return [(nodes[k], nodes[root[k]], int(links[k])) for k in range(n)]


def near_duplicates(docs: DataFrame, threshold: float = 0.8, recall: float = 0.999999, small: int = 800,
                    block: int = 512) -> DataFrame:
    """One row per document: doc_id, class_id (smallest id it is linked to,
    directly or through others), n_links (documents at or above the threshold),
    text_hash and leads (true for the row of its class with the smallest id; of
    rows with equal ids, the one with the smallest text hash)."""
    spark = docs.sparkSession
    ddl = "doc_id bigint, text_hash bigint, n bigint, node binary, tokens array<bigint>, sketch binary"
    signed = stage(spark, docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
                   .mapInArrow(_signatures(runs_for(recall, threshold)), ddl), "signatures")
    last = (1 << 63) - 1
    place = F.struct(F.coalesce("doc_id", F.lit(last)).alias("id"), "text_hash")
    nodes = stage(spark, signed.where("n > 0").groupBy("node").agg(
        F.min(place).alias("first"), F.count("*").alias("copies"), F.first("n").alias("n"),
        F.first("tokens").alias("tokens"), F.first("sketch").alias("sketch")), "nodes")
    candidates = candidate_links(nodes, small)
    groups = stage(spark, components(candidates), "groups")
    sizes = groups.groupBy("label").agg(F.count("*").alias("members"))
    # Each candidate's text, once per block pair of its group.
    blocks = F.ceil(F.col("members") / block).cast("int")
    placed = (groups.join(sizes, "label").join(nodes.select("node", "first", "copies"), "node")
              .withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")))
    text = docs.select(F.coalesce("doc_id", F.lit(last)).alias("id"), F.xxhash64("text").alias("text_hash"), "text")
    with_text = text.join(placed.select("label", "node", "first.*", "copies", "blocks", "block"), ["id", "text_hash"])
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    paired = (with_text.select("*", other).withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))
              .repartition(2 * shuffle_width(spark), "label", "i", "j").sortWithinPartitions("label", "i", "j", "node"))
    found = stage(spark, paired.select("label", "i", "j", "block", "node", "copies", "text")
                  .mapInArrow(_exact(threshold), "node binary, root binary, links bigint"), "verified")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    # Groups of one block are complete already; only links across tasks need more rounds.
    classes = components(found.where("node != root"), "node", "root")
    named = (nodes.select("node", "first", "copies").join(classes, "node", "left")
             .withColumn("label", F.coalesce("label", "node")))
    lowest = named.groupBy("label").agg(F.min("first").alias("lead"))
    node_class = stage(spark, named.join(lowest, "label").join(links, "node", "left")
                       .select("node", "lead", "copies", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")), "classes")
    some = F.col("n") > 0
    return join_hot(signed.select("doc_id", "text_hash", "n", "node"), node_class, "node", F.col("copies"), "left").select(
        "doc_id", F.when(some, F.col("lead.id")).otherwise(F.col("doc_id")).alias("class_id"),
        F.when(some, F.col("n_links")).otherwise(0).cast("long").alias("n_links"), "text_hash",
        F.when(some, place == F.col("lead")).otherwise(True).alias("leads"))
