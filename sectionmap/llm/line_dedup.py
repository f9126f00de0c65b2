"""Line dedup: levelled sorted runs of line fingerprints (DataFrame code only).

Documents arrive in batches.  Each batch is reduced to a sorted run
(fingerprint, number of documents); a batch first merge-anti-joins the runs
that already settled a key as frequent, so settled keys are never counted
again.  When a level holds ``fanout`` runs they are merged into one run of the
next level, and keys that reach ``min_docs`` move to the settled run.

Defined results: a null or empty text is one empty line; a key shorter than
``min_chars`` is never dropped; a line repeated inside one document counts that
document once; rows repeated with the same id and text count as one document;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sectionmap.llm.common import BLANKS, ascii_lower, stage

KEY = ["h1", "h2"]


def line_key(line: Column) -> Column:
    return ascii_lower(F.trim(line, F.lit(BLANKS)))


def fingerprint(key: Column) -> list[Column]:
    """128 bits: two differently seeded 64-bit hashes."""
    return [F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2")]


def lines_of(docs: DataFrame) -> Column:
    return F.split(F.coalesce(F.col("text"), F.lit("")), "\n", -1)


def identified(docs: DataFrame) -> DataFrame:
    """doc_id and text with ``_t``, the text's hash: rows are told apart by both."""
    return docs.select("doc_id", "text", F.xxhash64("text").alias("_t"))


def keyed_lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """(doc_id, _t, pos, h1, h2); h1 and h2 are null for keys too short to count."""
    lines = identified(docs).select("doc_id", "_t", F.posexplode(lines_of(docs)).alias("pos", "line"))
    keyed = lines.withColumn("key", line_key(F.col("line")))
    short = F.length("key") < min_chars
    return keyed.select("doc_id", "_t", "pos", *[F.when(~short, h).alias(n) for h, n in zip(fingerprint(F.col("key")), KEY)])


class Runs:
    """Levelled runs of (h1, h2, n_docs), each a Parquet table sorted by fingerprint."""

    def __init__(self, spark: SparkSession, min_docs: int, fanout: int):
        self.spark, self.min_docs, self.fanout = spark, min_docs, fanout
        self.levels: list[list[DataFrame]] = [[]]
        self.settled: list[DataFrame] = []

    def _write(self, run: DataFrame, name: str) -> DataFrame:
        return stage(self.spark, run.sortWithinPartitions(*KEY), name)

    def add(self, batch: DataFrame) -> None:
        """Count the batch's documents per key and add them as a level-0 run."""
        pairs = batch.select("doc_id", "_t", *KEY).dropDuplicates()
        for run in self.settled:
            pairs = pairs.join(run, KEY, "left_anti")
        self.levels[0].append(self._write(pairs.groupBy(*KEY).agg(F.count("*").alias("n_docs")), "run"))
        for level in range(len(self.levels)):
            if len(self.levels[level]) >= self.fanout:
                self.compact(level)

    def _merged(self, runs: list[DataFrame]) -> DataFrame:
        out = runs[0]
        for run in runs[1:]:
            out = out.unionByName(run)
        return out.groupBy(*KEY).agg(F.sum("n_docs").alias("n_docs"))

    def compact(self, level: int) -> None:
        """Merge a level's runs; keys that reached the threshold are settled."""
        run = self._write(self._merged(self.levels[level]), "level")
        self.levels[level] = []
        if level + 1 == len(self.levels):
            self.levels.append([])
        self.levels[level + 1].append(run.where(F.col("n_docs") < self.min_docs))
        self.settled.append(run.where(F.col("n_docs") >= self.min_docs).select(*KEY))

    def frequent(self) -> DataFrame:
        """Every key found in at least ``min_docs`` documents, once."""
        left = [r for runs in self.levels for r in runs]
        out = self._merged(left).where(F.col("n_docs") >= self.min_docs).select(*KEY)
        for run in self.settled:
            out = out.unionByName(run)
        return out


def dedup_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, batches: int = 4,
                fanout: int = 2) -> DataFrame:
    """One row per document: doc_id, n_lines, n_dropped, kept (the text without
    its dropped lines)."""
    spark = docs.sparkSession
    lines = stage(spark, keyed_lines(docs, min_chars), "lines")
    runs = Runs(spark, min_docs, fanout)
    counted = lines.where(F.col("h1").isNotNull())
    for b in range(batches):
        runs.add(counted.where(F.pmod(F.xxhash64("doc_id"), F.lit(batches)) == b))
    frequent = stage(spark, runs.frequent(), "frequent").withColumn("drop", F.lit(True))
    hit = lines.join(frequent, KEY, "left").select("doc_id", "_t", "pos", F.coalesce("drop", F.lit(False)).alias("drop"))
    flags = (hit.groupBy("doc_id", "_t").agg(F.array_sort(F.collect_set(F.struct("pos", "drop"))).alias("flags"))
             .where(F.exists("flags", lambda f: f["drop"]))
             .select(F.col("doc_id").alias("_d"), F.col("_t").alias("_u"), "flags"))
    kept = F.filter(F.zip_with(F.col("lines"), F.col("flags"), lambda l, f: F.when(~f["drop"], l)), lambda l: l.isNotNull())
    return (identified(docs).join(flags, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("_t") == F.col("_u")), "left")
            .withColumn("lines", lines_of(docs))
            .select("doc_id", F.size("lines").cast("long").alias("n_lines"),
                    F.when(F.col("flags").isNull(), F.lit(0)).otherwise(
                        F.size(F.filter("flags", lambda f: f["drop"]))).cast("long").alias("n_dropped"),
                    F.when(F.col("flags").isNull(), F.coalesce("text", F.lit(""))).otherwise(
                        F.array_join(kept, "\n")).alias("kept")))
