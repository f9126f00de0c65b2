"""Incremental linking of file listings (P4 as a stream).

The batch build re-reads the whole object listing each run.  When listings
arrive as new text files (one key per line), a Structured Streaming query can
link only the new keys: a stream-static left join against the map table, each
micro-batch appended to the file table.  The checkpoint location must be in
shared storage so a restarted driver resumes exactly where it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sectionmap.plans.files import link_files


def listing_stream(spark: SparkSession, listing_dir: str, max_files_per_trigger: int = 100) -> DataFrame:
    return (spark.readStream.format("text").option("maxFilesPerTrigger", max_files_per_trigger)
            .load(listing_dir).select(F.col("value").alias("path")).filter(F.length("path") > 0))


def link_stream(spark: SparkSession, listing_dir: str, maps: DataFrame, maptype: DataFrame, kind: str,
                out_dir: str, checkpoint_dir: str, once: bool = True):
    """Start the query; with ``once`` it processes what is there and stops."""
    linked = link_files(listing_stream(spark, listing_dir), maps, maptype, kind, with_page=(kind != "pdf"))
    writer = (linked.writeStream.format("parquet").option("path", out_dir)
              .option("checkpointLocation", checkpoint_dir).outputMode("append"))
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime="1 minute")
    return writer.start()
