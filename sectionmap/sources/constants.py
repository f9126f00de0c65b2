"""The inline constant relations (map types, trs sources, qq pattern names).

They are a few rows each, so joins against them are planned as broadcast hash
joins; their size is fixed by the domain, not by the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sectionmap import constants as K


def maptype(spark: SparkSession) -> DataFrame:
    return F.broadcast(spark.createDataFrame(K.MAPTYPES, "id INT, maptype STRING, abbrev STRING"))


def source(spark: SparkSession) -> DataFrame:
    return F.broadcast(spark.createDataFrame(K.SOURCES, "id INT, description STRING, quality INT"))


def subsec_names(spark: SparkSession) -> DataFrame:
    rows = [(b, n, r, i) for i, (b, n, r) in enumerate(K.SUBSEC_NAMES)]
    return F.broadcast(spark.createDataFrame(rows, "bits INT, str STRING, rank INT, ord INT"))
