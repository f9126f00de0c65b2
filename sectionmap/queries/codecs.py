"""Driver queries: the grid codecs applied to the fixture tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from sectionmap import constants as K
from sectionmap.functions import (
    legacy_qq_list, map_name, range_number, range_str, subsec_bits, subsec_bits_lookup,
    subsec_name, township_number, township_str,
)
from sectionmap.functions.subsec import subsec_cover as cover
from sectionmap.queries import query
from sectionmap.sources import constants as C
from sectionmap.sources.fixtures import Inputs


def description_parts(inp: Inputs):
    """Subsection phrases of the map descriptions ('NE/4' of 'NE/4 S12')."""
    tokens = inp.f_desc.select(F.explode(F.regexp_extract_all(
        "description", F.lit("(?i)" + K.SUBSEC_TOKEN), 0)).alias("token"))
    return tokens.select(F.regexp_replace("token", r"(?i)\s*S\d+\z", "").alias("part"))


@query
def codec_township_range(spark, sf_dir):
    g = Inputs(spark, sf_dir).f_trs.groupBy("tshp", "rng").agg(F.count(F.lit(1)).alias("n"))
    t_str, r_str = township_str("tshp"), range_str("rng")
    return g.select("tshp", "rng", t_str.alias("t_str"), r_str.alias("r_str"),
                    township_number(F.concat(F.lit("t"), F.lower(t_str))).alias("t_back"),
                    range_number(F.concat(F.lit("R"), r_str)).alias("r_back"), "n")


@query
def codec_subsec_names(spark, sf_dir):
    trs = Inputs(spark, sf_dir).f_trs.filter(F.col("subsec").isNotNull())
    return (trs.groupBy(subsec_name("subsec").alias("name"))
            .agg(F.count(F.lit(1)).alias("n"), F.count_distinct("subsec").alias("n_bitmaps")))


@query
def subsec_lookup(spark, sf_dir):
    parts = description_parts(Inputs(spark, sf_dir))
    return (parts.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
            .select("part", subsec_bits_lookup("part").alias("bits"), "n"))


@query
def subsec_algebra(spark, sf_dir):
    parts = description_parts(Inputs(spark, sf_dir))
    return (parts.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
            .select("part", subsec_bits("part").alias("bits"), "n"))


@query
def subsec_cover(spark, sf_dir):
    trs = Inputs(spark, sf_dir).f_trs.filter(F.col("subsec").isNotNull())
    g = trs.groupBy("subsec").agg(F.count(F.lit(1)).alias("n"))
    return g.select("subsec", F.array_join(cover("subsec"), ", ").alias("cover"), "n")


@query
def map_names(spark, sf_dir):
    m = Inputs(spark, sf_dir).f_map
    t = C.maptype(spark)
    return (m.join(t, m["maptype_id"] == t["id"])
            .select(m["id"], map_name(m["book"], t["abbrev"], m["page"]).alias("map_name")))


@query
def legacy_qq_lists(spark, sf_dir):
    trs = Inputs(spark, sf_dir).f_trs.filter(
        (F.col("source_id") == K.SOURCE_LEGACY_SUBSECTION) & F.col("subsec").isNotNull())
    return (trs.groupBy("subsec").agg(F.count(F.lit(1)).alias("n"))
            .select("subsec", legacy_qq_list("subsec").alias("qq_list"), "n"))
