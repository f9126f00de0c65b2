"""Driver queries: the description parser."""

from __future__ import annotations

from pyspark.sql import functions as F

from sectionmap.functions import range_str, subsec_name, township_str
from sectionmap.plans import parser as P
from sectionmap.queries import query
from sectionmap.sources import constants as C
from sectionmap.sources.fixtures import Inputs


def _inputs(spark, sf_dir):
    inp = Inputs(spark, sf_dir)
    return inp.f_desc, inp.f_desc_trs


@query
def desc_tokens(spark, sf_dir):
    maps, trs = _inputs(spark, sf_dir)
    return P.with_groups(P.tokenize(maps, trs)).select("map_id", "pos", "token", "grp", "is_tr")


@query
def desc_groups(spark, sf_dir):
    maps, trs = _inputs(spark, sf_dir)
    g = P.with_groups(P.tokenize(maps, trs))
    return g.groupBy("map_id", "grp").agg(F.count(F.lit(1)).alias("n_tokens"),
                                          F.max("qual_t").alias("qual_t"), F.max("qual_r").alias("qual_r"))


@query
def parsed_tokens(spark, sf_dir):
    maps, trs = _inputs(spark, sf_dir)
    return P.classify(maps, trs)


@query
def parsed_qq(spark, sf_dir):
    maps, trs = _inputs(spark, sf_dir)
    return P.parsed_records(maps, trs)


@query
def parsed_rejects(spark, sf_dir):
    maps, trs = _inputs(spark, sf_dir)
    return P.classify(maps, trs).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query
def parsed_text(spark, sf_dir):
    maps, trs = _inputs(spark, sf_dir)
    rec = P.parsed_records(maps, trs)
    s = C.source(spark)
    return (rec.join(s, rec["source_id"] == s["id"])
            .select("map_id",
                    F.concat(subsec_name("subsec"), F.lit(" S"), F.col("sec").cast("string")).alias("sec_text"),
                    township_str("tshp").alias("tshp_text"), range_str("rng").alias("rng_text"),
                    F.col("description").alias("source")))


@query
def parsed_parts(spark, sf_dir):
    """Q5: every part found in a description, with the description and the
    map's trs list: its 'S6 1N 2E' entries in order, each with the number of
    records that carry it, so repeats stay visible and the list is bounded by
    the grid."""
    maps, trs = _inputs(spark, sf_dir)
    entry = F.concat_ws(" ", F.concat(F.lit("S"), F.col("sec").cast("string")), township_str("tshp"), range_str("rng"))
    entries = trs.select("map_id", entry.alias("e")).groupBy("map_id", "e").agg(F.count(F.lit(1)).alias("n"))
    counted = F.concat("e", F.lit(" x"), F.col("n").cast("string"))
    lists = entries.groupBy("map_id").agg(F.sum("n").alias("n_trs"),
                                          F.array_join(F.array_sort(F.collect_list(counted)), " | ").alias("trs_list"))
    descriptions = maps.select(F.col("id").alias("map_id"), "description")
    return P.tokenize(maps, trs).select("map_id", "pos", F.col("token").alias("part")).join(lists, "map_id").join(
        descriptions, "map_id").select("map_id", "description", "pos", "part", "n_trs", "trs_list")
