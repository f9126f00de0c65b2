"""Driver queries: the audits on inputs with rows that break their rules (A6, C15,
J13, O4, Q13-Q15, Q17, Q18)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sectionmap.functions import validate_path
from sectionmap.operators.paths import explode_paths
from sectionmap.plans import export as X
from sectionmap.plans import surveyors as SV
from sectionmap.plans import trs as TR
from sectionmap.queries import query
from sectionmap.sources.fixtures import Inputs


@query
def broken_ranges(spark, sf_dir):
    """Q18: every range rule broken by some records."""
    return TR.range_checks(Inputs(spark, sf_dir).f_trs_odd)


@query
def repeated_cells(spark, sf_dir):
    """Groups whose sum of bits is not their OR."""
    return TR.sum_vs_or(Inputs(spark, sf_dir).f_qq_odd)


@query
def invalid_paths(spark, sf_dir):
    """Valid and invalid paths, by the number of their labels."""
    paths = explode_paths(Inputs(spark, sf_dir).f_trs_odd).select("trs_path").distinct()
    return paths.groupBy(F.size(F.split("trs_path", "[.]")).alias("labels"), validate_path("trs_path").alias("valid")).agg(F.count(F.lit(1)).alias("n"))


@query
def name_conflicts(spark, sf_dir):
    """Q13, Q14, Q17: conflicts of every kind, the same display name of two surveyors among them."""
    alias = Inputs(spark, sf_dir).f_alias_odd
    return SV.name_conflicts(alias, SV.build_surveyors(alias))


@query
def signer_order(spark, sf_dir):
    """Signers in the order of "last name display name", with last names of two words."""
    inp = Inputs(spark, sf_dir)
    surveyors = SV.build_surveyors(inp.f_alias_odd)
    maps = inp.f_map.select("id", F.concat(F.lit("L"), (F.col("id") % 60 + 1).cast("string")).alias("_name"))
    last = surveyors.select(F.col("id").alias("surveyor_id"), F.substring_index("lastname", " ", -1).alias("_last"))
    signed = maps.join(last, maps["_name"] == last["_last"]).select(F.col("id").alias("map_id"), "surveyor_id")
    return SV.surveyor_lists(maps, signed, surveyors)


@query
def map_diff(spark, sf_dir):
    """J13 on map records: clients against the legacy extract; NULL equals NULL, and a NULL on one side is a change."""
    inp = Inputs(spark, sf_dir)
    legacy = inp.f_legacy_map.select("id", F.when(F.col("id") % 21 == 0, None).when(F.col("id") % 22 == 0, "X").otherwise(F.col("donefor")).alias("client"))
    return X.diff_records(inp.f_map.select("id", "client"), legacy, ["id"], "client")
