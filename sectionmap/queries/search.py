"""Driver queries: path index and location searches."""

from __future__ import annotations

from sectionmap.operators.paths import explode_paths, path_index
from sectionmap.operators.search import (
    box_paths, compare_by_box, maps_by_box, maps_by_box_paths, maps_in_boxes, maps_in_mask, maps_in_sections, maps_in_subtree,
    maps_on_paths, restrict_to_paths, symmetric_difference,
)
from sectionmap.queries import query
from sectionmap.sources.fixtures import Inputs

# E/2 S26 T5N R1W + W/2 S30 T5N R1E (sections chosen so the fixture has hits).
SPAN = [("5N", "1W", 26, 0xCCCC), ("5N", "1E", 30, 0x3333)]


@query
def trs_paths(spark, sf_dir):
    return explode_paths(Inputs(spark, sf_dir).f_trs)


@query
def paths_without_parents(spark, sf_dir):
    return path_index(Inputs(spark, sf_dir).f_trs)


@query
def search_sections(spark, sf_dir):
    return maps_in_sections(Inputs(spark, sf_dir).f_trs, "5N", "1W", [23, 24, 25, 26])


@query
def search_mask(spark, sf_dir):
    return maps_in_mask(Inputs(spark, sf_dir).f_trs, "5N", "1W", 26, 0xFFFF)


@query
def search_paths(spark, sf_dir):
    paths = box_paths("5N", "1W", 26, 0xFFFF)
    return maps_on_paths(path_index(restrict_to_paths(Inputs(spark, sf_dir).f_trs, paths)), paths)


@query
def search_section_paths(spark, sf_dir):
    paths = ["5N.1W.23", "5N.1W.24", "5N.1W.25", "5N.1W.26"]
    return maps_on_paths(path_index(restrict_to_paths(Inputs(spark, sf_dir).f_trs, paths)), paths)


@query
def search_subtree(spark, sf_dir):
    trs = restrict_to_paths(Inputs(spark, sf_dir).f_trs, ["5N.1W"])
    return maps_in_subtree(path_index(trs), "5N.1W")


@query
def search_span(spark, sf_dir):
    return maps_in_boxes(Inputs(spark, sf_dir).f_trs, SPAN)


@query
def search_equivalence(spark, sf_dir):
    inp = Inputs(spark, sf_dir)
    by_bitmap = maps_in_boxes(inp.f_trs, SPAN)
    paths = [p for b in SPAN for p in box_paths(*b)]
    by_path = maps_on_paths(path_index(restrict_to_paths(inp.f_trs, paths)), paths)
    return symmetric_difference(by_bitmap, by_path, names=("bitmap", "path"))


@query
def box_search(spark, sf_dir):
    """P10 / F8 for a table of boxes over several ranges, with masks of every kind."""
    inp = Inputs(spark, sf_dir)
    return maps_by_box(inp.f_trs, inp.f_box)


@query
def box_equivalence(spark, sf_dir):
    """J12 / U3 per box: maps found by bitmap, by path (maps filed under a whole section
    count there) and by both."""
    inp = Inputs(spark, sf_dir)
    return compare_by_box(inp.f_box, maps_by_box(inp.f_trs, inp.f_box), maps_by_box_paths(path_index(inp.f_trs), inp.f_box))


def _specs(inp):
    """One path spec per (township, range) present in the trs table, using every
    spec form; some carry an impossible section and are rejected whole."""
    from pyspark.sql import functions as F
    from sectionmap.functions import range_str, township_str
    pairs = inp.f_trs.select("tshp", "rng").distinct()
    root = F.concat(township_str("tshp"), F.lit("."), range_str("rng"), F.lit("."))
    spec = F.concat(root, F.lit("[1-3,11] "), root, F.lit("7.[A-C,P] "), root, F.lit("12.KLOP "), root,
                    F.lit("20 "), root, F.lit("[36-34,007-8]"),
                    F.when((F.col("tshp") + F.col("rng")) % 7 == 0, F.concat(F.lit(" "), root, F.lit("40")))
                    .otherwise(F.lit("")))
    return pairs.select(spec.alias("spec"))


@query
def expanded_specs(spark, sf_dir):
    from sectionmap.operators.search import expand_specs
    return expand_specs(_specs(Inputs(spark, sf_dir))).select("spec", "elem", "path", "valid", "spec_ok")


@query
def search_specs(spark, sf_dir):
    from sectionmap.operators.search import search_specs_on_trs
    inp = Inputs(spark, sf_dir)
    return search_specs_on_trs(inp.f_trs, _specs(inp))


@query
def path_validation(spark, sf_dir):
    """C15 over every distinct indexed path."""
    from pyspark.sql import functions as F
    from sectionmap.functions import validate_path
    idx = path_index(Inputs(spark, sf_dir).f_trs).select("trs_path").distinct()
    return idx.groupBy(validate_path("trs_path").alias("valid")).agg(F.count(F.lit(1)).alias("n"))
