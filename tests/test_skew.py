"""Whole, exact results when one key holds a third of the rows."""

from pyspark.sql import functions as F

from sectionmap.operators.paths import drop_covered_sections, explode_paths, path_index
from sectionmap.plans import files as FL
from sectionmap.plans import parser as P
from sectionmap.plans.staging import Staging
from sectionmap.sources.fixtures import Inputs
from tests import brute
from tests.conftest import SF001


def test_path_index_with_a_hot_map(spark):
    trs = Inputs(spark, SF001).f_trs
    hot = trs.withColumn("map_id", F.when(F.col("map_id") % 3 == 0, F.lit(1)).otherwise(F.col("map_id")))
    a = path_index(hot)
    b = drop_covered_sections(explode_paths(hot))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert a.filter(F.col("map_id") == 1).count() > a.count() / 4


def test_file_linking_keeps_every_file(spark):
    st = Staging(spark, SF001)
    files = st.inp.f_file
    hot_path = files.first()["path"]
    # A third of the listing is one file name (one map).
    skewed = files.unionByName(spark.range(files.count() // 2).select(F.lit(hot_path).alias("path")))
    linked = FL.link_files(skewed, st.maps, st.maptype, "map")
    assert linked.count() == skewed.count()
    assert linked.filter(F.col("path") == hot_path).select("map_id").distinct().count() == 1


def test_parser_one_huge_description(spark):
    inp = Inputs(spark, SF001)
    descs = [r["description"] for r in inp.f_desc.orderBy("id").limit(400).collect()]
    text = " ; ".join(descs)
    maps = spark.createDataFrame([(7, text)], "id int, description string")
    rows = [(7, t, r, s, None) for t, r, s in [(0, 1, s) for s in range(1, 37)] + [(1, 1, 31), (2, 1, 5), (0, 2, 6)]]
    trs = spark.createDataFrame(rows, "map_id int, tshp int, rng int, sec int, subsec int")
    expected = brute.parse({7: text}, rows)
    got = {(r["map_id"], r["pos"]): r["status"] for r in P.classify(maps, trs).collect()}
    assert len(expected) > 1000 and got == expected
