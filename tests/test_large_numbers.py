"""Books, pages, images and document numbers beyond their padded width."""

from pyspark.sql import functions as F

from sectionmap.functions import cc_doc_basename
from sectionmap.functions.names import file_name
from sectionmap.plans import files as FL
from sectionmap.plans import images as IM
from sectionmap.sources.constants import maptype


def test_names_are_padded_not_cut(spark):
    df = spark.createDataFrame([(7, "PM", 12, "2001 OR 5"), (1000, "RS", 1234, "2001 OR 12345678"), (999, "CR", 100, "2001-1234567-2")], "b int, a string, p int, d string")
    got = [tuple(r) for r in df.select(file_name("b", "a", "p"), cc_doc_basename("d")).collect()]
    assert got == [("007pm012", "2001-or-000005"), ("1000rs1234", "2001-or-12345678"), ("999cr100", "2001-doc-1234567")]


def test_files_of_book_1000_are_its_own(spark):
    maps = spark.createDataFrame([(1, 4, 100, 5, 1, None, None, None, None), (2, 4, 1000, 5, 1, None, None, None, None), (3, 4, 1000, 1005, 1, None, None, None, None)],
                                 "id int, maptype_id int, book int, page int, npages int, recdate date, client string, description string, note string")
    keys = ["/map/pm/100/100pm005-001.jpg", "/map/pm/1000/1000pm005-001.jpg", "/map/pm/1000/1000pm005-1001.jpg", "/map/pm/1000/1000pm1005-002.jpg"]
    listing = spark.createDataFrame([(k,) for k in keys], "path string")
    linked = {r["path"]: (r["map_id"], r["page"]) for r in FL.link_files(listing, maps, maptype(spark), "map").collect()}
    assert [linked[k] for k in keys] == [(1, 1), (2, 1), (2, 1001), (3, 2)]
    pages, _ = FL.probe_objects(FL.map_keys(maps, maptype(spark)), listing)
    assert {(r["map_id"], r["page"]) for r in pages.collect()} == {(1, 1), (2, 1), (2, 1001), (3, 2)}


def test_manifest_of_book_1000(spark):
    images = spark.createDataFrame([("/map/pm/1000/1000pm005-001.jpg",), ("/map/pm/100/100pm005-001.jpg",)], "path string")
    cc = spark.createDataFrame([("Parcel Map", 1000, 5, "2001 OR 1234567", 1)], "maptype string, book int, page int, doc_number string, npages int")
    files = spark.createDataFrame([("map/cc/2001-or-1234567-001.jpg",)], "path string")
    manifest, issues = IM.pdf_manifest(images, cc, files, maptype(spark))
    assert sorted(tuple(r) for r in manifest.collect()) == [
        ("1000pm005", 1, "/map/pm/1000/1000pm005-001.jpg"), ("1000pm005", 2, "/map/cc/2001-or-1234567-001.jpg"), ("100pm005", 1, "/map/pm/100/100pm005-001.jpg")]
    assert issues.count() == 0
    plan = IM.resize_plan(IM.cc_scans(spark.createDataFrame([("2001-or-1234567-1001.tif", 10, 10, 200, "L")], "src_file string, width_px int, height_px int, dpi int, mode string")))
    assert plan.select(F.first("status")).first()[0] == "convert"
