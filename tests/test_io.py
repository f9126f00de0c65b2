"""Sources and sinks: XML records, sheets, listings, reports, publish."""

import os

from pyspark.sql import functions as F

from sectionmap.plans import export as X
from sectionmap.sources import io
from tests.conftest import SF001

SUBSECTION_XML = """<?xml version="1.0" encoding="UTF-8"?>
<dataroot xmlns:od="urn:schemas-microsoft-com:officedata" generated="2018-01-01T00:00:00">
<SubSectionList><OrderCode>50074</OrderCode><subsection>05N1W26</subsection></SubSectionList>
<SubSectionList><OrderCode>50075</OrderCode><subsection>05N1W27</subsection></SubSectionList>
<SubSectionList><OrderCode>50076</OrderCode></SubSectionList>
</dataroot>
"""


def test_read_records(spark, tmp_path):
    p = tmp_path / "subsectionlist.xml"
    p.write_text(SUBSECTION_XML)
    df = io.read_records(spark, str(p), "SubSectionList", "OrderCode INT, subsection STRING")
    assert sorted(tuple(r) for r in df.collect()) == [(50074, "05N1W26"), (50075, "05N1W27"), (50076, None)]
    bad = io.missing_fields(df, ["OrderCode", "subsection"]).collect()
    assert [(r["OrderCode"], r["missing"]) for r in bad] == [(50076, ["subsection"])]


def test_sheet_and_report(spark, tmp_path):
    sheet = spark.createDataFrame([("Parcel Map", 1, 5, "12 AMENDED"), ("Record Map", 2, 9, "7")],
                                  "maptype string, book int, page int, pm string")
    io.write_report(sheet, str(tmp_path / "pm"), sep=",")
    back = io.read_sheet(spark, str(tmp_path / "pm"), "maptype string, book int, page int, pm string")
    assert sorted(tuple(r) for r in back.collect()) == sorted(tuple(r) for r in sheet.collect())
    io.write_report(sheet, str(tmp_path / "tsv"))
    text = "".join(open(os.path.join(tmp_path / "tsv", f)).read() for f in os.listdir(tmp_path / "tsv")
                   if f.endswith(".csv"))
    assert "maptype\tbook\tpage\tpm" in text


def test_listing(spark, tmp_path):
    root = tmp_path / "bucket"
    (root / "map" / "pm" / "003").mkdir(parents=True)
    for n in (1, 2):
        (root / "map" / "pm" / "003" / f"003pm120-00{n}.jpg").write_bytes(b"x" * n)
    (root / "map" / "pm" / "003" / "notes.txt").write_text("skip")
    df = io.list_files(spark, str(root), "*.jpg", leading_slash_of=str(root))
    assert sorted((r["path"], r["length"]) for r in df.collect()) == [
        ("/map/pm/003/003pm120-001.jpg", 1), ("/map/pm/003/003pm120-002.jpg", 2)]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[-1].split("\n")[0]
    io.write_listing(df, str(tmp_path / "listing"))
    assert sorted(r["path"] for r in io.read_listing(spark, str(tmp_path / "listing")).collect()) == sorted(
        r["path"] for r in df.collect())


def test_xml_export_round_trip(spark, tmp_path):
    recs = spark.createDataFrame(
        [(1, "Parcel Map", 3, 120, 121, "2001-01-02T00:00:00", "A B", None, "NE/4 S6", None, [",1,2,", ",4,"], None),
         (2, "Survey", 4, 7, 7, None, "UNKNOWN", "CLIENT", None, "/pdf/rs/004/004rs007.pdf", None, [",16,"])],
        "ID int, maptype string, BOOK int, FIRSTPAGE int, LASTPAGE int, RECDATE string, SURVEYOR string, "
        "DONEFOR string, DESCRIP string, Picture string, _x0030_5N1W26 array<string>, _x0030_7N1E31 array<string>")
    X.write_maps_xml(recs, str(tmp_path / "maps"))
    raw = "".join(open(os.path.join(tmp_path / "maps", f)).read() for f in os.listdir(tmp_path / "maps")
                  if not f.startswith(".") and not f.startswith("_"))
    assert raw.count("<_x0030_5N1W26>") == 2 and "<DONEFOR>" in raw and raw.count("<RECDATE>") == 1
    back = X.read_maps_xml(spark, str(tmp_path / "maps"))
    assert sorted(tuple(r) for r in back.collect()) == sorted(tuple(r) for r in recs.collect())


def test_publish(spark, tmp_path):
    from sectionmap.plans.publish import read_published, rebuild, search_published_subtree
    report = rebuild(spark, SF001, str(tmp_path / "pub"))
    assert report["published"]
    trs = read_published(spark, str(tmp_path / "pub"), "trs")
    assert trs.count() > 0
    # Rows of maps that the build does not have are set aside, not published.
    maps = read_published(spark, str(tmp_path / "pub"), "map").select(F.col("id").alias("map_id"))
    reject = read_published(spark, str(tmp_path / "pub"), "trs_reject")
    assert report["checks"]["trs_fk_map"] == 0 and trs.join(maps, "map_id", "left_anti").count() == 0
    assert reject.count() > 0 and reject.join(maps, "map_id", "left_semi").count() == 0
    q = search_published_subtree(spark, str(tmp_path / "pub"), "5N.1W")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "StringStartsWith" in plan
    assert q.count() > 0
    # trs is partitioned by township: a township filter prunes partitions.
    pruned = trs.filter(F.col("tshp") == 4)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(tshp" in pruned


def test_write_back(spark, tmp_path):
    sheet = spark.createDataFrame([("Parcel Map", 1, 5), ("Survey", 2, 9)], "MAPTYPE string, BOOK int, PAGE int")
    res = spark.createDataFrame([("Parcel Map", 1, 5, 77, 2)], "MAPTYPE string, BOOK int, PAGE int, MAP_ID int, MAP_IMAGES int")
    out = io.write_back(sheet, res, ["MAPTYPE", "BOOK", "PAGE"], str(tmp_path / "sheet"))
    back = io.read_sheet(spark, str(tmp_path / "sheet"), out.schema)
    assert sorted(tuple(r) for r in back.collect()) == [("Parcel Map", 1, 5, 77, 2), ("Survey", 2, 9, None, None)]
