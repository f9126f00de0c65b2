"""Staging from extracts: bad records, open elements, order of files, publishing."""

import os

import pytest
from pyspark.sql import functions as F

from sectionmap.functions.markup import decode_entities, escape_entities
from sectionmap.plans import document as D
from sectionmap.plans import publish as PB
from sectionmap.plans import trs as TR
from sectionmap.queries import extracts as Q
from sectionmap.session import checkpoint_base
from sectionmap.sources import extracts as E
from sectionmap.sources import io as IO
from sectionmap.sources.fixtures import Inputs
from tests.conftest import SF001

MAPS = """<?xml version="1.0" encoding="utf-8"?>
<dataroot xmlns:od="urn:schemas-microsoft-com:officedata">
  <!-- <map><ID>0</ID></map> -->
  <map><ID>1</ID><!-- a <b> --><maptype>Parcel Map</maptype><BOOK> 3 </BOOK><RECDATE>2001-02-03T00:00:00</RECDATE>
    <_x0030_5N1W26>,1,2,</_x0030_5N1W26><_x0030_7N1E31>,4,</_x0030_7N1E31><DONEFOR>A &amp;amp; B &#233;&#x1F600;&nope;</DONEFOR></map>
  <map kind='x'>
    <ID>2</ID><BOOK/><DESCRIP></DESCRIP><_x0031_0N1E01 a="1">,16,</_x0031_0N1E01>
  </map><map><BOOK>4</BOOK></map>
  <map><ID>3</ID><BOOK>4<BOOK></map>
  <map><ID>4</ID><maptype>lost
  <map><ID>5</ID><BOOK>5x</BOOK><LASTPAGE>1</LASTPAGE><RECDATE>soon</RECDATE></map>
  <map><ID>1</ID><maptype>Survey</maptype></map>
  <map></map>
</dataroot>
"""
MORE = "<dataroot><map><ID>6</ID></map><map><ID>1</ID></map><map><ID>7</ID><BOOK>1</BOOK>"


@pytest.fixture()
def extracts(spark, tmp_path):
    folder = tmp_path / "map.xml"
    folder.mkdir()
    (folder / "part-00000").write_text(MAPS)
    (folder / "part-00001").write_text(MORE)
    (folder / "part-00002").write_text("")
    return E.Extracts(spark, str(tmp_path))


def test_map_records_and_quarantine(extracts):
    good = {r["ID"]: r for r in extracts.maps.good.collect()}
    assert sorted(good) == [1, 2, 6]
    one = good[1]
    assert (one["maptype"], one["BOOK"], str(one["RECDATE"]), one["DONEFOR"]) == ("Parcel Map", 3, "2001-02-03", "A &amp; B é😀&nope;")
    assert [tuple(e) for e in one["_open"]] == [("_x0030_5N1W26", ",1,2,"), ("_x0030_7N1E31", ",4,")]
    assert good[2]["BOOK"] is None and good[2]["DESCRIP"] is None
    bad = sorted((r["record_key"] or "", r["reasons"]) for r in extracts.maps.quarantine.collect())
    assert bad == [("", "missing ID"), ("", "missing ID"), ("0", "unreadable"), ("1", "repeated ID"), ("1", "repeated ID"), ("3", "unreadable"),
                   ("4", "unreadable"), ("5", "bad BOOK, bad RECDATE"), ("7", "unreadable")]
    assert all(r["record"] is not None for r in extracts.maps.quarantine.collect())


def test_open_elements_become_sections(extracts):
    got = sorted(map(tuple, TR.qq_of_elements(extracts.qq_elements).collect()))
    assert got == [(1, 4, -1, 26, 0x0008 + 0x0004), (1, 6, 0, 31, 0x0001), (2, 9, 0, 1, 0x8000)]


@pytest.mark.parametrize("split", ["1m", "200"])
def test_first_of_repeated_keys_is_the_first_in_the_files(spark, extracts, split):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        assert extracts.maps.good.where("ID = 1").select("maptype").first()[0] == "Parcel Map"
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_one_bad_record_costs_no_other(spark, tmp_path):
    (tmp_path / "s.xml").write_text("<dataroot><Surveyor><Surveyor>A &amp; B</Surveyor><lastname>B</lastname></Surveyor>\n"
                                    "<Surveyor><Surveyor>C</Surveyor><lastname>D<lastname></Surveyor>\n<Surveyor><lastname>E</lastname></Surveyor></dataroot>")
    loaded = E.load(IO.read_raw_records(spark, str(tmp_path / "s.xml"), "Surveyor", ["Surveyor", "lastname"]), "surveyor",
                    E.SURVEYOR_FIELDS, ["Surveyor", "lastname"])
    assert [(r["Surveyor"], r["lastname"]) for r in loaded.good.collect()] == [("A & B", "B")]
    assert sorted(r["reasons"] for r in loaded.quarantine.collect()) == ["missing Surveyor", "unreadable"]


def test_entities(spark):
    texts = ["", None, "a & b", "&lt;&amp;lt;&gt;", "&#x41;&#66;&#xD800;&#0;&#9999999;", "&nbsp;&ndash;&unknown;", "&&amp;&;", "é&frac12;"]
    want = ["", None, "a & b", "<&lt;>", "AB&#xD800;&#0;&#9999999;", " –&unknown;", "&&&;", "é½"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", "t", decode_entities("t").alias("d"),
                                                                                             decode_entities(escape_entities("t")).alias("back"))
    rows = sorted(df.collect())
    assert [r["d"] for r in rows] == want and [r["back"] for r in rows] == texts


def test_manifest(spark, extracts):
    (files := {}).update({os.path.basename(r["path"]): (r["extract"], r["length"]) for r in extracts.manifest().collect()})
    assert files["part-00000"] == ("map.xml", len(MAPS.encode())) and files["part-00001"][1] == len(MORE)
    assert "content" not in extracts.manifest()._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[-1].split("\n")[0]


def test_document_is_one_ordered_file(spark, tmp_path):
    trs = spark.createDataFrame([(i, f"0{i % 9 + 1}N", "1E", ",1,") for i in range(300, 0, -1)], "ID int, TOWNSHIP string, RANGE string, SECTION string")
    names = spark.createDataFrame([(2, "B & C", "C"), (1, "A", "A")], "n int, Surveyor string, lastname string")
    path = str(tmp_path / "doc")
    D.write_document(spark, [D.records(names, "Surveyor", ["Surveyor", "lastname"], F.col("n")), D.trs_records(trs)], path, "2020-01-01T00:00:00Z")
    text = "".join(open(os.path.join(path, f)).read() for f in sorted(os.listdir(path)) if f.startswith("part-"))
    import xml.etree.ElementTree as ET
    root = ET.fromstring(text)
    assert [e.tag for e in root] == ["Surveyor"] * 2 + ["TRS"] * 300
    assert [e.find("ID").text for e in root.findall("TRS")] == [str(i) for i in range(1, 301)]
    back = IO.read_raw_records(spark, path, "Surveyor", ["Surveyor", "lastname"])
    assert sorted((r["Surveyor"], r["lastname"]) for r in back.collect()) == [("A", "A"), ("B & C", "C")]


def test_diff_counts_repeats(spark):
    a = [(1, "x"), (1, "x"), (2, "x"), (3, "x"), (None, None), (5, None), (6, "x")]
    b = [(1, "x"), (2, "y"), (4, "x"), (None, None), (5, None), (6, "x"), (6, "y")]
    df = lambda rows: spark.createDataFrame(rows, "k int, v string")
    got = {(r["k"], r["v"]): (r["n_export"], r["n_check"], r["status"]) for r in D.diff_documents(df(a), df(b), ["k"], "v").collect()}
    assert got == {(1, "x"): (2, 1, "repeated"), (2, "x"): (1, 0, "changed"), (2, "y"): (0, 1, "changed"), (3, "x"): (1, 0, "extra"),
                   (4, "x"): (0, 1, "missing"), (None, None): (1, 1, "same"), (5, None): (1, 1, "same"), (6, "x"): (1, 1, "same"),
                   (6, "y"): (0, 1, "changed")}


def test_rebuild_from_extracts_and_rivals(spark, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path / "pub")
    inp = Inputs(spark, SF001)
    for write in Q.ALL:
        write(inp, source)
    extracts, base = E.Extracts(spark, source), checkpoint_base(spark).removeprefix("file:")
    extracts.loaded
    before = set(os.listdir(base))
    first = PB.rebuild(spark, extracts, root, "run1")
    assert set(os.listdir(base)) == before and extracts.quarantine.count() > 0
    assert first["published"] and first["parent"] == PB.FIRST and PB.current(spark, root).endswith("run1")
    maps = PB.read_published(spark, root, "map")
    assert maps.count() == inp.f_map.count()
    # Two rebuilds that started from run1: the first to publish wins, the other is refused.
    assert PB.publish(spark, root, "run2", "run1") and not PB.publish(spark, root, "run3", "run1")
    assert PB.chain(spark, root) == ["run1", "run2"]
    os.makedirs(os.path.join(root, "run2", "map"))
    os.makedirs(os.path.join(root, "run3"))
    assert PB.remove_runs(spark, root, keep=1) == ["run1", "run3"] and PB.current(spark, root).endswith("run2")
    assert PB.publish(spark, root, "run4", "run2") and PB.chain(spark, root)[-1] == "run4"
    with pytest.raises(FileNotFoundError):
        PB.current(spark, str(tmp_path / "none"))
