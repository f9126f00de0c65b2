"""Driver queries: staging from extracts and whole legacy XML documents (P1, P11,
P12, S1-S4, K3-K7, Q22).

The derived inputs are first written as a legacy system would hand them over
(XML with some bad records, CSV sheets, text listings) and then read back."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, functions as F

from sectionmap.plans import document as D
from sectionmap.plans import export as X
from sectionmap.plans import trs as TR
from sectionmap.plans.publish import PUBLISHED, read_published, rebuild
from sectionmap.plans.staging import Staging
from sectionmap.queries import query
from sectionmap.queries.index import _count, _labelled
from sectionmap.session import scratch_dir
from sectionmap.sources import io as IO
from sectionmap.sources.extracts import LISTINGS, SHEETS, Extracts
from sectionmap.sources.fixtures import Inputs

GENERATED = "2018-01-01T00:00:00Z"
#: Of the files handed over: the documents' text takes nine times the tables they are derived from.
PACKED = "gzip"
#: Map records of one packed file, which one task parses.
MAPS = 25_000


def _raw(df: DataFrame, n) -> DataFrame:
    none = F.lit(None).cast("string")
    return df.select("xml", n.cast("bigint").alias("_n"), none.alias("_t"), none.alias("_u"))


def write_map_xml(inp: Inputs, root: str) -> None:
    m = inp.f_legacy_map
    qq = [c for c in inp.f_qq.columns if c != "id"]
    rows = m.join(inp.f_qq.withColumnRenamed("id", "_id"), m["id"] == F.col("_id"), "left").select(
        F.col("id").alias("ID"), "maptype", F.col("book").alias("BOOK"), F.col("firstpage").alias("FIRSTPAGE"), F.col("lastpage").alias("LASTPAGE"),
        F.date_format("recdate", "yyyy-MM-dd'T'00:00:00").alias("RECDATE"), F.col("surveyor").alias("SURVEYOR"), F.col("donefor").alias("DONEFOR"),
        F.col("descript").alias("DESCRIP"), F.when(F.col("id") % 3 == 0, F.concat(F.lit("/old/"), F.col("id").cast("string"), F.lit(".tif"))).alias("Picture"),
        F.col("comment").alias("Comment"), *qq)
    D.write_document(inp.spark, [D.map_records(rows), _raw(inp.f_bad_map, F.col("id"))], os.path.join(root, "map.xml"), GENERATED, PACKED, MAPS)


def write_trs_xml(inp: Inputs, root: str) -> None:
    rows = Staging(inp.spark, inp.sf_dir).legacy_trs.select(
        F.col("map_id").alias("ID"), F.col("township").alias("TOWNSHIP"), F.col("range").alias("RANGE"), F.col("section").alias("SECTION"))
    D.write_document(inp.spark, [D.trs_records(rows), _raw(inp.f_bad_trs, F.col("id"))], os.path.join(root, "trs.xml"), GENERATED, PACKED)


def write_lists_xml(inp: Inputs, root: str) -> None:
    s = inp.f_surveyor.select("id", F.concat_ws(" ", "firstname", "secondname", "thirdname", "lastname", "suffix").alias("Surveyor"), "lastname")
    D.write_document(inp.spark, [D.records(s, "Surveyor", ["Surveyor", "lastname"], F.col("id"))], os.path.join(root, "surveyor.xml"), GENERATED, PACKED)
    codes = inp.f_section_code
    D.write_document(inp.spark, [D.records(codes, "SubSectionList", ["OrderCode", "subsection"], F.col("OrderCode"))],
                     os.path.join(root, "subsection.xml"), GENERATED, PACKED)


def write_sheets(inp: Inputs, root: str, listings: str = "none") -> None:
    for name in SHEETS:
        IO.write_report(getattr(inp, f"f_{name}"), os.path.join(root, "sheet", name), sep=",", compression=PACKED)
    for name in LISTINGS:
        getattr(inp, f"f_{name}").select(F.col("path").alias("value")).write.option("compression", listings).text(os.path.join(root, "listing", name))


def _extracts(spark, sf_dir: str, *writers) -> Extracts:
    root, inp = scratch_dir(spark, "extracts"), Inputs(spark, sf_dir)
    for write in writers:
        write(inp, root)
    return Extracts(spark, root)


DOCUMENTS = (write_map_xml, write_trs_xml, write_lists_xml)
ALL = (*DOCUMENTS, write_sheets)


def _all_extracts(spark, sf_dir: str, listings: str = "none") -> Extracts:
    """Every extract.  The documents are read before the rest is written: what their reading
    shuffles is gone by then."""
    e = _extracts(spark, sf_dir, *DOCUMENTS)
    e.loaded
    write_sheets(Inputs(spark, sf_dir), e.root, listings)
    return e


@query
def extract_maps(spark, sf_dir):
    """Map records of the legacy XML, the bad ones left out."""
    return _extracts(spark, sf_dir, write_map_xml).f_legacy_map


@query
def extract_sections(spark, sf_dir):
    """Open elements of the map records, found in the same parse, as sections."""
    return TR.qq_of_elements(_extracts(spark, sf_dir, write_map_xml).qq_elements)


@query
def extract_quarantine(spark, sf_dir):
    """Records put aside, with the key as written and the reasons."""
    return _extracts(spark, sf_dir, write_map_xml, write_trs_xml, write_lists_xml).quarantine.drop("record")


@query
def extract_lists(spark, sf_dir):
    """The surveyor and section lists."""
    e = _extracts(spark, sf_dir, write_lists_xml)
    return e.surveyors.good.select(F.lit("surveyor").alias("kind"), F.col("Surveyor").alias("name"), F.col("lastname").alias("value")).unionByName(
        e.subsections.good.select(F.lit("subsection").alias("kind"), F.col("subsection").alias("name"), F.col("OrderCode").cast("string").alias("value")))


@query
def extract_sheets(spark, sf_dir):
    """S3, K6: the map and certificate workbooks written with a header line and read back."""
    e = _extracts(spark, sf_dir, write_sheets)
    return e.f_sheet.select(F.lit("sheet").alias("kind"), "maptype", "book", "page", "npages", "recdate", "trs", F.lit(None).cast("string").alias("doc_number")).unionByName(
        e.f_cc.select(F.lit("cc").alias("kind"), "maptype", "book", "page", "npages", "recdate", F.lit(None).cast("string").alias("trs"), "doc_number"))


@query
def extract_listing(spark, sf_dir):
    """Every key of the listings."""
    e = _extracts(spark, sf_dir, write_sheets)
    first, *rest = [e.listing(n).select(F.lit(n).alias("listing"), "path") for n in LISTINGS]
    for df in rest:
        first = first.unionByName(df)
    return first


@query
def extract_manifest(spark, sf_dir):
    """What a folder of extracts holds: records read and put aside, listing bytes."""
    e = _all_extracts(spark, sf_dir)
    size = e.manifest().groupBy("extract").agg(F.sum("length").alias("bytes"))
    counts = None
    for name, x in e.loaded.items():
        part = x.good.agg(F.count(F.lit(1)).alias("good")).crossJoin(x.quarantine.agg(F.count(F.lit(1)).alias("aside"))).select(
            F.lit(f"{name}.xml").alias("extract"), "good", "aside")
        counts = part if counts is None else counts.unionByName(part)
    for n in LISTINGS:
        counts = counts.unionByName(e.listing(n).agg(F.count(F.lit(1)).alias("good")).select(F.lit(f"listing/{n}").alias("extract"), "good", F.lit(0).cast("bigint").alias("aside")))
    return counts.join(size, "extract").select("extract", "good", "aside", (F.col("bytes") > 0).alias("has_bytes"),
                                               F.when(F.col("extract").startswith("listing/"), F.col("bytes")).alias("listing_bytes"))


@query
def object_listing(spark, sf_dir):
    """S4 on stored objects: a folder tree with one object list a type and book, listed
    by name and length; contents are not read."""
    root = scratch_dir(spark, "objects")
    keys = Inputs(spark, sf_dir).f_file.select("path", F.regexp_extract("path", r"^/map/(..)/", 1).alias("type"), F.regexp_extract("path", r"^/map/../(\d+)/", 1).alias("book"))
    keys.select(F.col("path").alias("value"), "type", "book").repartition("type", "book").write.partitionBy("type", "book").text(root)
    found = IO.list_files(spark, root, "part-*", leading_slash_of=root)
    return found.groupBy(F.regexp_extract("path", r"type=([^/]+)/", 1).alias("type"), F.regexp_extract("path", r"book=([^/]+)/", 1).alias("book")).agg(
        F.sum("length").alias("bytes"))


@query
def scrape_sheet(spark, sf_dir):
    """K7: scraped map records written as a sheet with the eleven scrape columns, read back."""
    from sectionmap.queries.plans import html_records
    rows = html_records(spark, sf_dir).where("status = 'ok'")
    path = scratch_dir(spark, "scrape")
    IO.write_scrape(rows, path)
    return IO.read_sheet(spark, path, IO.SCRAPE_SCHEMA)


@query
def published_counts(spark, sf_dir):
    """A rebuild from extracts; the rows of every published table, read through the pointer."""
    e = _all_extracts(spark, sf_dir, PACKED)
    root = scratch_dir(spark, "published")
    report = rebuild(spark, e, root)
    if not report["published"]:
        raise RuntimeError(f"not published: {report['checks']}")
    return _labelled([(t, _count(read_published(spark, root, t), "records")) for t in PUBLISHED], "table", "records")


def _document(spark, sf_dir: str, *parts) -> str:
    path = scratch_dir(spark, "document.xml")
    D.write_document(spark, parts, path, GENERATED)
    return path


def _whole(spark, sf_dir: str) -> str:
    """Surveyors, a record for every map and the TRS records in one document."""
    st = Staging(spark, sf_dir)
    maps = X.export_maps(st.maps, st.maptype, st.signed_by, st.surveyors, st.pdfs, st.qq_records.withColumn("source_id", F.lit(1)), X.section_list(st.inp.f_qq))
    return _document(spark, sf_dir, D.surveyor_records(st.surveyors), D.map_records(maps), D.trs_records(X.export_trs(st.inp.f_trs)))


@query
def xml_document(spark, sf_dir):
    """The records of a whole document by kind, in their order in the file."""
    path = _whole(spark, sf_dir)
    rows = None
    for tag, field in (("Surveyor", "Surveyor"), ("map", "ID"), ("TRS", "ID")):
        part = IO.read_raw_records(spark, path, tag, [field]).select(F.lit(tag).alias("kind"), F.col(field).alias("key"), *IO.PLACE, "_unreadable")
        rows = part if rows is None else rows.unionByName(part)
    return rows.groupBy("kind").agg(
        F.count(F.lit(1)).alias("records"), F.count("_unreadable").alias("unreadable"),
        F.min_by("key", F.struct(*IO.PLACE)).alias("first_key"), F.max_by("key", F.struct(*IO.PLACE)).alias("last_key"))


@query
def xml_surveyors(spark, sf_dir):
    """Surveyor records of a document, numbered as they stand in it."""
    from sectionmap.operators.ids import sequential_ids
    st = Staging(spark, sf_dir)
    path = _document(spark, sf_dir, D.surveyor_records(st.surveyors), D.trs_records(X.export_trs(st.inp.f_trs)))
    rows = IO.read_raw_records(spark, path, "Surveyor", ["Surveyor", "lastname"])
    return sequential_ids(rows, IO.PLACE, F.lit(0), "pos").select("pos", "Surveyor", "lastname")


@query
def xml_trs(spark, sf_dir):
    """TRS records of a document that holds other kinds too."""
    st = Staging(spark, sf_dir)
    path = _document(spark, sf_dir, D.surveyor_records(st.surveyors), D.trs_records(X.export_trs(st.inp.f_trs)))
    rows = IO.read_raw_records(spark, path, "TRS", ["ID", "TOWNSHIP", "RANGE", "SECTION"])
    return rows.select(F.col("ID").try_cast("int").alias("ID"), "TOWNSHIP", "RANGE", "SECTION")


@query
def xml_diff(spark, sf_dir):
    """Q22: an exported document against a legacy one that also carries the qq source,
    lacks the records of some maps and repeats those of others."""
    inp = Inputs(spark, sf_dir)
    export = X.export_trs(inp.f_trs)
    legacy = TR.rollup_sections(inp.f_trs, [0, 1], unknown="0").select(
        F.col("map_id").alias("ID"), F.col("tshp").alias("TOWNSHIP"), F.col("rng").alias("RANGE"), F.col("sec").alias("SECTION"))
    legacy = legacy.where("ID % 13 <> 0")
    legacy = legacy.unionByName(legacy.where("ID % 11 = 0"))
    keys, value = ["ID", "TOWNSHIP", "RANGE"], "SECTION"
    read = lambda df: IO.read_raw_records(spark, _document(spark, sf_dir, D.trs_records(df)), "TRS", [*keys, value])
    diff = D.diff_documents(read(export), read(legacy), keys, value)
    return diff.withColumn("ID", F.col("ID").try_cast("int"))
