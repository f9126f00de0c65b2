"""Staging from a folder of extracts (P1): legacy XML files, workbook sheets as CSV
and object listings as text.

Layout of the folder: ``map.xml``, ``trs.xml``, ``surveyor.xml``, ``subsection.xml`` (XML
files or folders of their parts), ``sheet/<name>`` (CSV with one header line) and
``listing/<name>`` (one key a line).  Records are read as text, typed by ``load`` and,
when they cannot be, put aside with the reasons; nothing is dropped.
"""

from __future__ import annotations

import os
from functools import cached_property
from typing import NamedTuple, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sectionmap.functions.markup import child_elements, child_text, stray_text, without_comments
from sectionmap.session import scratch_dir, scratch_scope, staged
from sectionmap.sources import io as IO
from sectionmap.sources.io import read_raw_records, with_place

MAP_FIELDS = {"ID": "int", "maptype": "string", "BOOK": "int", "FIRSTPAGE": "int", "LASTPAGE": "int", "RECDATE": "date",
              "SURVEYOR": "string", "DONEFOR": "string", "DESCRIP": "string", "Picture": "string", "Comment": "string"}
TRS_FIELDS = {"ID": "int", "TOWNSHIP": "string", "RANGE": "string", "SECTION": "string"}
SURVEYOR_FIELDS = {"Surveyor": "string", "lastname": "string"}
SUBSECTION_FIELDS = {"OrderCode": "int", "subsection": "string"}
SHEETS = {
    "sheet": "maptype STRING, book INT, page INT, npages INT, recdate DATE, surveyor STRING, client STRING, description STRING, trs STRING, note STRING",
    "pm": "maptype STRING, book INT, page INT, pm STRING, note STRING, seq INT",
    "tract": "maptype STRING, book INT, page INT, pm STRING, note STRING, seq INT",
    "cc": "maptype STRING, book INT, page INT, recdate DATE, surveyor STRING, doc_number STRING, npages INT, src_id INT",
    "alias": "legacy_name STRING, fullname STRING, firstname STRING, secondname STRING, thirdname STRING, lastname STRING, suffix STRING, pls STRING, rce STRING, row_no INT",
}
LISTINGS = ("file", "scan", "pdf", "cc_file")


class Loaded(NamedTuple):
    good: DataFrame
    #: extract, the record's key as it is written, the reasons, the record's text
    quarantine: DataFrame


def read_map_records(spark: SparkSession, path: str) -> DataFrame:
    """Map records with all their elements, in one parse: the text is cut at the start tags,
    so names of elements that nobody declared come from the parsed rows (``_open``).
    Comments inside a record are removed; a record that a comment's end follows is unreadable."""
    pieces = spark.read.option("lineSep", "<map>").text(path)
    rows = pieces.select(F.explode(F.split(without_comments("value"), r"<map\s[^<>]*>", -1)).alias("_text"))
    # What stands before the first record of a file is no record.
    rows = rows.where(~F.col("_text").rlike(r"^\s*(?:<\?xml|<dataroot|\z)"))
    rows = rows.withColumn("_ended", F.col("_text").rlike(r"</map\s*>")).withColumn("_body", F.regexp_replace("_text", r"(?s)</map\s*>.*\z", ""))
    tags, texts = child_elements(F.col("_body"))
    rows = rows.withColumn("_tags", tags).withColumn("_texts", texts)
    unreadable = ~F.col("_ended") | F.col("_text").contains("-->") | (stray_text(F.col("_body")) != "")
    fixed = [t.lower() for t in MAP_FIELDS]
    return with_place(rows.select(
        *[child_text("_tags", "_texts", f).alias(f) for f in MAP_FIELDS], F.when(unreadable, F.col("_body")).alias("_unreadable"),
        F.filter(F.arrays_zip(F.col("_tags").alias("tag"), F.col("_texts").alias("text")), lambda e: ~F.lower(e["tag"]).isin(fixed)).alias("_open")))


def _typed(field: str, kind: str) -> Column:
    return F.col(f"`{field}`") if kind == "string" else F.trim(F.col(f"`{field}`")).try_cast(kind)


def _first_only(found: DataFrame, key: str, value: Column) -> DataFrame:
    """The good records whose key an earlier good one has get a reason."""
    place = F.struct(*IO.PLACE)
    # Records that have a reason already keep it; without a key, they would all meet in one task of the join.
    ok, bad = found.where(F.size("_reasons") == 0), found.where(F.size("_reasons") > 0)
    # Repeated keys only: the join's right side is as small as the fault.
    first = ok.groupBy(value.alias("_key")).agg(F.min(place).alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    keyed = ok.withColumn("_k", value)
    later = F.col("_first").isNotNull() & (place != F.col("_first"))
    return bad.unionByName(keyed.join(first, keyed["_k"] == first["_key"], "left").withColumn(
        "_reasons", F.when(later, F.array(F.lit(f"repeated {key}"))).otherwise(F.col("_reasons"))).drop("_k", "_key", "_first"))


def load(rows: DataFrame, extract: str, fields: dict[str, str], required: Sequence[str], key: str | None = None) -> Loaded:
    """Typed records and the quarantine of a parsed extract (written with their reasons, so that
    readers neither parse nor look for repeated keys again).

    Reasons: 'unreadable', 'missing X' (required), 'bad X' (text that is no value of the
    declared type) and 'repeated X' (the key of an earlier good record: the first one in
    the order of the files stays)."""
    reasons = [F.when(F.col("_unreadable").isNotNull(), "unreadable")]
    readable = F.col("_unreadable").isNull()
    reasons += [F.when(readable & F.col(f"`{f}`").isNull(), f"missing {f}") for f in required]
    reasons += [F.when(readable & F.col(f"`{f}`").isNotNull() & _typed(f, k).isNull(), f"bad {f}") for f, k in fields.items() if k != "string"]
    path = scratch_dir(rows.sparkSession, extract)
    found = rows.withColumn("_reasons", F.array_compact(F.array(*reasons)))
    with scratch_scope(rows.sparkSession):
        if key is not None:
            found = _first_only(staged(found, f"{extract}-read"), key, _typed(key, fields[key]))
        found = staged(found, extract, path)
    others = [c for c in rows.columns if c not in fields and c != "_unreadable"]
    good = found.where(F.size("_reasons") == 0).select(*[_typed(f, k).alias(f) for f, k in fields.items()], *others)
    bad = found.where(F.size("_reasons") > 0).select(
        F.lit(extract).alias("extract"), (F.col(f"`{key}`") if key else F.lit(None).cast("string")).alias("record_key"),
        F.array_join("_reasons", ", ").alias("reasons"),
        F.coalesce(F.col("_unreadable"), F.to_json(F.struct(*[f"`{f}`" for f in fields]))).alias("record"))
    return Loaded(good, bad)


class Extracts:
    """The inputs of a build, read from a folder; the same names as the derived inputs."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def _path(self, *names: str) -> str:
        return os.path.join(self.root, *names)

    @cached_property
    def maps(self) -> Loaded:
        return load(read_map_records(self.spark, self._path("map.xml")), "map", MAP_FIELDS, ["ID"], "ID")

    @cached_property
    def trs(self) -> Loaded:
        rows = read_raw_records(self.spark, self._path("trs.xml"), "TRS", list(TRS_FIELDS))
        return load(rows, "trs", TRS_FIELDS, list(TRS_FIELDS))

    @cached_property
    def surveyors(self) -> Loaded:
        rows = read_raw_records(self.spark, self._path("surveyor.xml"), "Surveyor", list(SURVEYOR_FIELDS))
        return load(rows, "surveyor", SURVEYOR_FIELDS, list(SURVEYOR_FIELDS))

    @cached_property
    def subsections(self) -> Loaded:
        rows = read_raw_records(self.spark, self._path("subsection.xml"), "SubSectionList", list(SUBSECTION_FIELDS))
        return load(rows, "subsection", SUBSECTION_FIELDS, list(SUBSECTION_FIELDS))

    @property
    def loaded(self) -> dict[str, Loaded]:
        return {"map": self.maps, "trs": self.trs, "surveyor": self.surveyors, "subsection": self.subsections}

    @property
    def quarantine(self) -> DataFrame:
        """Every record that was put aside, of all XML extracts."""
        first, *rest = [x.quarantine for x in self.loaded.values()]
        for df in rest:
            first = first.unionByName(df)
        return first

    def sheet(self, name: str) -> DataFrame:
        return IO.read_sheet(self.spark, self._path("sheet", name), SHEETS[name])

    def listing(self, name: str) -> DataFrame:
        return IO.read_listing(self.spark, self._path("listing", name))

    def manifest(self) -> DataFrame:
        """(extract, path, length, modified) of every file of the folder; contents are not read."""
        files = (self.spark.read.format("binaryFile").option("recursiveFileLookup", True).load(self.root)
                 .select("path", "length", F.col("modificationTime").alias("modified")))
        name = F.regexp_extract("path", r"/(sheet/\w+|listing/\w+|\w+\.xml)(?:/[^/]*)?\z", 1)
        return files.select(name.alias("extract"), "path", "length", "modified").where("extract <> ''")

    @property
    def f_legacy_map(self) -> DataFrame:
        return self.maps.good.select(
            F.col("ID").alias("id"), "maptype", F.col("BOOK").alias("book"), F.col("FIRSTPAGE").alias("firstpage"),
            F.col("LASTPAGE").alias("lastpage"), F.col("RECDATE").alias("recdate"), F.col("SURVEYOR").alias("surveyor"),
            F.col("DONEFOR").alias("donefor"), F.col("DESCRIP").alias("descript"), F.col("Picture").alias("image"), F.col("Comment").alias("comment"))

    @property
    def qq_elements(self) -> DataFrame:
        """(map_id, tag, qq) of the open elements of the map records."""
        return self.maps.good.select(F.col("ID").alias("map_id"), F.explode("_open").alias("e")).select("map_id", "e.tag", F.col("e.text").alias("qq"))

    @property
    def legacy_trs(self) -> DataFrame:
        return self.trs.good.select(F.col("ID").alias("map_id"), F.col("TOWNSHIP").alias("township"), F.col("RANGE").alias("range"),
                                    F.col("SECTION").alias("section"))

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("f_") and name[2:] in SHEETS:
            return self.sheet(name[2:])
        if name.startswith("f_") and name[2:] in LISTINGS:
            return self.listing(name[2:])
        raise AttributeError(name)


