"""Legacy XML export (P11, K4) and its check against a legacy file."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sectionmap import constants as K
from sectionmap.functions import legacy_qq_list, range_number, township_number
from sectionmap.plans.files import map_keys
from sectionmap.plans.surveyors import surveyor_lists
from sectionmap.plans.trs import FIXED_TAGS, rollup_sections
from sectionmap.session import staged
from sectionmap.sources.extracts import read_map_records

# Element names of a legacy map record, in export order.
MAP_TAGS = ["ID", "maptype", "BOOK", "FIRSTPAGE", "LASTPAGE", "RECDATE", "SURVEYOR", "DONEFOR", "DESCRIP", "Picture"]
XML_OPTIONS = {"rootTag": "dataroot", "attributePrefix": "@attr@", "valueTag": "@value@"}


def section_tag(code: str) -> str:
    """'05N1W26' -> '_x0030_5N1W26' (an element name cannot start with a digit)."""
    return f"_x{ord(code[0]):04x}_{code[1:]}" if code[0].isdigit() else code


def section_code(tag: str) -> str:
    """Inverse of ``section_tag``."""
    if tag.startswith("_x") and len(tag) > 7 and tag[6] == "_":
        return chr(int(tag[2:6], 16)) + tag[7:]
    return tag


def section_list(qq_wide: DataFrame) -> list[str]:
    """Section codes named by the wide qq columns (schema metadata only)."""
    return [section_code(c) for c in qq_wide.columns if c.lower() not in FIXED_TAGS]


def qq_elements(trs: DataFrame, sections: list[str]) -> DataFrame:
    """(map_id, tag, qq) for every legacy qq record (source 1) in a listed
    section; one join to the section list instead of one query per section."""
    spark = trs.sparkSession
    sec = spark.createDataFrame([(c, section_tag(c)) for c in sections], "code STRING, tag STRING")
    sec = sec.select(
        "tag", township_number(F.substring("code", 1, 3)).alias("_t"),
        range_number(F.substring("code", 4, 2)).alias("_r"), F.substring("code", 6, 2).try_cast("int").alias("_s"))
    q = trs.filter(F.col("source_id") == K.SOURCE_LEGACY_SUBSECTION)
    # The list is as long as the wide table has columns: without the hint both sides are
    # shuffled on the section, one task a listed section.
    j = q.join(F.broadcast(sec), (q["tshp"] == sec["_t"]) & (q["rng"] == sec["_r"]) & (q["sec"] == sec["_s"]))
    return j.select("map_id", "tag", legacy_qq_list("subsec").alias("qq"))


def export_maps(maps: DataFrame, maptype: DataFrame, signatures: DataFrame, surveyors: DataFrame,
                pdfs: DataFrame, trs: DataFrame, sections: list[str], as_arrays: bool = True) -> DataFrame:
    """Legacy map records: fixed fields (NULL = element omitted) plus one
    column per listed section holding the qq lists of the map (an array: one
    element per record, written as repeated elements)."""
    names = surveyor_lists(maps, signatures, surveyors).select("map_id", "surveyors")
    pdf = pdfs.filter(F.col("map_id").isNotNull()).groupBy("map_id").agg(F.max("path").alias("pdffile"))
    m = map_keys(maps, maptype).join(names, "map_id", "left").join(pdf, "map_id", "left")
    base = m.select(
        F.col("map_id").alias("ID"), F.col("maptype_name").alias("maptype"), F.col("book").alias("BOOK"),
        F.col("page").alias("FIRSTPAGE"), (F.col("page") + F.col("npages") - 1).alias("LASTPAGE"),
        F.date_format("recdate", "yyyy-MM-dd'T'00:00:00").alias("RECDATE"), F.col("surveyors").alias("SURVEYOR"),
        F.col("client").alias("DONEFOR"), F.col("description").alias("DESCRIP"), F.col("pdffile").alias("Picture"))
    tags = [section_tag(c) for c in sections]
    qq = qq_elements(trs, sections)
    wide = qq.groupBy("map_id").pivot("tag", tags).agg(F.array_sort(F.collect_list("qq")))
    # A section without records of the map has no element (NULL, not []).
    wide = wide.select("map_id", *[F.when(F.size(t) > 0, F.col(t)).alias(t) for t in tags])
    out = base.join(wide, base["ID"] == wide["map_id"], "left").drop("map_id")
    if not as_arrays:
        out = out.select(*MAP_TAGS, *[F.array_join(t, ";").alias(t) for t in tags])
    return out


def write_maps_xml(records: DataFrame, path: str) -> None:
    """K4: one XML document of <map> records; NULL fields are omitted and an
    array column becomes repeated elements."""
    records.write.mode("overwrite").format("xml").options(rowTag="map", **XML_OPTIONS).save(path)


def read_maps_xml(spark, path: str, qq_columns: list[str] | None = None) -> DataFrame:
    """S1 + S2: typed fixed fields and the open-ended qq elements as arrays of text.  The
    file is parsed once into a table; without a list of the elements, their names are
    those of the parsed rows (as many as there are sections)."""
    rows = staged(read_map_records(spark, path), "map-records")
    if qq_columns is None:
        names = rows.select(F.explode("_open").alias("e")).select("e.tag").distinct().collect()
        qq_columns = [r["tag"] for r in names]
    fixed = [F.col(t).try_cast("int").alias(t) if t in ("ID", "BOOK", "FIRSTPAGE", "LASTPAGE") else F.col(t) for t in MAP_TAGS]

    def texts(tag: str):
        found = F.transform(F.filter("_open", lambda e: e["tag"] == tag), lambda e: e["text"])
        return F.when(F.size(found) > 0, found).alias(tag)

    return rows.where("_unreadable IS NULL").select(*fixed, *[texts(c) for c in sorted(qq_columns)])


def export_trs(trs: DataFrame) -> DataFrame:
    """Legacy TRS records of the legacy section source; an unknown township or
    range is written as '0'."""
    r = rollup_sections(trs, [K.SOURCE_LEGACY_SECTION], unknown="0")
    return r.select(F.col("map_id").alias("ID"), F.col("tshp").alias("TOWNSHIP"), F.col("rng").alias("RANGE"),
                    F.col("sec").alias("SECTION"))


def diff_records(exported: DataFrame, check: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Compare two record sets by key: 'missing' (only in check),
    'extra' (only exported), 'changed' or 'same'.  NULL equals NULL, in keys and
    in values."""
    a = exported.select(*[F.col(k).alias(f"_a_{k}") for k in keys], F.col(value).alias("export_value"), F.lit(True).alias("_a"))
    b = check.select(*[F.col(k).alias(f"_b_{k}") for k in keys], F.col(value).alias("check_value"), F.lit(True).alias("_b"))
    j = a.join(b, [F.col(f"_a_{k}").eqNullSafe(F.col(f"_b_{k}")) for k in keys], "full_outer")
    status = (F.when(F.col("_a").isNull(), "missing").when(F.col("_b").isNull(), "extra")
              .when(F.col("export_value").eqNullSafe(F.col("check_value")), "same").otherwise("changed"))
    return j.select(*[F.coalesce(f"_a_{k}", f"_b_{k}").alias(k) for k in keys], status.alias("status"), "export_value", "check_value")
