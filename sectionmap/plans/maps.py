"""Map table: legacy extract + workbook rows, parcel / tract numbers appended to
the client, and the full-township abbreviation of descriptions (P2, J9, C19)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sectionmap.functions import full_township, number_suffix
from sectionmap.operators.ids import sequential_ids

MAP_COLUMNS = ["id", "maptype_id", "book", "page", "npages", "recdate", "client", "description", "note"]


def legacy_maps(legacy_map: DataFrame, maptype: DataFrame) -> DataFrame:
    """Legacy rows keep their ids; an unknown type leaves maptype_id NULL."""
    t = maptype.select(F.col("maptype").alias("_tname"), F.col("id").alias("maptype_id"))
    m = legacy_map.join(t, legacy_map["maptype"] == t["_tname"], "left")
    return m.select("id", "maptype_id", "book", F.col("firstpage").alias("page"),
                    (F.col("lastpage") - F.col("firstpage") + 1).alias("npages"), "recdate",
                    F.col("donefor").alias("client"), F.col("descript").alias("description"),
                    F.col("comment").alias("note"))


def sheet_maps(sheet: DataFrame, maptype: DataFrame, after: DataFrame) -> DataFrame:
    """Workbook rows with a known type (inner join); ids continue above the
    largest id of ``after`` in (maptype, book, page) order."""
    t = maptype.select(F.col("maptype").alias("_tname"), F.col("id").alias("maptype_id"))
    s = sheet.join(t, sheet["maptype"] == t["_tname"])
    start = after.select(F.coalesce(F.max("id"), F.lit(0))).scalar()
    s = sequential_ids(s, ["maptype", "book", "page"], start)
    return s.select("id", "maptype_id", "book", "page", "npages", "recdate", "client", "description", "note")


def number_suffixes(maps: DataFrame, maptype: DataFrame, sheets: list[tuple[DataFrame, str]]) -> DataFrame:
    """(map_id, suffix): every number of the parcel / tract workbooks as
    ' (PM12) AMENDED', concatenated in workbook order (sheet, then seq)."""
    t = maptype.select(F.col("id").alias("_tid"), F.col("maptype").alias("_tname"))
    mt = maps.select(F.col("id").alias("map_id"), "maptype_id", F.col("book").alias("_b"), F.col("page").alias("_p")) \
        .join(t, F.col("maptype_id") == F.col("_tid"))
    parts = None
    for order, (sheet, kind) in enumerate(sheets):
        s = sheet.select("maptype", "book", "page", number_suffix("pm", kind).alias("suffix"),
                         F.lit(order).alias("sheet"), "seq")
        parts = s if parts is None else parts.unionByName(s)
    j = parts.join(mt, (parts["book"] == mt["_b"]) & (parts["page"] == mt["_p"]) & (parts["maptype"] == mt["_tname"]))
    return j.groupBy("map_id").agg(
        F.expr("listagg(suffix, '') WITHIN GROUP (ORDER BY sheet, seq)").alias("suffix"))


def build_maps(legacy_map: DataFrame, sheet: DataFrame, pm: DataFrame, tract: DataFrame,
               maptype: DataFrame) -> DataFrame:
    """The map table of the index."""
    legacy = legacy_maps(legacy_map, maptype)
    maps = legacy.unionByName(sheet_maps(sheet, maptype, legacy))
    suffix = number_suffixes(maps, maptype, [(pm, "PM"), (tract, "TR")])
    maps = maps.join(suffix, maps["id"] == suffix["map_id"], "left")
    return maps.select(
        "id", "maptype_id", "book", "page", "npages", "recdate",
        F.when(F.col("suffix").isNull(), F.col("client")).otherwise(F.concat("client", "suffix")).alias("client"),
        full_township("description").alias("description"), "note")


def type_totals(legacy_map: DataFrame, sheet: DataFrame, maptype: DataFrame) -> DataFrame:
    """Q8: maps per type and in all, counted from the type column of the inputs: the map
    table holds every legacy row and the workbook rows of a known type."""
    known = maptype.select(F.col("maptype").alias("_t"))
    rows = legacy_map.select("maptype", F.lit(True).alias("_legacy")).unionByName(sheet.select("maptype", F.lit(False).alias("_legacy")))
    n = rows.groupBy("maptype").agg(F.count(F.lit(1)).alias("_n"), F.count(F.when(F.col("_legacy"), 1)).alias("_n_legacy"))
    n = n.join(known, n["maptype"] == known["_t"], "full_outer")
    per = n.where("_t IS NOT NULL").select(F.col("_t").alias("maptype"), F.coalesce("_n", F.lit(0)).alias("maps"))
    total = n.agg(F.coalesce(F.sum(F.when(F.col("_t").isNull(), F.col("_n_legacy")).otherwise(F.coalesce("_n", F.lit(0)))), F.lit(0)).alias("maps"))
    return per.unionByName(total.select(F.lit("Total Maps").alias("maptype"), "maps"))
