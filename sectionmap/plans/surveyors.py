"""Surveyors and signatures (P3), surveyor lists per map (Q12) and the name
audits (Q13-Q15, Q17, Q21)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sectionmap.functions import surveyor_display, surveyor_display_ws
from sectionmap.functions.names import full_name, initcap_words
from sectionmap.operators.ids import sequential_ids
from sectionmap.plans.files import map_keys

PARTS = ["firstname", "secondname", "thirdname", "lastname", "suffix", "pls", "rce"]


def build_surveyors(alias_sheet: DataFrame) -> DataFrame:
    """One surveyor per full name, fields of its first workbook row; ids in
    order of first appearance."""
    first = alias_sheet.groupBy("fullname").agg(
        F.min_by(F.struct(*PARTS), "row_no").alias("f"), F.min("row_no").alias("_first"))
    s = first.select("fullname", "f.*", "_first")
    return sequential_ids(s, ["_first"], F.lit(0)).drop("_first")


def alias_table(alias_sheet: DataFrame) -> DataFrame:
    """Legacy name -> full name (distinct pairs)."""
    return alias_sheet.select("legacy_name", "fullname").distinct()


def split_names(df: DataFrame, text: str, sep: str = r"\s*&\s*") -> DataFrame:
    return df.withColumn("legacy_name", F.explode(F.split(F.upper(F.col(text)), sep)))


def signed_by(legacy_map: DataFrame, sheet: DataFrame, maps: DataFrame, maptype: DataFrame,
              alias_sheet: DataFrame, surveyors: DataFrame) -> DataFrame:
    """(map_id, surveyor_id): legacy signatures plus workbook signatures; names
    without an alias give no row."""
    legacy = split_names(legacy_map.select(F.col("id").alias("map_id"), "surveyor"), "surveyor")
    mk = map_keys(maps, maptype)
    sh = sheet.join(mk, (sheet["maptype"] == mk["maptype_name"]) & (sheet["book"] == mk["book"])
                    & (sheet["page"] == mk["page"])).select("map_id", "surveyor")
    names = legacy.unionByName(split_names(sh, "surveyor"))
    s = surveyors.select(F.col("id").alias("surveyor_id"), "fullname")
    return (names.join(alias_table(alias_sheet), "legacy_name").join(s, "fullname")
            .select("map_id", "surveyor_id").distinct())


def unknown_names(legacy_map: DataFrame, alias_sheet: DataFrame) -> DataFrame:
    """Q15: legacy names (split on blank-padded '&') with no alias."""
    names = split_names(legacy_map, "surveyor", r"\s+&\s+").select("legacy_name")
    return names.join(alias_table(alias_sheet), "legacy_name", "left_anti").distinct()


def display_names(surveyors: DataFrame) -> DataFrame:
    cols = [F.col(c) for c in ("firstname", "secondname", "thirdname", "lastname", "suffix")]
    return surveyors.select(
        "id", "fullname", "lastname", "firstname", surveyor_display(*cols).alias("display"),
        surveyor_display_ws(*cols).alias("display_ws"),
        initcap_words(full_name(*cols)).alias("n1"), surveyor_display_ws(*cols).alias("n2"))


def surveyor_lists(maps: DataFrame, signatures: DataFrame, surveyors: DataFrame) -> DataFrame:
    """Q12: per map the signers' display names, in the order of the text
    "last name display name", joined by ' & ', or 'UNKNOWN'."""
    d = display_names(surveyors).select(F.col("id").alias("surveyor_id"), "display", F.concat_ws(" ", "lastname", "display").alias("sort_key"))
    j = maps.select(F.col("id").alias("map_id")).join(signatures, "map_id", "left").join(d, "surveyor_id", "left")
    agg = j.groupBy("map_id").agg(
        F.expr("listagg(display, ' & ') WITHIN GROUP (ORDER BY sort_key)").alias("surveyors"),
        F.count("surveyor_id").alias("n_signers"))
    return agg.select("map_id", F.coalesce("surveyors", F.lit("UNKNOWN")).alias("surveyors"), "n_signers")


def name_conflicts(alias_sheet: DataFrame, surveyors: DataFrame) -> DataFrame:
    """Q13, Q14, Q17: (kind, name, n) of the workbook's errors."""
    dup_alias = (alias_sheet.groupBy("legacy_name").agg(F.count(F.lit(1)).alias("n"))
                 .filter(F.col("n") > 1).select(F.lit("duplicate_alias").alias("kind"),
                                                F.col("legacy_name").alias("name"), "n"))
    conflict = (alias_sheet.select("fullname", *PARTS).distinct().groupBy("fullname")
                .agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
                .select(F.lit("conflicting_rows").alias("kind"), F.col("fullname").alias("name"), "n"))
    cols = [F.col(c) for c in ("firstname", "secondname", "thirdname", "lastname", "suffix")]
    bad = (surveyors.filter(F.col("fullname") != full_name(*cols))
           .select(F.lit("bad_fullname").alias("kind"), F.col("fullname").alias("name"), F.lit(1).cast("bigint").alias("n")))
    disp = (display_names(surveyors).groupBy("display").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
            .select(F.lit("duplicate_display").alias("kind"), F.col("display").alias("name"), "n"))
    return dup_alias.unionByName(conflict).unionByName(bad).unionByName(disp)


def name_cleanup(batch: DataFrame, surveyors: DataFrame) -> DataFrame:
    """A workbook name that is a capitalised full name is replaced by
    the initialled name; an initialled name is already canonical; else unknown."""
    d = display_names(surveyors)
    n1 = d.groupBy("n1").agg(F.max("n2").alias("new_value"))
    n2 = d.select(F.col("n2").alias("_canon")).distinct()
    b = batch.withColumn("_key", F.regexp_replace("surveyors", r"\s+\(.*", ""))
    j = b.join(n1, b["_key"] == n1["n1"], "left").join(n2, b["_key"] == n2["_canon"], "left")
    status = (F.when(F.col("n1").isNotNull(), "mapped").when(F.col("_canon").isNotNull(), "canonical")
              .otherwise("unknown"))
    return j.select("maptype", "book", "page", "surveyors", status.alias("status"),
                    F.when(F.col("n1").isNotNull(), F.col("new_value")).otherwise(F.col("surveyors")).alias("new_value"))
