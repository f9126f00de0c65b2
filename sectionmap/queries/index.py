"""Driver queries: maps, files, certificates of correction, surveyors and the
totals report (P2-P5, J4, J9, C19, C20, Q1, Q2, Q4, Q7, Q8, Q12-Q15, Q17,
Q19, Q21, W3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sectionmap import constants as K
from sectionmap.functions import full_township, number_from_client, tract_from_client
from sectionmap.operators.intervals import interval_join, interval_join_exploded, overlaps
from sectionmap.plans import cc as CC
from sectionmap.plans import files as FL
from sectionmap.plans import maps as MP
from sectionmap.plans import surveyors as SV
from sectionmap.plans.staging import Staging
from sectionmap.queries import query
from sectionmap.session import scratch_dir
from sectionmap.sources import io as IO


def _labelled(rows: list[tuple[str, DataFrame]], label: str, value: str) -> DataFrame:
    out = None
    for name, df in rows:
        part = df.select(F.lit(name).alias(label), F.col(value).cast("bigint").alias(value))
        out = part if out is None else out.unionByName(part)
    return out


def _count(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


# ---- maps -------------------------------------------------------------------

@query
def map_build(spark, sf_dir):
    return Staging(spark, sf_dir).maps


def _maps_before_numbers(st: Staging) -> DataFrame:
    legacy = MP.legacy_maps(st.inp.f_legacy_map, st.maptype)
    return legacy.unionByName(MP.sheet_maps(st.inp.f_sheet, st.maptype, legacy))


@query
def parcel_numbers(spark, sf_dir):
    st = Staging(spark, sf_dir)
    return MP.number_suffixes(_maps_before_numbers(st), st.maptype, [(st.inp.f_pm, "PM")])


@query
def tract_numbers(spark, sf_dir):
    st = Staging(spark, sf_dir)
    return MP.number_suffixes(_maps_before_numbers(st), st.maptype, [(st.inp.f_tract, "TR")])


@query
def number_reports(spark, sf_dir):
    """Q7: parcel numbers of PM maps; tract numbers of RM maps that have one."""
    st = Staging(spark, sf_dir)
    m = FL.map_keys(st.maps, st.maptype)
    pm = m.filter(F.col("abbrev") == "PM").select(
        F.lit("PM").alias("kind"), F.col("maptype_name").alias("maptype"), "book", "page",
        number_from_client("client", "PM").alias("number"))
    tr = m.filter((F.col("abbrev") == "RM") & F.col("client").rlike(r"(?i)(TR\d+)")).select(
        F.lit("TR").alias("kind"), F.col("maptype_name").alias("maptype"), "book", "page",
        tract_from_client("client").alias("number"))
    return pm.unionByName(tr)


@query
def full_township_descriptions(spark, sf_dir):
    st = Staging(spark, sf_dir)
    m = _maps_before_numbers(st).filter(F.col("description").rlike(K.FULL_TOWNSHIP))
    return m.select("id", full_township("description").alias("description"))


def _lookups(st: Staging):
    """Page lookups of each listed image: (type, book, page of the image)."""
    p = F.col("path")
    from sectionmap.functions._util import group
    pts = st.inp.f_file.select(
        "path", F.upper(group(p, FL.ABBREV, 1)).alias("abbrev"), group(p, FL.BOOK, 1).try_cast("int").alias("book"),
        (group(p, FL.PAGE, 1).try_cast("int") + group(p, FL.IMAGE, 1).try_cast("int") - 1).alias("lookup_page"))
    iv = st.inp.f_map.select(F.col("id").alias("map_id"), "abbrev", "book", "page", "npages")
    return pts, iv


@query
def map_page_lookup(spark, sf_dir):
    """The map whose page range holds each image page (bucketed range join)."""
    pts, iv = _lookups(Staging(spark, sf_dir))
    j = interval_join(pts, iv, ["abbrev", "book"], "lookup_page", "page", "npages")
    return j.groupBy("path").agg(F.min("map_id").alias("map_id"))


@query
def map_page_lookup_exploded(spark, sf_dir):
    """J4, per-page explode variant (pure equi join)."""
    pts, iv = _lookups(Staging(spark, sf_dir))
    j = interval_join_exploded(pts, iv, ["abbrev", "book"], "lookup_page", "page", "npages")
    return j.groupBy("path").agg(F.min("map_id").alias("map_id"))


@query
def map_page_overlaps(spark, sf_dir):
    """Maps that begin on a page which an earlier map of the book covers."""
    iv = Staging(spark, sf_dir).inp.f_long_map.withColumnRenamed("id", "map_id")
    return overlaps(iv, ["abbrev", "book"], "page", "npages", ["map_id"])


# ---- files ------------------------------------------------------------------

@query
def files_to_maps(spark, sf_dir):
    st = Staging(spark, sf_dir)
    return st.images.unionByName(st.scans).unionByName(st.pdfs)


@query
def files_not_indexed(spark, sf_dir):
    return FL.not_indexed(Staging(spark, sf_dir).images)


@query
def contiguous_pages(spark, sf_dir):
    imgs = Staging(spark, sf_dir).images.filter(F.col("map_id").isNotNull())
    return FL.contiguous_pages(imgs.select("map_id", "page"))


@query
def image_coverage(spark, sf_dir):
    return _coverage(Staging(spark, sf_dir))[0]


def _coverage(st):
    return FL.coverage(st.inp.f_batch, st.maps, st.maptype, st.images, st.pdfs, st.inp.f_object)


@query
def missing_images(spark, sf_dir):
    return _coverage(Staging(spark, sf_dir))[1]


@query
def missing_pdfs(spark, sf_dir):
    return _coverage(Staging(spark, sf_dir))[2]


@query
def sheet_write_back(spark, sf_dir):
    """K8: cleaned surveyor, map id, image and PDF counts written into the
    workbook sheet, which is then read back (S3)."""
    st = Staging(spark, sf_dir)
    sheet = SV.name_cleanup(st.inp.f_batch, st.surveyors).select("maptype", "book", "page", F.col("new_value").alias("surveyors"))
    found = _coverage(st)[0].select("maptype", "book", "page", "map_id", "sheet_images", "sheet_pdfs")
    path = scratch_dir(spark, "sheet")
    out = IO.write_back(sheet, found, ["maptype", "book", "page"], path)
    return IO.read_sheet(spark, path, out.schema)


# ---- certificates of correction ----------------------------------------------

@query
def cc_load(spark, sf_dir):
    return Staging(spark, sf_dir).cc


@query
def cc_images(spark, sf_dir):
    return Staging(spark, sf_dir).cc_images


@query
def cc_npages_mismatch(spark, sf_dir):
    st = Staging(spark, sf_dir)
    return CC.npages_mismatch(st.cc, st.cc_images)


@query
def cc_missing(spark, sf_dir):
    st = Staging(spark, sf_dir)
    return CC.missing_images(st.cc, st.cc_images, st.maps, st.maptype)


# ---- surveyors ----------------------------------------------------------------

@query
def signed_by(spark, sf_dir):
    return Staging(spark, sf_dir).signed_by


@query
def unknown_surveyors(spark, sf_dir):
    st = Staging(spark, sf_dir)
    return SV.unknown_names(st.inp.f_legacy_map, st.inp.f_alias)


@query
def surveyor_lists(spark, sf_dir):
    st = Staging(spark, sf_dir)
    return SV.surveyor_lists(st.maps, st.signed_by, st.surveyors)


@query
def multi_signer_maps(spark, sf_dir):
    """Maps signed by more than one surveyor, with their list."""
    st = Staging(spark, sf_dir)
    return SV.surveyor_lists(st.maps, st.signed_by, st.surveyors).filter(F.col("n_signers") > 1)


@query
def surveyor_display(spark, sf_dir):
    return SV.display_names(Staging(spark, sf_dir).surveyors).drop("lastname", "firstname")


@query
def alias_conflicts(spark, sf_dir):
    st = Staging(spark, sf_dir)
    return SV.name_conflicts(st.inp.f_alias, st.surveyors)


@query
def name_cleanup(spark, sf_dir):
    st = Staging(spark, sf_dir)
    return SV.name_cleanup(st.inp.f_batch, st.surveyors)


# ---- totals (Q8) -----------------------------------------------------------------

@query
def map_totals(spark, sf_dir):
    st = Staging(spark, sf_dir)
    return MP.type_totals(st.inp.f_legacy_map, st.inp.f_sheet, st.maptype)


@query
def trs_totals(spark, sf_dir):
    st = Staging(spark, sf_dir)
    trs = st.inp.f_trs
    # Counted before the join: one row a source and task, whatever the table holds.
    n = trs.groupBy("source_id").agg(F.count("map_id").alias("n"))
    per = st.source.join(n, n["source_id"] == st.source["id"], "left").groupBy("id", "description").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("records"))
    total = trs.agg(F.count(F.lit(1)).alias("records")).select(F.lit("Total TRS Records").alias("source"), "records")
    return per.select(F.col("description").alias("source"), "records").unionByName(total)


@query
def signature_totals(spark, sf_dir):
    st = Staging(spark, sf_dir)
    return _labelled([("Surveyors", _count(st.surveyors, "records")),
                      ("Signed By", _count(st.signed_by, "records"))], "table", "records")


@query
def cc_totals(spark, sf_dir):
    st = Staging(spark, sf_dir)
    have = st.cc_images.filter(F.col("cc_id").isNotNull()).select("cc_id").distinct()
    flagged = st.cc.join(have.withColumn("_has", F.lit(True)), "cc_id", "left")
    without = flagged.filter(F.col("_has").isNull()).agg(F.count_distinct("cc_id").alias("records"))
    with_ = flagged.filter(F.col("_has").isNotNull()).agg(F.count_distinct("cc_id").alias("records"))
    return _labelled([("Without Image Files", without), ("With Image Files", with_),
                      ("Total", _count(st.cc, "records"))], "ccs", "records")


@query
def file_totals(spark, sf_dir):
    st = Staging(spark, sf_dir)
    return _labelled([("Map Images", _count(st.images, "n")), ("Scan Images", _count(st.scans, "n")),
                      ("PDF Files", _count(st.pdfs, "n"))], "image_files", "n")
