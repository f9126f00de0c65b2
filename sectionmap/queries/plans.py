"""Driver queries: HTML records, image plans, the PDF manifest and the
constraint checks (X1-X4, Q16, Q23)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sectionmap.plans import checks as CK
from sectionmap.plans import html as H
from sectionmap.plans import images as IM
from sectionmap.plans.staging import Staging
from sectionmap.queries import query


@query
def html_records(spark, sf_dir):
    st = Staging(spark, sf_dir)
    signed = st.inp.f_legacy_map.select(F.col("id").alias("map_id"), "surveyor")
    return H.parse_records(H.listing_pages(st.maps, st.maptype, signed, st.pdfs))


@query
def page_headings(spark, sf_dir):
    return H.page_headings(Staging(spark, sf_dir).inp.pages)


@query
def frame_plan(spark, sf_dir):
    return IM.frame_plan(Staging(spark, sf_dir).inp.f_images).drop("width_px", "height_px")


@query
def resize_plan(spark, sf_dir):
    inp = Staging(spark, sf_dir).inp
    certificates = IM.cc_scans(inp.f_cc_scan)
    return IM.resize_plan(IM.frame_plan(inp.f_images).select(*certificates.columns).unionByName(certificates))


@query
def pdf_manifest(spark, sf_dir):
    st = Staging(spark, sf_dir)
    return IM.pdf_manifest(st.inp.f_file, st.inp.f_cc_odd, st.inp.f_cc_file, st.maptype)[0]


@query
def pdf_manifest_issues(spark, sf_dir):
    st = Staging(spark, sf_dir)
    return IM.pdf_manifest(st.inp.f_file, st.inp.f_cc_odd, st.inp.f_cc_file, st.maptype)[1]


@query
def constraint_checks(spark, sf_dir):
    st = Staging(spark, sf_dir)
    return CK.constraint_checks(st.inp.f_legacy_map, st.maptype, st.maps, st.surveyors, st.inp.f_alias,
                                st.signed_by, st.inp.f_trs, st.cc, st.cc_images)


@query
def broken_checks(spark, sf_dir):
    """Every rule on tables with rows that break it: repeated keys, references to nothing."""
    st = Staging(spark, sf_dir)
    maps, surveyors, signed, alias = st.maps, st.surveyors, st.signed_by, st.inp.f_alias
    maps = maps.unionByName(maps.where("id % 101 = 0")).where("id % 103 <> 0")
    surveyors = surveyors.where("id % 29 <> 0").unionByName(surveyors.where("id % 31 = 0"))
    signed = signed.unionByName(signed.where("map_id % 53 = 0"))
    cc = st.cc.where("cc_id % 17 <> 0")
    return CK.constraint_checks(st.inp.f_legacy_map, st.maptype, maps, surveyors, alias, signed, st.inp.f_trs, cc, st.cc_images)
