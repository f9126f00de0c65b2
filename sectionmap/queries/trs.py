"""Driver queries: legacy qq columns, the trs build, its reports and the
legacy XML export (C11, C12, P7, P11, Q3, Q9-Q11, Q18, A6, K4, S1, S2, J13)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sectionmap.plans import export as X
from sectionmap.plans import trs as TR
from sectionmap.plans.staging import Staging
from sectionmap.queries import query
from sectionmap.session import scratch_dir


def built_trs(st: Staging):
    return TR.build_trs(st.legacy_sections, st.qq_records, st.inp.f_sheet, st.maps, st.maptype)


@query
def qq_unpivot(spark, sf_dir):
    return TR.unpivot_qq(Staging(spark, sf_dir).inp.f_qq)


@query
def qq_cells_by_source(spark, sf_dir):
    st = Staging(spark, sf_dir)
    return TR.cells_by_source(st.inp.f_trs, st.source)


@query
def qq_sum_vs_or(spark, sf_dir):
    return TR.sum_vs_or(Staging(spark, sf_dir).inp.f_qq)


@query
def trs_build(spark, sf_dir):
    return built_trs(Staging(spark, sf_dir))


@query
def trs_sheet_parse(spark, sf_dir):
    st = Staging(spark, sf_dir)
    return TR.sheet_records(st.inp.f_sheet, st.maps, st.maptype)


@query
def trs_redundancy(spark, sf_dir):
    return TR.redundancy(Staging(spark, sf_dir).inp.f_trs)


@query
def trs_rollup(spark, sf_dir):
    return TR.rollup_sections(Staging(spark, sf_dir).inp.f_trs, [0, 1]).drop("_t", "_r")


@query
def trs_rollup_head(spark, sf_dir):
    """O2: the first 100 maps of every township and range in the rollup."""
    return TR.rollup_top(Staging(spark, sf_dir).inp.f_trs, [0, 1], n=100).drop("_t", "_r")


@query
def trs_extent(spark, sf_dir):
    return TR.extent(Staging(spark, sf_dir).inp.f_trs)


@query
def trs_range_checks(spark, sf_dir):
    return TR.range_checks(Staging(spark, sf_dir).inp.f_trs)


def _export(st: Staging, as_arrays: bool):
    qq = TR.unpivot_qq(st.inp.f_qq).withColumn("source_id", F.lit(1))
    return X.export_maps(st.maps, st.maptype, st.signed_by, st.surveyors, st.pdfs, qq,
                         X.section_list(st.inp.f_qq), as_arrays=as_arrays)


@query
def export_maps(spark, sf_dir):
    return _export(Staging(spark, sf_dir), as_arrays=False)


@query
def xml_roundtrip(spark, sf_dir):
    """K4 then S1/S2: write the map records as XML, read them back."""
    st = Staging(spark, sf_dir)
    path = scratch_dir(spark, "xml-maps")
    X.write_maps_xml(_export(st, as_arrays=True), path)
    back = X.read_maps_xml(spark, path)
    qq = [c for c in back.columns if c not in X.MAP_TAGS]
    return back.select(*X.MAP_TAGS, *[F.array_join(F.array_sort(c), ";").alias(c) for c in qq])


@query
def export_trs(spark, sf_dir):
    return X.export_trs(Staging(spark, sf_dir).inp.f_trs)


@query
def export_diff(spark, sf_dir):
    """Exported TRS records (legacy sections) against a legacy file that
    also carries the qq source."""
    trs = Staging(spark, sf_dir).inp.f_trs
    check = TR.rollup_sections(trs, [0, 1], unknown="0").select(
        F.col("map_id").alias("ID"), F.col("tshp").alias("TOWNSHIP"), F.col("rng").alias("RANGE"),
        F.col("sec").alias("SECTION"))
    return X.diff_records(X.export_trs(trs), check, ["ID", "TOWNSHIP", "RANGE"], "SECTION")
