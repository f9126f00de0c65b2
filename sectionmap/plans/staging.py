"""The staging tables of one build, derived lazily from the inputs.

Each property is a DataFrame; nothing runs until an action (the sequential
ids of workbook rows write their numbering when first built).
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from sectionmap.plans import cc as CC
from sectionmap.plans import files as FL
from sectionmap.plans import maps as MP
from sectionmap.plans import surveyors as SV
from sectionmap.sources import constants as C
from sectionmap.session import staged
from sectionmap.plans import trs as TR
from sectionmap.sources.extracts import Extracts
from sectionmap.sources.fixtures import Inputs


class Staging:
    """``source``: a folder of driver tables (derived inputs), or ``Extracts``."""

    def __init__(self, spark: SparkSession, source: str | Extracts):
        self.spark = spark
        self.inp = Inputs(spark, source) if isinstance(source, str) else source

    @cached_property
    def legacy_trs(self) -> DataFrame:
        """(map_id, township, range, ',1,2,3,') of the legacy extract; for the derived
        inputs the sections of all sources rolled up to such rows."""
        if isinstance(self.inp, Extracts):
            return self.inp.legacy_trs
        r = TR.rollup_sections(self.inp.f_trs, list(range(5)))
        return r.select("map_id", F.col("tshp").alias("township"), F.col("rng").alias("range"), F.col("sec").alias("section"))

    @cached_property
    def legacy_sections(self) -> DataFrame:
        """Source 0 of the trs table."""
        return TR.legacy_sections(self.inp.legacy_trs) if isinstance(self.inp, Extracts) else TR.sections_of(self.inp.f_trs)

    @cached_property
    def qq_records(self) -> DataFrame:
        if isinstance(self.inp, Extracts):
            return TR.qq_of_elements(self.inp.qq_elements)
        return TR.unpivot_qq(self.inp.f_qq)

    @cached_property
    def maptype(self) -> DataFrame:
        return C.maptype(self.spark)

    @cached_property
    def source(self) -> DataFrame:
        return C.source(self.spark)

    @cached_property
    def maps(self) -> DataFrame:
        i = self.inp
        return staged(MP.build_maps(i.f_legacy_map, i.f_sheet, i.f_pm, i.f_tract, self.maptype), "map")

    @cached_property
    def images(self) -> DataFrame:
        return staged(FL.link_files(self.inp.f_file, self.maps, self.maptype, "map"), "map_image")

    @cached_property
    def scans(self) -> DataFrame:
        return FL.link_files(self.inp.f_scan, self.maps, self.maptype, "scan")

    @cached_property
    def pdfs(self) -> DataFrame:
        return FL.link_files(self.inp.f_pdf, self.maps, self.maptype, "pdf", with_page=False)

    @cached_property
    def surveyors(self) -> DataFrame:
        return staged(SV.build_surveyors(self.inp.f_alias), "surveyor")

    @cached_property
    def signed_by(self) -> DataFrame:
        i = self.inp
        return staged(SV.signed_by(i.f_legacy_map, i.f_sheet, self.maps, self.maptype, i.f_alias, self.surveyors), "signed_by")

    @cached_property
    def cc(self) -> DataFrame:
        return staged(CC.link_cc_documents(self.inp.f_cc, self.maps, self.maptype), "cc")

    @cached_property
    def cc_images(self) -> DataFrame:
        return CC.link_cc_images(self.inp.f_cc_file, self.cc)
