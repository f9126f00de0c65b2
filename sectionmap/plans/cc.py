"""Certificates of correction: the workbook linked to maps (J8), the image
listing linked to documents (C16, A4) and their audits (Q1, Q2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sectionmap.functions import cc_doc_basename, cc_doc_number
from sectionmap.functions._util import group
from sectionmap.operators.ids import sequential_ids
from sectionmap.plans.files import map_keys


def link_cc_documents(cc_sheet: DataFrame, maps: DataFrame, maptype: DataFrame) -> DataFrame:
    """cc rows with the map matched on type name, book, page and record date
    (a NULL or different date leaves map_id NULL).  Ids follow doc_number."""
    mk = map_keys(maps, maptype).select("map_id", F.col("maptype_name").alias("_t"), F.col("book").alias("_b"),
                                        F.col("page").alias("_p"), F.col("recdate").alias("_d"))
    j = cc_sheet.join(mk, (cc_sheet["maptype"] == mk["_t"]) & (cc_sheet["book"] == mk["_b"])
                      & (cc_sheet["page"] == mk["_p"]) & (cc_sheet["recdate"] == mk["_d"]), "left")
    j = j.select("map_id", "doc_number", "npages")
    j = sequential_ids(j, ["doc_number"], F.lit(0), "cc_id")
    return j.select("cc_id", "map_id", "doc_number", "npages", cc_doc_basename("doc_number").alias("doc_base"))


def cc_image_files(listing: DataFrame) -> DataFrame:
    """(doc_number, page, imagefile) of each listed cc image.

    New-style numbers need the document's page count, i.e. the largest page
    seen for the same base name: an aggregate joined back (skew-split by AQE),
    not a per-name buffer.  The stored file name gets its leading '/'.
    """
    p = F.col("path")
    f = listing.select(p, group(p, r".*/(.*)-(\d{3,})", 1).alias("base"),
                       group(p, r".*/(.*)-(\d{3,})", 2).try_cast("int").alias("_pg"),
                       F.element_at(F.split(p, "/"), -1).alias("fname"))
    mx = f.groupBy("base").agg(F.max("_pg").alias("max_page"))
    f = f.join(mx, "base", "left")
    page = F.regexp_replace(F.element_at(F.split(F.regexp_replace("fname", r"\.jpg\z", ""), "-"), 4), "^0+", "")
    return f.select(cc_doc_number("fname", "max_page").alias("doc_number"),
                    page.try_cast("int").alias("page"), F.concat(F.lit("/"), p).alias("imagefile"))


def link_cc_images(listing: DataFrame, cc: DataFrame) -> DataFrame:
    files = cc_image_files(listing)
    c = cc.select("cc_id", F.col("doc_number").alias("_doc"))
    return files.join(c, files["doc_number"] == c["_doc"], "left").select("cc_id", "page", "imagefile")


def npages_mismatch(cc: DataFrame, images: DataFrame) -> DataFrame:
    """Q1: images of documents whose workbook page count differs from the
    largest page found."""
    mx = images.groupBy("cc_id").agg(F.max("page").alias("pages"))
    j = (cc.join(images, "cc_id", "left").join(mx, "cc_id", "left")
         .filter(F.col("npages") != F.col("pages")))
    return j.select("map_id", "doc_number", F.col("npages").alias("cc_pages"), "pages", "imagefile")


def missing_images(cc: DataFrame, images: DataFrame, maps: DataFrame, maptype: DataFrame) -> DataFrame:
    """Q2: documents of known maps with no image file."""
    mk = map_keys(maps, maptype)
    have = images.filter(F.col("cc_id").isNotNull()).select("cc_id").distinct()
    return (cc.join(have, "cc_id", "left_anti").join(mk, "map_id")
            .select(F.col("maptype_name").alias("maptype"), "book", "page", "doc_number"))
