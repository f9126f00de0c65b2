"""Image planning as Spark jobs over image metadata (X1, X2) and the PDF page
manifest of each map (X4).  The pixel work itself (TIFF frames, JPEG
resizing, PDF assembly) is outside Spark; these jobs plan it."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sectionmap import constants as K
from sectionmap.functions import cc_doc_basename
from sectionmap.functions._util import group, pad
from sectionmap.functions.names import file_name
from sectionmap.operators.ordered import running


def frame_plan(frames: DataFrame) -> DataFrame:
    """Per scanned frame the effective dpi (an unset 96 dpi header means
    200), the size in hundredths of an inch, whether a narrow frame of a
    recorded map is a certificate of correction, and its target file."""
    book = F.regexp_extract("src_file", r"^(\d+)(\D+)", 1)
    mtype = F.regexp_extract("src_file", r"^(\d+)(\D+)", 2)
    dpi = F.when(F.col("dpi") == 96, F.lit(K.DEFAULT_SCAN_DPI)).otherwise(F.col("dpi"))
    f = frames.select("src_file", "frame", "width_px", "height_px", "mode", book.alias("book"),
                      mtype.alias("maptype"), dpi.alias("scan_dpi"))
    is_cc = (F.upper("maptype").isin(*K.RECORDED_TYPES)
             & (F.least("width_px", "height_px") * 100 < F.col("scan_dpi") * K.CC_MIN_WIDTH_HUNDREDTHS))
    dest = F.concat(F.regexp_replace("src_file", r"\.tif\z", ""), F.lit("-"),
                    pad("frame"), F.lit(".tif"))
    return f.select(
        "src_file", "frame", "scan_dpi",
        F.expr("(width_px * 100) div scan_dpi").alias("width_in_x100"),
        F.expr("(height_px * 100) div scan_dpi").alias("height_in_x100"),
        is_cc.alias("is_cc"),
        F.when(is_cc, F.lit("cc")).otherwise(F.concat("maptype", F.lit("/"), "book")).alias("dest_dir"),
        dest.alias("dest_file"), F.when(F.col("mode") == "P", "RGB").otherwise(F.col("mode")).alias("mode"),
        # O3: frames are processed in (type, book, page) order of their names.
        F.regexp_replace("src_file", r"^\D*(\d{3,})(\D{2})(\d{3,}).*$", "$2$1$3").alias("sort_key"),
        "width_px", "height_px")


def cc_scans(scans: DataFrame) -> DataFrame:
    """Scanned certificate pages as plan rows: kept under their own (lower case) names."""
    return scans.select(F.lower("src_file").alias("dest_file"), F.lit(True).alias("is_cc"), F.lit("cc").alias("dest_dir"),
                        F.col("dpi").alias("scan_dpi"), "width_px", "height_px", "mode")


def resize_plan(plan: DataFrame) -> DataFrame:
    """Map images are written at min(160, scan dpi) with sizes rounded half
    to even; 8-bit palette -> RGB, 1-bit -> grey.  Certificates are converted
    only when their file name follows the document pattern."""
    map_dpi = F.least(F.lit(K.MAP_DPI), F.col("scan_dpi"))

    def size(px):
        return F.bround(F.col(px) * map_dpi / F.col("scan_dpi"), 0).cast("int")

    mode = F.when(F.col("mode") == "P", "RGB").when(F.col("mode") == "1", "L").otherwise(F.col("mode"))
    jpg = F.regexp_replace("dest_file", r"\.tif\z", ".jpg")
    status = F.when(F.col("is_cc") & ~F.col("dest_file").rlike(K.CC_FILE), "bad_cc_name").otherwise("convert")
    return plan.select(
        "dest_file", map_dpi.alias("map_dpi"), size("width_px").alias("width_out"),
        size("height_px").alias("height_out"), mode.alias("mode"),
        F.concat(F.when(F.col("is_cc"), F.lit("map/cc")).otherwise(F.concat(F.lit("map/"), "dest_dir")),
                 F.lit("/"), jpg).alias("target"), status.alias("status"))


def _cc_docs(cc_sheet: DataFrame, maptype: DataFrame) -> DataFrame:
    t = maptype.select(F.col("maptype").alias("_t"), "abbrev")
    c = cc_sheet.join(t, cc_sheet["maptype"] == t["_t"], "left")
    return c.select(file_name("book", "abbrev", "page").alias("map"), cc_doc_basename("doc_number").alias("doc"),
                    "doc_number", "npages", F.col("abbrev").isNull().alias("_unknown"))


def pdf_manifest(images: DataFrame, cc_sheet: DataFrame, cc_files: DataFrame, maptype: DataFrame):
    """(manifest, issues).

    manifest: map, seq, file -- the map's page images in name order, then for
    recorded maps (PM, RM, RS) the pages of each certificate, newest document
    first; numbered across the partitions of a hot map.  issues: map, doc, doc_number,
    issue -- 'unknown_maptype' and 'bad_doc_number' (workbook rows that name no map or
    no document), 'missing_cc' (no image of the document) or 'bad_cc_pages' (image count
    differs from the workbook page count).  Only documents whose page count matches are appended.
    """
    base = F.element_at(F.split("path", "/"), -1)
    imgs = images.select(group(base, K.MAP_PART, 1).alias("map"), F.col("path").alias("file"))
    imgs = imgs.filter(F.col("map").isNotNull())
    rows = _cc_docs(cc_sheet, maptype)
    unread = rows.where(F.col("_unknown") | F.col("doc").isNull()).select(
        "map", "doc", "doc_number", F.when(F.col("_unknown"), "unknown_maptype").otherwise("bad_doc_number").alias("issue"))
    docs = rows.where(~F.col("_unknown") & F.col("doc").isNotNull()).filter(F.upper(F.regexp_extract("map", r"^\d+(\D{2})", 1)).isin(*K.RECORDED_TYPES))
    docs = docs.join(imgs.select("map").distinct(), "map", "left_semi")
    fname = F.element_at(F.split("path", "/"), -1)
    ccf = cc_files.select(group(fname, r"^(.*)-\d{3,}\.jpg\z", 1).alias("doc"), F.concat(F.lit("/"), "path").alias("file"))
    n = ccf.groupBy("doc").agg(F.count(F.lit(1)).alias("n_images"))
    d = docs.join(n, "doc", "left")
    issue = (F.when(F.col("n_images").isNull(), "missing_cc")
             .when(F.col("n_images") != F.col("npages"), "bad_cc_pages"))
    d = d.withColumn("issue", issue)
    issues = d.filter(F.col("issue").isNotNull()).select("map", "doc", "doc_number", "issue").unionByName(unread)
    good = d.filter(F.col("issue").isNull()).select("map", "doc")
    cc_pages = good.join(ccf, "doc").select("map", F.lit(1).alias("part"), "doc", "file")
    pages = imgs.select("map", F.lit(0).alias("part"), F.lit(None).cast("string").alias("doc"), "file").unionByName(cc_pages)
    seq = running(pages, ["map"], ["part", F.col("doc").desc(), "file"], {"_before": ("sum", F.lit(1))})
    manifest = seq.select("map", (F.coalesce("_before", F.lit(0)) + 1).cast("int").alias("seq"), "file")
    return manifest, issues
