"""Files -> maps: image, scan and PDF object keys linked to maps by the book,
type and page in their names (P4), contiguous image runs (W3) and per-map
coverage (Q19)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sectionmap import constants as K
from sectionmap.functions.names import file_name
from sectionmap.functions._util import group, once, pad

# Name parts, read as the legacy loader reads them (greedy '.*/' = last folder).
BOOK, PAGE, ABBREV, IMAGE = K.BOOK_PART, K.PAGE_PART, K.ABBREV_PART, K.IMAGE_PART


def map_keys(maps: DataFrame, maptype: DataFrame) -> DataFrame:
    """maps x maptype: the maps with their type's name, all columns; later plans need no
    second join to fetch one."""
    t = maptype.select(F.col("id").alias("_tid"), "abbrev", F.col("maptype").alias("maptype_name"))
    return maps.join(t, maps["maptype_id"] == t["_tid"]).select(
        F.col("id").alias("map_id"), "abbrev", "maptype_name", "book", "page", "npages", "recdate", "client", "description")


def link_files(listing: DataFrame, maps: DataFrame, maptype: DataFrame, kind: str,
               with_page: bool = True) -> DataFrame:
    """(kind, path, map_id, page) for every listed file; unmatched files keep a
    NULL map.  One set-based left join for all types (no per-type loop)."""
    p = F.col("path")
    # An empty group is no number: the cast gives NULL.
    f = once(listing.select(F.lit(kind).alias("kind"), p.alias("path")),
             _book=F.regexp_extract(p, BOOK, 1).try_cast("int"), _page=F.regexp_extract(p, PAGE, 1).try_cast("int"),
             _abbrev=F.upper(F.regexp_extract(p, ABBREV, 1)),
             page=F.regexp_extract(p, IMAGE, 1).try_cast("int") if with_page else F.lit(None).cast("int"))
    m = map_keys(maps, maptype).select("map_id", F.col("abbrev").alias("_ma"), F.col("book").alias("_mb"),
                                       F.col("page").alias("_mp"))
    j = f.join(m, (f["_book"] == m["_mb"]) & (f["_page"] == m["_mp"]) & (f["_abbrev"] == m["_ma"]), "left")
    return j.select("kind", "path", "map_id", "page")


def not_indexed(images: DataFrame) -> DataFrame:
    """Q4: distinct (type, map name) of image files that link to no map."""
    p = F.col("path")
    return (images.filter(F.col("map_id").isNull())
            .select(group(p, r"/map/(..)", 1).alias("maptype"), group(p, r".*/(.*)-", 1).alias("map"))
            .distinct())


def contiguous_pages(pages: DataFrame) -> DataFrame:
    """Per map, how many pages 1, 2, 3, ... are present before the first gap.

    pages(map_id, page).  A page p ends the run when p + 1 is absent; the run
    length is the smallest such p, provided page 1 exists.  Anti join + min
    aggregate: partial aggregation and skew-split joins, no per-map buffer.
    """
    d = pages.filter(F.col("page") >= 1).select("map_id", "page").distinct()
    nxt = d.select(F.col("map_id").alias("_m"), (F.col("page") - 1).alias("_prev"))
    ends = d.join(nxt, (d["map_id"] == nxt["_m"]) & (d["page"] == nxt["_prev"]), "left_anti")
    run = ends.groupBy("map_id").agg(F.min("page").alias("_end"))
    first = d.filter(F.col("page") == 1).select("map_id")
    return (d.select("map_id").distinct().join(run, "map_id", "left").join(
        first.withColumn("_has1", F.lit(True)), "map_id", "left")
        .select("map_id", F.when(F.col("_has1"), F.col("_end")).otherwise(F.lit(0)).cast("int").alias("contiguous")))


def probe_objects(mk: DataFrame, objects: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The store's keys that carry the names built from the maps ``mk``:
    (map_id, page, imagefile) of page images and (map_id, pdffile) of PDFs."""
    name = F.concat(F.lower("abbrev"), F.lit("/"), pad("book"), F.lit("/"), file_name("book", "abbrev", "page"))
    names = mk.select("map_id", F.concat(F.lit("/map/"), name).alias("_base"), F.concat(F.lit("/pdf/"), name, F.lit(".pdf")).alias("pdffile"))
    keys = once(objects.select("path"), _base=group("path", r"^(.*)-\d{3,}\.jpg\z", 1),
                page=F.regexp_extract("path", r"-(\d{3,})\.jpg\z", 1).try_cast("int"))
    pages = names.join(keys, "_base").select("map_id", "page", F.col("path").alias("imagefile"))
    pdfs = names.join(objects.select(F.col("path").alias("pdffile")), "pdffile").select("map_id", "pdffile").distinct()
    return pages, pdfs


def coverage(sheet: DataFrame, maps: DataFrame, maptype: DataFrame, images: DataFrame, pdfs: DataFrame,
             objects: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Q19: (coverage, missing_images, missing_pdfs) of the workbook's maps.

    coverage: the map's id, its image and PDF counts in the tables, the run of
    page images 1, 2, ... found in the store under the map's own name, whether
    its PDF is there, and a status: 'warning' (the table has another count),
    'missing_rows' (no table rows, but images in the store) or 'ok'.
    ``sheet_images`` and ``sheet_pdfs`` are what the workbook gets (K8); NULL
    leaves the cell as it is.  The missing rows are those to add to the tables.
    Each side is aggregated to one row per map before joining (no fan-out).
    """
    mk = map_keys(maps, maptype)
    s = sheet.join(mk, (sheet["maptype"] == mk["maptype_name"]) & (sheet["book"] == mk["book"])
                   & (sheet["page"] == mk["page"])).select(sheet["maptype"], sheet["book"], sheet["page"], "map_id")
    n_img = images.filter(F.col("map_id").isNotNull()).groupBy("map_id").agg(
        F.count_distinct("path").alias("map_images"))
    n_pdf = pdfs.filter(F.col("map_id").isNotNull()).groupBy("map_id").agg(F.count_distinct("path").alias("pdfs"))
    found_pages, found_pdfs = probe_objects(mk, objects)
    run = contiguous_pages(found_pages.select("map_id", "page"))
    out = (s.join(n_img, "map_id", "left").join(n_pdf, "map_id", "left").join(run, "map_id", "left")
           .join(found_pdfs, "map_id", "left"))
    img = F.coalesce(F.col("map_images"), F.lit(0))
    n_pdfs = F.coalesce(F.col("pdfs"), F.lit(0))
    cont = F.coalesce(F.col("contiguous"), F.lit(0))
    warning = (img > 0) & (img != cont)
    status = F.when(warning, "warning").when((img == 0) & (cont > 0), "missing_rows").otherwise("ok")
    cover = out.select("maptype", "book", "page", "map_id", img.cast("bigint").alias("map_images"), n_pdfs.cast("bigint").alias("pdfs"),
                       cont.alias("contiguous"), F.col("pdffile").isNotNull().alias("pdf_found"), status.alias("status"),
                       F.when(~warning, cont).alias("sheet_images"), F.when(F.col("pdffile").isNotNull(), 1).alias("sheet_pdfs"))
    absent = cover.filter("status = 'missing_rows'").select(F.col("map_id").alias("_map"), "contiguous")
    missing_images = (found_pages.join(absent, (found_pages["map_id"] == absent["_map"]) & F.col("page").between(1, F.col("contiguous")))
                      .select("map_id", "page", "imagefile").distinct())
    missing_pdfs = out.filter(F.col("pdffile").isNotNull() & (n_pdfs == 0)).select("map_id", "pdffile").distinct()
    return cover, missing_images, missing_pdfs
