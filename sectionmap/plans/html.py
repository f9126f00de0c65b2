"""HTML map records (X3): pages with one ``hmps-map`` block per map are parsed into
workbook rows by a balanced-tag scan (no HTML library): each page is read once, in its
row."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sectionmap.constants import HEADING, LABEL
from sectionmap.functions._util import group, pad
from sectionmap.functions.markup import decode_entities, escape_entities
from sectionmap.operators.blocks import Tag, attribute_of, block_rows
from sectionmap.plans.files import map_keys

BLOCK_CLASS = "hmps-map"
BLOCK_FIELDS = ("heading", "p1", "p2", "p3", "p4", "href")


def read_block(tags: list[Tag]) -> tuple:
    """(heading, p1, p2, p3, p4, href) of one block, entities as they stand."""
    found: dict[str, str | None] = {}
    paragraphs = 0
    for t in tags:
        in_div = t.child == "div"
        # A paragraph does not open a level: it stands at the depth of its div.
        if t.name == "p" and t.depth == 2 and in_div:
            paragraphs += 1
            if paragraphs > 1:
                found.setdefault(f"p{paragraphs}", t.text)
        elif t.name == "h4" and t.depth == 3 and in_div:
            found.setdefault("heading", t.text)
        elif t.name == "span" and t.depth == 3 and paragraphs == 1:
            found.setdefault("p1", t.text)
        elif t.name == "a" and "href" not in found and (attribute_of(t.tag, "role") or "").lower() == "button":
            found["href"] = attribute_of(t.tag, "href")
    return tuple(found.get(c) for c in BLOCK_FIELDS)


def listing_pages(maps: DataFrame, maptype: DataFrame, signatures_text: DataFrame, pdfs: DataFrame) -> DataFrame:
    """Listing pages built from the map table: one page per (type, book), one
    block per map in page order (bounded by the pages of one book).  Every
    23rd map gets a heading without a page number.  The markup differs from map to map as
    that of foreign pages does: other element names, case, quotes and order of attributes,
    further classes, inner boxes, comments, open paragraphs, a block inside a block."""
    m = (map_keys(maps, maptype).join(signatures_text, "map_id", "left")
         .join(pdfs.filter(F.col("map_id").isNotNull()).groupBy("map_id").agg(F.max("path").alias("pdf")), "map_id", "left"))
    last = F.col("page") + F.col("npages") - 1
    heading = F.when(F.col("map_id") % 23 == 0, F.concat(F.lit("BOOK "), F.col("book").cast("string"))).otherwise(
        F.concat_ws(" ", F.col("book").cast("string"), F.col("maptype_name"),
                    F.concat(F.col("page").cast("string"),
                             F.when(F.col("npages") > 1, F.concat(F.lit("-"), last.cast("string"))).otherwise(F.lit("")))))
    text = {"heading": escape_entities(heading), "recdate": F.coalesce(F.date_format("recdate", "yyyy-MM-dd"), F.lit("")),
            "pdf": F.coalesce(F.col("pdf"), F.lit(""))}
    for c in ("surveyor", "client", "description"):
        text[c] = escape_entities(F.coalesce(F.col(c), F.lit("")))
    plain = ['<div class="hmps-map"><div><h4>', "heading", "</h4><p><span>Surveyors: ", "surveyor", "</span></p><p>Recorded: ", "recdate",
             "</p><p>Client: ", "client", "</p><p>Description: ", "description", '</p><a role="button" href="', "pdf", '">PDF</a></div></div>']
    other = ["<SECTION id=m1 Class='card hmps-map wide' title='a > b'><!-- </section> --><div class='box'><h4 class=t>", "heading",
             "</h4><p><span class='who'>Surveyors: ", "surveyor", "</span><p>Recorded: ", "recdate", "<br>noon<p>Client: ", "client",
             "<p>Description: ", "description", "<div><div>more</div><p>Extra: no</div><a href='", "pdf",
             "' class=btn ROLE='button'>PDF</a></div></SECTION>"]
    inner = '<article class="small hmps-map"><div><h4>1 Inner Map 7&ndash;9</h4><p></p><p>Recorded: &#50;001</p><p>A: B: &quot;x&quot;</p><p>&nbsp;</p><a role="button" href="in">i</a></div></article>'
    nested = ['<div data-x="hmps-map" class="hmps-map"><div><h4>', "heading", "</h4><p><span>Surveyors: ", "surveyor", "</span></p><p>Recorded: ", "recdate",
              "</p><p>Client: ", "client", "</p><p>Description: ", "description", '</p><a href="#">x</a><a role="button" href="', "pdf", '">PDF</a>', inner,
              "</div></div>"]

    def fill(parts):
        return F.concat(*[text[p] if p in text else F.lit(p) for p in parts])

    block = F.when(F.col("map_id") % 4 == 1, fill(other)).when(F.col("map_id") % 8 == 2, fill(nested)).otherwise(fill(plain))
    listed = m.select("abbrev", "book", "page", block.alias("block"))
    pages = listed.groupBy("abbrev", "book").agg(
        F.expr("listagg(block, '\n') WITHIN GROUP (ORDER BY page)").alias("body"))
    return pages.select(F.concat(F.lower("abbrev"), F.lit("/"), pad("book")).alias("page_key"),
                        F.concat(F.lit('<html><body class="hmps-map-list"></div>'), F.col("body"), F.lit("</body></html>")).alias("html"))


def parse_records(pages: DataFrame) -> DataFrame:
    """One row per element with the class ``hmps-map``, numbered within its page.

    Its heading is the h4 of a div right inside it; the paragraphs are those of such divs:
    the first one holds the surveyors in a span, the next three date, client and
    description, with every 'label: ' removed; the PDF is where the first link with
    the role of a button leads.  A heading that does not parse gives status
    'bad_heading' and no fields."""
    one = block_rows(pages, "page_key", BLOCK_CLASS, read_block, ", ".join(f"{c}: string" for c in BLOCK_FIELDS), names=("p", "h4", "span", "a"))
    one = one.withColumn("heading", decode_entities("heading"))
    ok = F.coalesce(F.col("heading").rlike(HEADING), F.lit(False))
    page, lastp = group(F.col("heading"), HEADING, 3).try_cast("int"), group(F.col("heading"), HEADING, 4).try_cast("int")

    def field(c):
        return F.when(ok, F.coalesce(F.regexp_replace(decode_entities(c), LABEL, ""), F.lit("")))

    return one.select(
        "page_key", "pos", F.when(ok, group(F.col("heading"), HEADING, 2)).alias("maptype"),
        F.when(ok, group(F.col("heading"), HEADING, 1).try_cast("int")).alias("book"),
        F.when(ok, page).alias("page"),
        F.when(ok, F.when(lastp.isNull(), F.lit(1)).otherwise(lastp - page + 1)).alias("npages"),
        field("p1").alias("surveyors"), field("p2").alias("recdate"), field("p3").alias("client"), field("p4").alias("description"),
        F.when(ok, decode_entities("href")).alias("pdf"), F.when(ok, "ok").otherwise("bad_heading").alias("status"))


def page_headings(pages: DataFrame) -> DataFrame:
    """X3 over arbitrary web pages: the first <h1> heading read as a map
    heading, and the number of links on the page."""
    h = decode_entities(F.regexp_extract("html", r"(?s)<h1>(.*?)</h1>", 1))
    p = pages.select("page_id", h.alias("heading"),
                     F.size(F.regexp_extract_all("html", F.lit(r'<a href="([^"]*)"'), 1)).alias("n_links"))
    ok = F.col("heading").rlike(HEADING)
    return p.select("page_id", "heading", "n_links",
                    F.when(ok, group(F.col("heading"), HEADING, 1).try_cast("int")).alias("book"),
                    F.when(ok, "ok").otherwise("bad_heading").alias("status"))
