"""The balanced-tag scan against the standard library's HTML parser."""

from html.parser import HTMLParser

from pyspark.sql import functions as F

from sectionmap import constants as K
from sectionmap.operators import blocks as B
from sectionmap.plans import html as H
from sectionmap.plans.staging import Staging
from tests.conftest import SF001

PAGES = {
    "empty": "", "text": "no tags at all", "stray": "</div></p><div class='x'>a</div></div><div class=x>b</div>",
    "open": "<div class='x'><div>never closed<p>", "quotes": """<DIV title="a > b" class = 'q x'>1<br/>2</DIV>""",
    "nested": "<div class='x'>1<div class=\"y x z\">2<div>3</div></div>4</div>",
    "comment": "<div class='x'><!-- </div> <div class='x'> -->5</div>", "void": "<img class='x'><section class=x><img><hr></section>",
    "not": "<div class='xx'><div data-class='x' id='x'>6</div></div>", "self": "<div class='x'/>7<p class='x'>8</p>",
}


class Reader(HTMLParser):
    """(first tag, last tag) numbers of the elements of class x; same-name depths, as a person would count them."""

    def __init__(self, text):
        super().__init__(convert_charrefs=False)
        self.n, self.open, self.found, self.rows = -1, {}, [], []
        self.feed(text)
        self.close()
        for name, stack in self.open.items():
            self.rows += [(start, self.n + 1 - start, False) for start, wanted in stack if wanted]

    def handle_starttag(self, name, attrs):
        self.n += 1
        wanted = "x" in (dict(attrs).get("class") or "").split()
        if name not in K.VOID_ELEMENTS:
            self.open.setdefault(name, []).append((self.n, wanted))

    def handle_startendtag(self, name, attrs):
        self.n += 1

    def handle_comment(self, data):
        self.n += 1

    def handle_endtag(self, name):
        self.n += 1
        if self.open.get(name):
            start, wanted = self.open[name].pop()
            if wanted:
                self.rows.append((start, self.n - start, True))


def test_blocks_match_a_parser(spark):
    pages = spark.createDataFrame(list(PAGES.items()) + [("null", None)], "k string, html string")
    tags = B.tag_rows(pages, "k")
    got = {}
    for r in B.blocks(tags, "k", B.has_class("tag", "x")).collect():
        got.setdefault(r["k"], []).append((r["start"], r["length"], r["closed"]))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(Reader(t).rows) for k, t in PAGES.items() if Reader(t).rows}


def test_attributes(spark):
    tags = ["<a href='x y' ROLE=button>", '<a data-href="no" href="u?a=1&amp;b">', "<a>", "<a href>", "<a\nhref = v>"]
    df = spark.createDataFrame([(t,) for t in tags], "tag string").select(B.attribute("tag", "href").alias("h"), B.attribute("tag", "role").alias("r"))
    assert [tuple(r) for r in df.collect()] == [("x y", "button"), ("u?a=1&amp;b", None), (None, None), (None, None), ("v", None)]


def test_long_attribute_and_many_tags(spark):
    html = "<div class='x' title='" + "t" * 200_000 + "'>" + "<b>1</b>" * 5000 + "</div>"
    pages = spark.createDataFrame([("p", html)], "k string, html string")
    tags = B.tag_rows(pages, "k")
    found = B.blocks(tags, "k", B.has_class("tag", "x"))
    assert [tuple(r) for r in found.collect()] == [("p", 0, 10_001, True)]
    assert B.block_tags(tags, found, "k").agg(F.count("*"), F.max("depth")).first() == (10_001, 2)


def test_records_of_foreign_markup(spark):
    html = """<ul class="hmps-map"><li><div><h4>3 Parcel Map 120-121</h4><p><b>x</b><span>Surveyors: A &amp; B</span></p><p>Recorded: d</p>
      <p>Client: N: c</p><p>Description: t</p></div><a href="#">no</a><A HREF='f.pdf' role="button">y</A></ul>
      <div class="hmps-map"><span><h4>4 Survey 9</h4></span></div><div class="hmps-map"></div>"""
    rows = H.parse_records(spark.createDataFrame([("k", html)], "page_key string, html string")).orderBy("pos").collect()
    assert tuple(rows[0])[2:] == ("Parcel Map", 3, 120, 2, "A & B", "d", "c", "t", "f.pdf", "ok")
    assert [r["status"] for r in rows] == ["ok", "bad_heading", "bad_heading"]


def test_fixture_holds_every_kind_of_markup(spark):
    st = Staging(spark, SF001)
    signed = st.inp.f_legacy_map.select(F.col("id").alias("map_id"), "surveyor")
    html = " ".join(r["html"] for r in H.listing_pages(st.maps, st.maptype, signed, st.pdfs).collect())
    for part in ("<SECTION id=m1 Class='card hmps-map wide'", '<article class="small hmps-map">', 'class="hmps-map-list"', "<!-- </section> -->", "role=", "ROLE="):
        assert part in html
