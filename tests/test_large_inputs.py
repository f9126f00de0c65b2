"""What keeps a task's rows and a row's work as they are when the input grows."""

import glob

from pyspark.sql import functions as F

import __spark_entry__ as E
from sectionmap.plans import trs as TR
from tests.conftest import SF001


def _plan(df, which="optimizedPlan"):
    return getattr(df._jdf.queryExecution(), which)().toString()


def test_sources_are_counted_before_the_join(spark):
    plan = _plan(E.queries()["trs_totals"](spark, SF001))
    assert plan.index("Join LeftOuter") < plan.index("Aggregate [source_id")


def test_names_of_files_are_read_once(spark):
    from sectionmap.plans.staging import Staging
    pdfs = Staging(spark, SF001).pdfs
    plan = _plan(pdfs.where("map_id IS NOT NULL").groupBy("map_id").agg(F.count_distinct("path")))
    assert plan.count("regexp_extract(") == 3 and plan.count("concat(/pdf/") == 1


def test_links_of_odd_names(spark):
    from sectionmap.plans import files as FL
    from sectionmap.sources import constants as C
    paths = ["/map/cr/001/001cr005-002.jpg", "/map/cr/1000/1000cr005-1002.jpg", "/map/x.jpg", "", None, "/map/cr/001/00acr005-001.jpg"]
    listing = spark.createDataFrame([(p,) for p in paths], "path string")
    maps = spark.createDataFrame([(7, 1, 1, 5, 1), (8, 1, 1000, 5, 1)], "id int, maptype_id int, book int, page int, npages int").withColumns(
        {c: F.lit(None).cast("string") for c in ("client", "description")}).withColumn("recdate", F.lit(None).cast("date"))
    got = {r["path"]: (r["map_id"], r["page"]) for r in FL.link_files(listing, maps, C.maptype(spark), "map").collect()}
    assert got == {paths[0]: (7, 2), paths[1]: (8, 1002), paths[2]: (None, None), "": (None, None), None: (None, None), paths[5]: (None, 1)}


def test_pages_are_read_without_a_shuffle(spark):
    from sectionmap.plans import html as H
    pages = spark.createDataFrame([("k", '<div class="hmps-map"><div><h4>4 Survey 9</h4></div></div>'), (None, '<p class="hmps-map">'), ("n", None)],
                                  "page_key string, html string")
    records = H.parse_records(pages)
    assert "Exchange" not in _plan(records, "executedPlan")
    assert [(r["page_key"], r["pos"], r["book"], r["page"]) for r in records.collect()] == [("k", 0, 4, 9)]


def test_scan_of_a_page_agrees_with_the_windows(spark):
    from sectionmap.operators import blocks as B
    from tests.test_blocks import PAGES
    more = {"mixed": "</x><ul class=x><li class='x'>a<div><DIV CLASS='x'>b</p><br/><p>c</DIV>d</ul><p class=x><!--</p>--><li>e</p>f",
            "same": "<b class=x><b><b class=x>1</b></b></b><b>", "void": "<p class='x'/><hr class=x><a class='y x' href=\"u>v\">1</a>"}
    pages = spark.createDataFrame(list({**PAGES, **more}.items()), "k string, html string")
    tags = B.tag_rows(pages, "k")
    rows = B.block_tags(tags, B.blocks(tags, "k", B.has_class("tag", "x")), "k").orderBy("k", "start", "idx").collect()
    expected = {}
    for r in rows:
        found = expected.setdefault((r["k"], r["start"]), [])
        if r["kind"] == "open":
            found.append((r["name"], r["tag"], r["text"], r["depth"], r["child"]))
    got = {(k, start): [tuple(t) for t in found] for k, text in {**PAGES, **more}.items() for start, found in B.scan(text, "x")}
    assert len(got) > 12 and got == expected


def test_a_document_is_sorted_in_tasks_of_a_size(spark, tmp_path, monkeypatch):
    from sectionmap.plans import document as D
    monkeypatch.setattr(D, "LINES", 20)
    rows = spark.range(1000).select(F.col("id").cast("int").alias("ID"))
    D.write_document(spark, [D.records(rows, "map", ["ID"], F.col("ID"))], str(tmp_path / "d"), "now")
    parts = [open(p).read().split("</map>") for p in sorted(glob.glob(f"{tmp_path}/d/part-*"))]
    assert len(parts) >= 40 and max(map(len, parts)) < 100
    ids = [int(x.split("<ID>")[1].split("<")[0]) for p in parts for x in p if "<ID>" in x]
    assert ids == list(range(1000))


def test_named_and_numbered_entities_in_one_text(spark):
    from sectionmap.functions.markup import decode_entities
    texts = {"&amp;lt;": "&lt;", "&lt;&amp;amp;&gt;": "<&amp;>", "&am&lt;p;": "&am<p;", "&Amp; &no; &": "&Amp; &no; &", "&#38;lt; &amp;#60;": "&lt; &#60;",
             "&ndash;&quot;&nbsp;": "–\" "}
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", decode_entities("t").alias("d")).collect()
    assert {r["t"]: r["d"] for r in got} == texts


def test_the_parser_s_tasks_follow_the_maps(spark, monkeypatch):
    from sectionmap.plans import parser as P
    from sectionmap.sources.fixtures import Inputs
    monkeypatch.setattr(P, "MAPS", 20)
    inp = Inputs(spark, SF001)
    assert P.classify(inp.f_desc, inp.f_desc_trs).rdd.getNumPartitions() >= inp.f_desc.count() // 20


def test_section_lists_add_bits_and_list_only_odd_sections(spark):
    rows = [(1, 1, 1, 5), (1, 1, 1, 5), (1, 1, 1, 36), (1, 1, 1, None), (2, 1, 1, None), (3, None, 1, 0), (3, None, 1, 39), (3, None, 1, 40),
            (3, None, 1, -1), (None, None, None, 8), (None, None, None, 7), (4, 2, 2, 99), (4, 2, 2, 99), (5, 1, 1, 10), (5, 1, 1, 9)]
    rows += [(6, 1, 1, s) for s in range(40)] + [(7, 1, 1, s) for s in range(-3, 70, 2)]
    wanted = {}
    for *key, sec in rows:
        wanted.setdefault(tuple(key), set()).update([] if sec is None else [sec])
    lists = TR.section_lists(spark.createDataFrame(rows, "map_id INT, tshp INT, rng INT, sec INT"))
    got = lists.collect()
    assert {tuple(r)[:3]: r["_secs"] for r in got} == {k: ",".join(map(str, sorted(v))) or None for k, v in wanted.items()}
    assert len(got) == len(wanted)
    # Before, every group went through two shuffles and a sorted list; now one sum of bits.
    assert "bit_or" in lists._jdf.queryExecution().optimizedPlan().toString()


def test_elements_meet_the_section_list_without_a_shuffle_on_the_section(spark):
    from sectionmap.plans import export as X
    trs = spark.createDataFrame([(1, 4, -1, 26, 1, 1), (1, 4, -1, 27, 1, 1), (2, 6, 0, 31, None, 1), (2, 6, 0, 31, 1, 0), (3, None, 0, 31, 1, 1)],
                                "map_id INT, tshp INT, rng INT, sec INT, subsec INT, source_id INT")
    found = X.qq_elements(trs, ["05N1W26", "07N1E31"])
    plan = _plan(found, "executedPlan")
    # Before: a sort-merge join, all rows of a listed section in one task.
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "hashpartitioning" not in plan
    one = trs.limit(1).select(X.legacy_qq_list("subsec")).head()[0]
    assert sorted(map(tuple, found.collect())) == [(1, "_x0030_5N1W26", one), (2, "_x0030_7N1E31", None)]


def test_frequent_entity_beside_others(spark):
    from sectionmap.functions.markup import decode_entities, without_comments
    texts = {"a &amp; b &amp;amp;": "a & b &amp;", "&a&amp;mp;": "&a&mp;", "&amp;#38; &amp; &#38;": "&#38; & &", "&amp;": "&", "a & b &amp;": "a & b &",
             "&am&amp;p;": "&am&p;", "&l&amp;t; &gt;": "&l&t; >", "": ""}
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", decode_entities("t").alias("d")).collect()
    assert {r["t"]: r["d"] for r in got} == texts
    texts = {"a<!-- b -->c<!--\n-->d": "acd", "a<!-- b": "a<!-- b", "a --> b": "a --> b", "a": "a", None: None}
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", without_comments("t").alias("d"))
    assert {r["t"]: r["d"] for r in rows.collect()} == texts
    # Before, the pattern ran over every text.
    assert "Contains(t" in _plan(rows)
