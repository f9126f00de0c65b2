"""Running aggregates, ids, overlaps, boxes and specs: total orders, hot keys, brute force."""

import random

import pytest
from pyspark.sql import functions as F

from sectionmap.operators import search as S
from sectionmap.operators.ids import sequential_ids
from sectionmap.operators.intervals import interval_join_exploded, overlaps
from sectionmap.operators.ordered import running
from sectionmap.operators.paths import path_index
from sectionmap.plans import images as IM
from sectionmap.sources.constants import maptype


def test_running_within_a_hot_key(spark):
    rnd = random.Random(3)
    rows = [("hot" if rnd.random() < 0.6 else rnd.choice([None, "b", "c"]), rnd.randrange(50), rnd.randrange(100), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, o int, v int, i int").repartition(13)
    got = {r["i"]: (r["n"], r["m"]) for r in running(df, ["k"], ["o", "i"], {"n": ("sum", F.col("v")), "m": ("max", F.col("v"))}).collect()}
    want, so_far = {}, {}
    for k, o, v, i in sorted(rows, key=lambda r: (r[1], r[3])):
        want[i] = so_far.get(k, (None, None))
        n, m = want[i]
        so_far[k] = (v, v) if n is None else (n + v, max(m, v))
    assert got == want


def test_equal_keys_get_equal_ids_in_any_partitioning(spark):
    rows = [(i % 5, chr(97 + i % 7), i) for i in range(700)]
    df = spark.createDataFrame(rows, "k int, t string, v int")
    runs = [{(r["k"], r["t"], r["v"]): r["id"] for r in sequential_ids(d, ["k"], F.lit(0)).collect()}
            for d in (df, df.repartition(7), df.orderBy(F.rand(5)).coalesce(3))]
    assert runs[0] == runs[1] == runs[2] and sorted(runs[0].values()) == list(range(1, 701))


def test_overlaps_against_brute_force(spark):
    rnd = random.Random(11)
    rows = [(i, "HOT" if i % 3 else rnd.choice("ab"), rnd.randrange(0, 4000), rnd.choice([-1, 0, 1, 1, 2, 3, 40])) for i in range(1500)]
    df = spark.createDataFrame(rows, "i int, k string, s int, n int")
    got = {r["i"]: r["covered_to"] for r in overlaps(df, ["k"], "s", "n", ["i"]).collect()}
    want, far = {}, {}
    for i, k, s, n in sorted((r for r in rows if r[3] >= 1), key=lambda r: (r[2], r[0])):
        if k in far and s <= far[k]:
            want[i] = far[k]
        far[k] = max(far.get(k, -1), s + n - 1)
    assert got == want and len(got) > 300


def test_an_interval_without_an_end_is_an_error(spark):
    iv = spark.createDataFrame([("a", 1, 2_000_000_000)], "k string, s int, n int")
    pt = spark.createDataFrame([("a", 5)], "k string, p int")
    with pytest.raises(Exception, match="interval too long"):
        interval_join_exploded(pt, iv, ["k"], "p", "s", "n").collect()


@pytest.mark.parametrize("splits", [1, 4])
def test_boxes_against_brute_force(spark, splits):
    rnd = random.Random(2)
    trs = [(rnd.randrange(60), rnd.choice([4, 4, 4, 5]), rnd.choice([-1, 0]), rnd.choice([7, 7, 7, 8, 9]), rnd.choice([None, 0, 1, 0x00CC, 0xFFFF, 1 << 15]), 0)
           for _ in range(800)]
    boxes = [(f"b{i}", rnd.choice([4, 5, 6]), rnd.choice([-1, 0]), rnd.choice([7, 8]), rnd.choice([0xFFFF, 0xCCCC, 1, 1 << 15])) for i in range(40)]
    boxes += [("b0", 4, -1, 7, 2), ("b0", 4, -1, 7, 2)]
    t = spark.createDataFrame(trs, "map_id int, tshp int, rng int, sec int, subsec int, source_id int")
    b = spark.createDataFrame(boxes, "box_id string, tshp int, rng int, sec int, mask int")
    by_bits = {(i, m) for i, *place, mask in boxes for m, a, r, s, sub, _ in trs if [a, r, s] == place and (sub or 0) & mask}
    assert {tuple(x) for x in S.maps_by_box(t, b, splits).collect()} == by_bits
    index = path_index(t)
    assert {tuple(x) for x in S.maps_by_box_paths(index, b, whole=False, splits=splits).collect()} == by_bits
    with_cells = {(m, a, r, s) for m, a, r, s, sub, _ in trs if sub}
    plain = {(m, a, r, s) for m, a, r, s, sub, _ in trs if sub is None}
    by_path = by_bits | {(i, m) for i, *place, _ in boxes for m, *at in plain - with_cells if at == place}
    paths = S.maps_by_box_paths(index, b, splits=splits)
    assert {tuple(x) for x in paths.collect()} == by_path
    got = {r["box_id"]: tuple(r)[1:] for r in S.compare_by_box(b, S.maps_by_box(t, b), paths).collect()}
    assert got == {i: (len([1 for x in by_bits & by_path if x[0] == i]), 0, len([1 for x in by_path - by_bits if x[0] == i])) for i, *_ in boxes}


def test_specs_strict_and_leading_zeros(spark):
    specs = lambda *x: spark.createDataFrame([(s,) for s in x], "spec string")
    good = S.expand_specs(specs("4N.1W.[001-003] 4N.1W.[12-010]"), strict=True)
    assert [r["path"] for r in good.collect()] == [f"4N.1W.{i}" for i in (1, 2, 3, 10, 11, 12)]
    loose = S.expand_specs(specs("4N.1W.[1-2,40]", "4N.1W.[1-0000000099]", "4N.1W.3"))
    assert {r["spec"]: r["spec_ok"] for r in loose.collect()} == {"4N.1W.[1-2,40]": False, "4N.1W.[1-0000000099]": False, "4N.1W.3": True}
    with pytest.raises(Exception, match=r"Bad path spec: 4N.1W.\[1-2,40\]"):
        S.expand_specs(specs("4N.1W.3 4N.1W.[1-2,40]"), strict=True).collect()


def test_manifest_of_a_hot_map(spark):
    files = [f"/map/pm/001/001pm005-{i:03d}.jpg" for i in range(1, 900)] + ["/map/pm/001/001pm009-001.jpg"]
    images = spark.createDataFrame([(f,) for f in files], "path string").repartition(9)
    cc = spark.createDataFrame([("Parcel Map", 1, 5, "2001 OR 7", 2), ("Parcel Map", 1, 5, "1999-12-1", 1), ("Odd Map", 1, 5, "2001 OR 8", 1),
                                ("Parcel Map", 1, 9, "n/a", 1)], "maptype string, book int, page int, doc_number string, npages int")
    cc_files = spark.createDataFrame([("map/cc/2001-or-000007-001.jpg",), ("map/cc/2001-or-000007-002.jpg",)], "path string")
    manifest, issues = IM.pdf_manifest(images, cc, cc_files, maptype(spark))
    rows = sorted(manifest.where("map = '001pm005'").collect(), key=lambda r: r["seq"])
    assert [r["seq"] for r in rows] == list(range(1, 902))
    assert [r["file"] for r in rows] == files[:-1] + ["/map/cc/2001-or-000007-001.jpg", "/map/cc/2001-or-000007-002.jpg"]
    assert sorted((r["doc_number"], r["issue"]) for r in issues.collect()) == [
        ("1999-12-1", "missing_cc"), ("2001 OR 8", "unknown_maptype"), ("n/a", "bad_doc_number")]
