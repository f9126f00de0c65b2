"""Codec goldens and round trips (township/range, qq names, algebra, cover,
legacy numbers, validator, names and numbers)."""

import pytest
from pyspark.sql import functions as F

from sectionmap import constants as K
from sectionmap import functions as C
from sectionmap.functions.names import initcap_words


def one(spark, expr, value, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("y")).first()["y"]


@pytest.mark.parametrize("text,value", [
    ("T1N", 0), ("t7n", 6), ("2N", 1), ("T1S", -1), ("2s", -2), ("12N", 11), ("0N", None), ("T0S", None),
    ("T1E", None), (" 1N", None), ("1N\n", None), ("TT1N", None), (None, None)])
def test_township_number(spark, text, value):
    assert one(spark, C.township_number("x"), text) == value


@pytest.mark.parametrize("text,value", [("R1E", 0), ("4e", 3), ("R1W", -1), ("3W", -3), ("0E", None), ("R1N", None)])
def test_range_number(spark, text, value):
    assert one(spark, C.range_number("x"), text) == value


@pytest.mark.parametrize("v,t,r", [(0, "1N", "1E"), (-1, "1S", "1W"), (98, "99N", "99E"), (99, None, None),
                                   (-99, "99S", "99W"), (-100, None, None)])
def test_grid_str(spark, v, t, r):
    assert one(spark, C.township_str("x"), v, "x int") == t
    assert one(spark, C.range_str("x"), v, "x int") == r


def test_township_round_trip(spark):
    df = spark.range(-99, 99).select(F.col("id").cast("int").alias("v"))
    out = df.select("v", C.township_number(C.township_str("v")).alias("t"),
                    C.range_number(F.concat(F.lit("r"), C.range_str("v"))).alias("r")).collect()
    assert all(r["t"] == r["v"] and r["r"] == r["v"] for r in out)


def test_subsec_names_round_trip(spark):
    df = spark.createDataFrame([(b, n) for b, n, _ in K.SUBSEC_NAMES], "bits int, name string")
    out = df.select(
        "bits", "name", C.subsec_bits_lookup("name").alias("lookup"),
        C.subsec_bits_lookup(F.concat(F.lit("  "), F.regexp_replace(F.lower("name"), " ", "  "), F.lit(" "))).alias("loose"),
        C.subsec_name("bits").alias("back"), C.subsec_bits("name").alias("algebra"),
        C.subsec_cover("bits").alias("cover")).collect()
    for r in out:
        assert r["lookup"] == r["bits"] and r["loose"] == r["bits"]
        assert r["back"] == r["name"]
        assert r["algebra"] == r["bits"], r["name"]
        assert r["cover"] == [r["name"]]


@pytest.mark.parametrize("text,bits", [
    ("N/2 E/2", None), ("E/2 N/2", None), ("S/2 W/2", None), ("ne/4", None), ("NE/4  NE/4", 0x0008),
    ("NE/4NE/4", None), ("N/2 NE/4", 0x000C), ("NE/4 N/2", None), ("1/1", 0xFFFF), ("X/4", None)])
def test_subsec_algebra(spark, text, bits):
    assert one(spark, C.subsec_bits("x"), text) == bits


@pytest.mark.parametrize("names,bits", [
    (["NE/4", "SW/4"], 0x33CC), (["NE/4", "1/1", "bad"], 0xFFFF), (["bad", "1/1"], None), ([], 0)])
def test_subsec_list(spark, names, bits):
    assert one(spark, C.subsec_bits_list("x"), names, "x array<string>") == bits


@pytest.mark.parametrize("bits,cover", [
    (0x1FFF, ["N/2", "N/2 S/2", "SW/4 SW/4"]), (0x0111, ["W/2 NW/4", "NW/4 SW/4"]),
    (0xFFFF, ["1/1"]), (0x10000, None), (0, None), (0x8888, ["E/2 E/2"])])
def test_subsec_cover(spark, bits, cover):
    assert one(spark, C.subsec_cover("x"), bits, "x int") == cover


def test_legacy_qq(spark):
    df = spark.range(0, 18).select(F.col("id").cast("int").alias("n"))
    out = {r["n"]: (r["b"], r["l"]) for r in df.select(
        "n", C.legacy_qq_bit("n").alias("b"), C.legacy_qq_list(C.legacy_qq_bit("n")).alias("l")).collect()}
    assert out[0] == (None, None) and out[17] == (None, None)
    for n in range(1, 17):
        assert out[n] == (K.LEGACY_QQ_BITS[n - 1], f",{n},")
    assert one(spark, C.legacy_qq_list("x"), 0xCC00, "x int") == ",9,10,15,16,"
    assert one(spark, C.legacy_qq_list("x"), 0, "x int") == ",,"


# The 23 validator cases of the reference's own self-test.
VALIDATOR_CASES = [
    ("7N.3E.0", False), ("7N.3E.1", True), ("7N.3E.36", True), ("7N.3E.37", False), ("7N.3E.1.A", True),
    ("7N.3E.1.P", True), ("7N.3E.1.Q", False), ("0N.3E.1.A", False), ("1N.3E.1.A", True), ("15N.3E.1.A", True),
    ("16N.3E.1.A", False), ("0S.3E.1.A", False), ("1S.3E.1.A", True), ("5S.3E.1.A", True), ("6S.3E.1.A", False),
    ("1N.0E.1.A", False), ("1N.1E.1.A", True), ("1N.8E.1.A", True), ("1N.9E.1.A", False), ("1N.0W.1.A", False),
    ("1N.1W.1.A", True), ("1N.3W.1.A", True), ("1N.4W.1.A", False)]


def test_validate_path(spark):
    df = spark.createDataFrame(VALIDATOR_CASES + [("10S.1E.1", False), ("1N.1E.1.AB", False), (None, False)],
                               "p string, ok boolean")
    for r in df.select("p", "ok", C.validate_path("p").alias("v")).collect():
        assert r["v"] == r["ok"], r["p"]


def test_names(spark):
    assert one(spark, C.map_name(F.lit(73), F.lit("PM"), F.lit(123)), None) == "073pm123"
    assert one(spark, C.map_name(F.lit(1234), F.lit("RS"), F.lit(5)), None) == "123rs005"
    assert one(spark, C.cc_doc_number(F.lit("2001-or-000123-002.jpg"), F.lit(3)), None) == "2001 OR 123"
    assert one(spark, C.cc_doc_number(F.lit("2001-doc-001234-002.jpg"), F.lit(3)), None) == "2001-1234-3"
    assert one(spark, C.cc_doc_basename(F.lit("2001 OR 123")), None) == "2001-or-000123"
    assert one(spark, C.cc_doc_basename(F.lit("2001-1234-3")), None) == "2001-doc-001234"
    assert one(spark, C.cc_doc_basename(F.lit("bad")), None) is None
    assert one(spark, C.number_suffix(F.lit("12 AMENDED"), "PM"), None) == " (PM12) AMENDED"
    assert one(spark, C.number_suffix(F.lit("UNIT 3"), "PM"), None) == "UNIT  (PM3)"
    assert one(spark, C.number_from_client(F.lit("CLIENT 5 (PM12) AMENDED")), None) == "12 AMENDED"
    assert one(spark, C.number_from_client(F.lit("A (PM1) B (PM40) UNIT X")), None) == "40 UNIT X"
    assert one(spark, C.number_from_client(F.lit("NO NUMBER ")), None) == "NO NUMBER"
    assert one(spark, C.tract_from_client(F.lit("SMITH (TR25) AMENDED")), None) == "25 AMENDED"
    assert one(spark, C.tract_from_client(F.lit("SMITH (TR95) UNIT 1")), None) == "95 UNIT 1"
    ft = "ALL " + K.FULL_TOWNSHIP + " AND " + K.FULL_TOWNSHIP
    assert one(spark, C.full_township(F.lit(ft)), None) == "ALL FULL TOWNSHIP AND " + K.FULL_TOWNSHIP
    parts = [F.lit("JOHN"), F.lit("QUINCY"), F.lit(None).cast("string"), F.lit("SMITH"), F.lit("JR")]
    assert one(spark, C.surveyor_display(*parts), None) == "JOHN Q SMITH JR"
    parts[0] = F.lit(None).cast("string")
    assert one(spark, C.surveyor_display(*parts), None) is None
    assert one(spark, C.surveyor_display_ws(*parts), None) == "Q SMITH JR"
    assert one(spark, initcap_words(F.lit("JOHN Q SMITH")), None) == "John Q Smith"
