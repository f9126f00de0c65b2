"""Surveyor display names (C18, database-style initcap) and parcel / tract
number suffixes (C20, Q7) on generated cases."""

from pyspark.sql import functions as F

from sectionmap import functions as C
from sectionmap.functions.names import full_name, initcap_words

FIRST = ["PAT", "ROBIN", "LEE", "SAM", "ALEX", "J"]
SECOND = [None, "QUINN", "J", "MARIE"]
THIRD = [None, "R", "WADE"]
LAST = ["O'NEILL", "MC-DONALD", "LE ROY", "SMITH", "D'ARCY", "VAN DER BERG", "L123"]
SUFFIX = [None, "JR", "SR", "III"]


def expected_initcap(text: str) -> str:
    out, prev = [], None
    for ch in text:
        out.append(ch.upper() if prev is None or not prev.isalnum() else ch.lower())
        prev = ch
    return "".join(out)


def cases():
    for i in range(420):
        parts = (FIRST[i % 6], SECOND[i % 4], THIRD[i % 3], LAST[i % 7], SUFFIX[i % 4])
        words = [p for p in parts if p]
        n1 = expected_initcap(" ".join(words))
        n2 = " ".join(p for p in (parts[0], parts[1] and parts[1][0], parts[2] and parts[2][0], parts[3], parts[4]) if p)
        yield (*parts, n1, n2)


def test_display_names(spark):
    df = spark.createDataFrame(list(cases()), "f string, s string, t string, l string, x string, n1 string, n2 string")
    cols = [F.col(c) for c in ("f", "s", "t", "l", "x")]
    out = df.select("n1", "n2", initcap_words(full_name(*cols)).alias("g1"),
                    C.surveyor_display_ws(*cols).alias("g2")).collect()
    assert [(r["n1"], r["g1"]) for r in out if r["n1"] != r["g1"]] == []
    assert [(r["n2"], r["g2"]) for r in out if r["n2"] != r["g2"]] == []
    assert any("O'Neill" in r["g1"] for r in out) and any("Mc-Donald" in r["g1"] for r in out)


def test_number_round_trip(spark):
    nums = [str(n) + ["", " AMENDED", f" UNIT {n % 5 + 1}"][n % 3] for n in range(1, 701)]
    df = spark.createDataFrame([(t,) for t in nums], "n string")
    tr = F.concat(F.lit("SMITH & JONES"), C.number_suffix("n", "TR"))
    pm = F.concat(F.lit("CLIENT 7"), C.number_suffix("n", "PM"))
    out = df.select("n", tr.alias("tr"), C.tract_from_client(tr).alias("tr_back"),
                    C.number_from_client(pm).alias("pm_back")).collect()
    assert all(r["tr_back"] == r["n"] for r in out)
    # The parcel report replaces '...(PMn) word' by 'n word' and keeps the rest.
    assert all(r["pm_back"] == r["n"] for r in out)
    assert {r["tr"] for r in out if r["n"] == "95 UNIT 1"} == {"SMITH & JONES (TR95) UNIT 1"}
