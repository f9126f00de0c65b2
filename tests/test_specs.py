"""Path specs (C14) against the reference's demonstration input."""

from sectionmap.operators.search import expand_specs


def expand(spark, spec):
    df = spark.createDataFrame([(spec,)], "spec string")
    rows = expand_specs(df).collect()
    return [r["path"] for r in rows], {r["spec_ok"] for r in rows}


def test_demo_spec(spark):
    paths, ok = expand(spark, "7N.5E.12 7N.4E.[1,2,4-8,15] 4N.1W.7.[A,B,C-G,H,I,J,K-P] 4N.1E.3.KLOP")
    expected = (["7N.5E.12"] + [f"7N.4E.{s}" for s in (1, 2, 4, 5, 6, 7, 8, 15)]
                + [f"4N.1W.7.{c}" for c in "ABCDEFGHIJKLMNOP"] + [f"4N.1E.3.{c}" for c in "KLOP"])
    assert sorted(paths) == sorted(expected) and ok == {True}


def test_reversed_range(spark):
    paths, ok = expand(spark, "1N.1E.[3-1] 1N.1E.2.[C-A]")
    assert sorted(paths) == sorted(["1N.1E.1", "1N.1E.2", "1N.1E.3", "1N.1E.2.A", "1N.1E.2.B", "1N.1E.2.C"])
    assert ok == {True}


def test_bad_specs(spark):
    for spec in ("7N.3E.[0-2]", "7N.3E.37", "X.Y", "16N.1E.4.AB", "1N.1E.2.[A-Q]"):
        _, ok = expand(spark, spec)
        assert ok == {False}, spec
