"""The exact search pre-filter never changes an answer."""

import random


from sectionmap.functions import path_in_subtree, path_level, path_parent
from sectionmap.operators.paths import path_index
from sectionmap.operators.search import maps_in_subtree, maps_on_paths, restrict_to_paths
from sectionmap.sources.fixtures import Inputs
from tests.conftest import SF001


def _random_paths(rnd, n):
    out = []
    for _ in range(n):
        t = f"{rnd.randint(1, 15)}N" if rnd.random() < 0.8 else f"{rnd.randint(1, 5)}S"
        r = f"{rnd.randint(1, 8)}E" if rnd.random() < 0.7 else f"{rnd.randint(1, 3)}W"
        p = f"{t}.{r}.{rnd.randint(1, 36)}"
        if rnd.random() < 0.6:
            p += "." + chr(65 + rnd.randint(0, 15))
        out.append(p)
    return out


def test_prefilter_is_exact(spark):
    trs = Inputs(spark, SF001).f_trs
    full = path_index(trs)
    rnd = random.Random(11)
    for _ in range(4):
        paths = _random_paths(rnd, 40)
        a = maps_on_paths(full, paths)
        b = maps_on_paths(path_index(restrict_to_paths(trs, paths)), paths)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    for root in ("5N.1W", "1S.3W", "15N.8E"):
        a = maps_in_subtree(full, root)
        b = maps_in_subtree(path_index(restrict_to_paths(trs, [root])), root)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_path_predicates(spark):
    df = spark.createDataFrame([("5N.1W.25.A",), ("5N.1W.25",), ("5N.1W",), ("5N.1WX.2",), ("15N.1W.3",)], "p string")
    out = {r["p"]: (r["lvl"], r["par"], r["sub"]) for r in df.select(
        "p", path_level("p").alias("lvl"), path_parent("p").alias("par"),
        path_in_subtree("p", "5N.1W").alias("sub")).collect()}
    assert out["5N.1W.25.A"] == (4, "5N.1W.25", True)
    assert out["5N.1W.25"] == (3, "5N.1W.25", True)
    assert out["5N.1W"] == (2, "5N.1W", True)
    assert out["5N.1WX.2"][2] is False and out["15N.1W.3"][2] is False
