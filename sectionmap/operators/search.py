"""Location searches: by sections, by qq mask, by path list, by subtree and by
boxes spanning several townships; batch searches from path specs; and the
comparison of two answers."""

from __future__ import annotations

from functools import reduce
from typing import Iterable, Sequence

from pyspark.sql import DataFrame, Window, functions as F

from sectionmap.functions.geo import path_in_subtree, range_number, township_number


def _grid(township: str, range_: str):
    # Codec over a literal: Catalyst folds it to a constant before the scan.
    return township_number(F.lit(township)), range_number(F.lit(range_))


def maps_in_sections(trs: DataFrame, township: str, range_: str,
                     sections: Iterable[int] | None = None) -> DataFrame:
    """Distinct maps with a record in the township/range (optionally in the sections)."""
    t, r = _grid(township, range_)
    cond = (F.col("tshp") == t) & (F.col("rng") == r)
    if sections is not None:
        cond = cond & F.col("sec").isin(list(sections))
    return trs.filter(cond).select("map_id").distinct()


def _box(township: str, range_: str, sec: int, mask: int):
    t, r = _grid(township, range_)
    return ((F.col("tshp") == t) & (F.col("rng") == r) & (F.col("sec") == sec)
            & (F.col("subsec").bitwiseAND(F.lit(mask)) > 0))


def maps_in_mask(trs: DataFrame, township: str, range_: str, sec: int, mask: int) -> DataFrame:
    """Distinct maps with a qq cell of ``mask`` in one section (NULL bitmaps never match)."""
    return trs.filter(_box(township, range_, sec, mask)).select("map_id").distinct()


def maps_in_boxes(trs: DataFrame, boxes: Sequence[tuple[str, str, int, int]]) -> DataFrame:
    """Distinct maps touching any of the (township, range, section, mask) boxes."""
    cond = reduce(lambda a, b: a | b, [_box(*b) for b in boxes])
    return trs.filter(cond).select("map_id").distinct()


def _path_keys(paths: Sequence[str]) -> list[tuple[int, int, int | None]]:
    """(tshp, rng, sec) of valid search paths ('5N.1W.25[.A]' or the subtree
    root '5N.1W' with sec None), read on the driver from the literal list."""
    def num(label, pos):
        n, h = int(label[:-1]), label[-1]
        return n - 1 if h == pos else -n
    keys = []
    for p in paths:
        parts = p.split(".")
        keys.append((num(parts[0], "N"), num(parts[1], "E"), int(parts[2]) if len(parts) > 2 else None))
    return sorted(set(keys), key=str)


def restrict_to_paths(trs: DataFrame, paths: Sequence[str]) -> DataFrame:
    """Exact pre-filter of trs records for a search on valid paths.

    A path 'T.R.S[.X]' can only come from records with those township, range
    and section numbers (a record with an unnamed part yields a shorter path
    that never equals a valid one), and all records of one (map, T, R, S) stay
    together, so removing covered sections afterwards is unchanged.  On the
    published table the filter prunes township partitions.
    """
    keys = _path_keys(paths)
    conds = [(F.col("tshp") == t) & (F.col("rng") == r) & (F.lit(True) if s is None else F.col("sec") == s)
             for t, r, s in keys]
    return trs.filter(reduce(lambda a, b: a | b, conds))


def restrict_to_path_table(trs: DataFrame, paths: DataFrame, col: str = "trs_path") -> DataFrame:
    """The same pre-filter for a DataFrame of valid paths (a semi join on the
    integer keys; the key set is as large as the query, not the data)."""
    p = paths.select(F.split(F.col(col), r"\.").alias("_p"))
    keys = p.select(township_number(F.element_at("_p", 1)).alias("tshp"), range_number(F.element_at("_p", 2)).alias("rng"),
                    F.element_at("_p", 3).try_cast("int").alias("sec")).distinct()
    return trs.join(keys, ["tshp", "rng", "sec"], "left_semi")


def maps_on_paths(index: DataFrame, paths: Sequence[str]) -> DataFrame:
    """Distinct maps indexed under any of the given paths (``IN`` list)."""
    return index.filter(F.col("trs_path").isin(list(paths))).select("map_id").distinct()


def maps_in_subtree(index: DataFrame, root: str) -> DataFrame:
    """Distinct maps indexed at or below ``root`` (``trs_path <@ root``)."""
    return index.filter(path_in_subtree("trs_path", root)).select("map_id").distinct()


def box_paths(township: str, range_: str, sec: int, mask: int) -> list[str]:
    """The cell paths covered by a box (the path-side spelling of a box)."""
    return [f"{township}.{range_}.{sec}.{chr(65 + i)}" for i in range(16) if mask >> i & 1]


BOX_KEYS = ["tshp", "rng", "sec"]


def _spread(records: DataFrame, boxes: DataFrame, keys: list[str], splits: int) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``_slice``: the records of a hot key (a ``splits``-th of all or more, so at
    most ``splits`` keys) are dealt out by map, its boxes are copied to every slice."""
    counts = records.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("_all"))
    hot = counts.join(F.broadcast(total)).where(F.col("_n") * splits >= F.col("_all")).select(*keys, F.lit(True).alias("_hot"))
    hot = F.broadcast(hot)
    left = records.join(hot, keys, "left").withColumn("_slice", F.when(F.col("_hot"), F.pmod(F.xxhash64("map_id"), F.lit(splits))).otherwise(0)).drop("_hot")
    right = boxes.join(hot, keys, "left").withColumn(
        "_slice", F.explode(F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(splits - 1))).otherwise(F.array(F.lit(0))))).drop("_hot")
    return left, right.withColumn("_slice", F.col("_slice").cast("bigint"))


def maps_by_box(trs: DataFrame, boxes: DataFrame, splits: int = 16) -> DataFrame:
    """(box_id, map_id): maps with a cell in a box.  ``boxes`` has (box_id, tshp, rng, sec,
    mask), a box as many rows as it has sections.

    A join on the section with the overlap of the masks as residual; the records of a
    map's section are one bitmap before it, and hot sections are split."""
    cells = trs.where(F.col("subsec") != 0).groupBy("map_id", *BOX_KEYS).agg(F.bit_or("subsec").alias("_bits"))
    left, right = _spread(cells, boxes, BOX_KEYS, splits)
    found = left.join(right, [*BOX_KEYS, "_slice"]).where(F.col("_bits").bitwiseAND(F.col("mask")) != 0)
    return found.select("box_id", "map_id").distinct()


def maps_by_box_paths(index: DataFrame, boxes: DataFrame, whole: bool = True, splits: int = 16) -> DataFrame:
    """The same through the path index: maps filed under a cell path of a box and, with
    ``whole``, under the path of one of its sections."""
    from sectionmap.functions.geo import trs_path_base
    base = boxes.select("box_id", "mask", trs_path_base("tshp", "rng", "sec").alias("_base"))
    letters = F.transform(F.filter(F.sequence(F.lit(0), F.lit(15)), lambda i: F.getbit(F.col("mask"), i) == 1), lambda i: F.char(i + 65))
    cells = F.transform(letters, lambda x: F.concat(F.col("_base"), F.lit("."), x))
    paths = base.select("box_id", F.explode(F.concat(cells, F.array("_base")) if whole else cells).alias("trs_path")).distinct()
    left, right = _spread(index.select("map_id", "trs_path"), paths, ["trs_path"], splits)
    return left.join(right, ["trs_path", "_slice"]).select("box_id", "map_id").distinct()


def compare_by_box(boxes: DataFrame, a: DataFrame, b: DataFrame, names: tuple[str, str] = ("bitmap", "path")) -> DataFrame:
    """Per box the maps of both answers and of one only; a box without any has zeros.  The
    answers meet in one aggregation, no outer join."""
    x, y = names
    tagged = a.select("box_id", "map_id", F.lit(1).alias(x), F.lit(0).alias(y)).unionByName(
        b.select("box_id", "map_id", F.lit(0).alias(x), F.lit(1).alias(y)))
    tagged = tagged.groupBy("box_id", "map_id").agg(F.max(x).alias(x), F.max(y).alias(y))
    every = boxes.select("box_id", F.lit(None).cast("int").alias("map_id"), F.lit(0).alias(x), F.lit(0).alias(y)).distinct()
    return tagged.unionByName(every).groupBy("box_id").agg(
        F.sum(F.col(x) * F.col(y)).alias("n_both"), F.sum(F.col(x) * (1 - F.col(y))).alias(f"n_{x}_only"),
        F.sum((1 - F.col(x)) * F.col(y)).alias(f"n_{y}_only"))


def symmetric_difference(a: DataFrame, b: DataFrame, key: str = "map_id",
                         names: tuple[str, str] = ("a", "b")) -> DataFrame:
    """Keys found by only one of two answers, with the side that found them."""
    only_a = a.join(b, key, "left_anti").withColumn("side", F.lit(names[0]))
    only_b = b.join(a, key, "left_anti").withColumn("side", F.lit(names[1]))
    return only_a.unionByName(only_b)


# ---- batch searches from path specs (C14) --------------------------------------

SECTIONS_MAX = 36


def _items(inner, root, ok, to_int, to_text):
    """Paths of a list's items 'a' or 'a-b' (either order) below ``root``; an item
    whose ends are not ``ok`` is one NULL path, so nothing unchecked expands."""
    def one(it):
        ends = F.split(it, "-", -1)
        lo, hi = to_int(F.get(ends, F.lit(0))), to_int(F.element_at(ends, -1))
        run = F.transform(F.sequence(F.least(lo, hi), F.greatest(lo, hi)), lambda n: F.concat(root, to_text(n)))
        good = (F.size(ends) <= 2) & F.forall(ends, ok)
        return (F.when(~good, F.array(F.lit(None).cast("string")))
                .when(F.size(ends) == 2, run).otherwise(F.array(F.concat(root, it))))
    return F.flatten(F.transform(F.split(inner, ",", -1), one))


def _is_section(t):
    return F.coalesce(t.rlike(r"^[0-9]{1,9}\z") & t.try_cast("int").between(1, SECTIONS_MAX), F.lit(False))


def _is_cell(t):
    return F.length(t) == 1


def expand_specs(specs: DataFrame, spec_col: str = "spec", strict: bool = False) -> DataFrame:
    """C14: path specs -> one row per expanded path.

    A spec is blank-separated elements: a simple path ``4N.1W.7``, a section
    list ``4N.1W.[1-3,11]``, a cell list ``4N.1W.11.[A-F,I]`` or a cell run
    ``4N.1W.11.ABCD``; ranges may be given high to low.  Every path is checked
    by ``validate_path``; one bad path makes the whole spec bad
    (``spec_ok`` False) instead of raising; with ``strict`` the first bad element
    that a task meets raises an error that names it.  Ends of a range may have leading zeros.
    Output: spec, elem, path, valid, spec_ok.
    """
    from sectionmap.functions.geo import validate_path
    el = specs.select(spec_col, F.posexplode(F.split(F.trim(F.col(spec_col)), r"\s+")).alias("elem_pos", "elem"))
    e = F.col("elem")
    # Root and tail at the last dot; the root's depth tells sections from cells.
    tail = F.substring_index(e, ".", -1)
    root = F.substr(e, F.lit(1), F.length(e) - F.length(tail))
    depth = F.size(F.split(root, "[.]", -1)) - 1
    listed = F.startswith(tail, F.lit("[")) & F.endswith(tail, F.lit("]"))
    inner = F.substr(tail, F.lit(2), F.length(tail) - 2)
    cell = lambda t: _is_cell(t) & t.between("A", "P")
    paths = (F.when(validate_path(e), F.array(e))
             .when(listed & (depth == 2), _items(inner, root, _is_section, lambda x: x.try_cast("int"), lambda n: n.cast("string")))
             .when(listed & (depth == 3), _items(inner, root, cell, F.ascii, F.char))
             .when((depth == 3) & (F.length(tail) > 0), F.transform(
                 F.filter(F.split(tail, ""), lambda c: c != ""), lambda c: F.when(cell(c), F.concat(root, c))))
             .otherwise(F.array(F.lit(None).cast("string"))))
    out = el.select(spec_col, "elem", F.explode(paths).alias("path"))
    out = out.withColumn("valid", F.coalesce(validate_path(F.col("path")), F.lit(False)) & F.col("path").isNotNull())
    if strict:
        bad = F.raise_error(F.concat(F.lit("Bad path spec: "), F.coalesce("elem", F.lit("")))).cast("boolean")
        out = out.withColumn("valid", F.when(F.col("valid"), F.lit(True)).otherwise(bad))
    # One exchange on the spec; the paths of one spec are bounded by the spec text.
    return out.withColumn("spec_ok", F.min(F.col("valid").cast("int")).over(Window.partitionBy(spec_col)) == 1)


def search_specs_on_trs(trs: DataFrame, specs: DataFrame, spec_col: str = "spec") -> DataFrame:
    """Batch P9: (spec, map_id) for every valid spec and every map indexed under one of
    its paths.  The trs records are first restricted to the sections that the valid specs
    name, then only those are indexed; the join is on the path (AQE splits a hot one)."""
    from sectionmap.operators.paths import path_index
    ex = expand_specs(specs, spec_col).filter("spec_ok").select(spec_col, F.col("path").alias("trs_path")).distinct()
    idx = path_index(restrict_to_path_table(trs, ex))
    return ex.join(idx.select("trs_path", "map_id"), "trs_path").select(spec_col, "map_id").distinct()
