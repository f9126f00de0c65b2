"""Quarter-quarter (qq) bitmaps: names, the algebraic parser, the greedy
cover and the legacy 1..16 numbering.  All are literal-driven native
expressions, so Catalyst folds them and keeps them inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from sectionmap import constants as K
from sectionmap.functions._util import col


def _name_to_bits() -> Column:
    return F.create_map(*[x for bits, name, _ in K.SUBSEC_NAMES for x in (F.lit(name), F.lit(bits))])


def _bits_to_name() -> Column:
    return F.create_map(*[x for bits, name, _ in K.SUBSEC_NAMES for x in (F.lit(bits), F.lit(name))])


def subsec_bits_lookup(s) -> Column:
    """Name -> bitmap by table lookup: upper case, trimmed, every *pair* of
    white-space characters folded to one space, then an exact name match."""
    norm = F.regexp_replace(F.upper(F.trim(col(s))), r"\s\s", " ")
    return _name_to_bits()[norm]


def subsec_name(bits) -> Column:
    """Bitmap -> name when the bitmap is exactly one named pattern, else NULL."""
    return _bits_to_name()[col(bits)]


def _mask(table: dict, key: Column) -> Column:
    return F.create_map(*[x for k, v in table.items() for x in (F.lit(k), F.lit(v))])[key]


QUARTERS = ("NE", "SE", "SW", "NW")
HALVES = ("N", "S", "E", "W")


def algebra_domain() -> dict[str, int]:
    """Every text the algebraic parser accepts (terms separated by one blank)
    with its bitmap, generated from the masks:

    * ``1/1`` -> the whole section;
    * ``q/4`` and ``x/2``           -> outer(q);
    * ``qq/4 q/4``, ``xx/2 x/2``    -> outer(right) & inner(left), except
      perpendicular halves such as ``N/2 E/2``;
    * ``x/2 q/4``                   -> outer(q) & inner(x).
    """
    o, i = K.OUTER_MASKS, K.INNER_MASKS
    dom = {"1/1": 0xFFFF}
    for q in QUARTERS:
        dom[f"{q}/4"] = o[q]
        for qq in QUARTERS:
            dom[f"{qq}/4 {q}/4"] = o[q] & i[qq]
        for x in HALVES:
            dom[f"{x}/2 {q}/4"] = o[q] & i[x]
    ns = ("N", "S")
    for x in HALVES:
        dom[f"{x}/2"] = o[x]
        for xx in HALVES:
            if (x in ns) == (xx in ns):
                dom[f"{xx}/2 {x}/2"] = o[x] & i[xx]
    return dom


_DOMAIN = algebra_domain()


def subsec_bits(s) -> Column:
    """Algebraic name -> bitmap (case sensitive).

    ``1/1`` is the whole section; ``[xx/4 ]xx/4``, ``[x/2 ]x/2`` and
    ``x/2 xx/4`` combine the right term's outer mask with the left term's
    inner mask.  Perpendicular halves (``N/2 E/2``) and anything else -> NULL.
    The accepted language is finite (49 forms, terms separated by white
    space), so the parser is one white-space fold and a lookup in a literal map
    built from the masks -- no per-row regex groups.
    """
    table = F.create_map(*[x for k, v in _DOMAIN.items() for x in (F.lit(k), F.lit(v))])
    return table[F.regexp_replace(col(s), r"\s+", " ")]


def subsec_bits_list(names) -> Column:
    """OR of ``subsec_bits`` over an array of names, read left to right:
    ``1/1`` ends the list with the whole section, an unparsable member ends it
    with NULL."""
    start = F.struct(F.lit(0).alias("bits"), F.lit(False).alias("stop"))

    def step(acc, name):
        parsed = subsec_bits(name)
        return (F.when(acc["stop"], acc)
                .when(name == "1/1", F.struct(F.lit(0xFFFF).alias("bits"), F.lit(True).alias("stop")))
                .when(parsed.isNull(), F.struct(F.lit(None).cast("int").alias("bits"), F.lit(True).alias("stop")))
                .otherwise(F.struct(acc["bits"].bitwiseOR(parsed).alias("bits"), F.lit(False).alias("stop"))))

    return F.aggregate(col(names), start, step)["bits"]


def subsec_cover(bits) -> Column:
    """Greedy cover of a bitmap by named patterns, as array<string>.

    Patterns are tried in their listed order (16, 8, 4, 2, 1 cells); when all
    bits of a pattern are still set it is emitted and cleared.  A bitmap of 0
    (after masking to 16 bits) gives NULL.
    """
    v = col(bits).bitwiseAND(F.lit(0xFFFF))
    patterns = F.array(*[F.struct(F.lit(b).alias("bits"), F.lit(n).alias("name"))
                         for b, n, _ in K.SUBSEC_NAMES])
    start = F.struct(v.alias("v"), F.array().cast("array<string>").alias("out"))

    def step(acc, p):
        hit = acc["v"].bitwiseAND(p["bits"]) == p["bits"]
        return F.struct(
            F.when(hit, F.bitwise_not(p["bits"]).bitwiseAND(acc["v"])).otherwise(acc["v"]).alias("v"),
            F.when(hit, F.array_append(acc["out"], p["name"])).otherwise(acc["out"]).alias("out"))

    out = F.aggregate(patterns, start, step)["out"]
    return F.when(v == 0, F.lit(None).cast("array<string>")).otherwise(out)


def legacy_qq_bit(n) -> Column:
    """Legacy qq number 1..16 -> bit; anything else -> NULL."""
    return F.create_map(*[x for i, b in enumerate(K.LEGACY_QQ_BITS) for x in (F.lit(i + 1), F.lit(b))])[col(n)]


def legacy_qq_list(bits) -> Column:
    """Bitmap -> sorted legacy numbers as ``,1,2,``; NULL bitmap -> NULL."""
    b = col(bits)
    nums = F.array(*[F.lit(n) for n in K.LEGACY_QQ_OF_BIT])
    picked = F.transform(
        F.filter(F.sequence(F.lit(0), F.lit(15)),
                 lambda i: F.getbit(b, i) == 1),
        lambda i: F.element_at(nums, i + 1))
    text = F.concat(F.lit(","), F.array_join(F.array_sort(picked).cast("array<string>"), ","), F.lit(","))
    return F.when(b.isNull(), F.lit(None).cast("string")).otherwise(text)


def popcount16(bits) -> Column:
    """Number of set bits among the low 16 bits."""
    return F.bit_count(col(bits).bitwiseAND(F.lit(0xFFFF)))

