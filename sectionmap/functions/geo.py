"""Township / range codecs, hierarchical trs paths and the path validator."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from sectionmap import constants as K
from sectionmap.functions._util import col


def _grid_number(s, prefix: str, pos: str, neg: str) -> Column:
    # Whole-string match, any case, optional prefix letter.  ``\z`` is the
    # true end of the text (Java's ``$`` would also accept a trailing newline).
    # One regex test; the digits are the text without its letters, the
    # hemisphere its last character -- small code inside whole-stage codegen.
    up = F.upper(col(s))
    valid = up.rlike(rf"^{prefix}?\d+[{pos}{neg}]\z")
    num = F.regexp_replace(up, r"[^0-9]", "").try_cast("int")
    hemi = F.substring(up, -1, 1)
    return (F.when(~valid | (num == 0), F.lit(None).cast("int"))
            .when(hemi == pos, num - 1)
            .otherwise(-num))


def township_number(s) -> Column:
    """'T1N' -> 0, '2N' -> 1, 'T1S' -> -1; '0N' and anything else -> NULL."""
    return _grid_number(s, "T", "N", "S")


def range_number(s) -> Column:
    """'R1E' -> 0, '2E' -> 1, 'R1W' -> -1; '0E' and anything else -> NULL."""
    return _grid_number(s, "R", "E", "W")


def _grid_str(v, pos: str, neg: str) -> Column:
    v = col(v)
    return (F.when(v.between(0, 98), F.concat((v + 1).cast("string"), F.lit(pos)))
            .when(v.between(-99, -1), F.concat((-v).cast("string"), F.lit(neg))))


def township_str(v) -> Column:
    """0 -> '1N', -1 -> '1S'; outside -99..98 -> NULL."""
    return _grid_str(v, "N", "S")


def range_str(v) -> Column:
    """0 -> '1E', -1 -> '1W'; outside -99..98 -> NULL."""
    return _grid_str(v, "E", "W")


def trs_path_base(tshp, rng, sec) -> Column:
    """'5N.1W.25'; NULL parts are skipped, as concat_ws does."""
    return F.concat_ws(".", township_str(tshp), range_str(rng), col(sec).cast("string"))


def trs_paths(tshp, rng, sec, subsec) -> Column:
    """array<string> of the paths of one trs record.

    A NULL bitmap gives the section path; otherwise one 4-level path per set
    bit (letter A..P for bit 0..15); a bitmap of 0 gives none.
    """
    base = trs_path_base(tshp, rng, sec)
    bits = col(subsec)
    cells = F.transform(
        F.filter(F.sequence(F.lit(0), F.lit(15)),
                 lambda i: F.getbit(bits, i) == 1),
        lambda i: F.concat(base, F.lit("."), F.char(i + 65)))
    return F.when(bits.isNull(), F.array(base)).otherwise(cells)


def path_level(p) -> Column:
    """Number of labels of a path (ltree nlevel)."""
    return F.size(F.split(col(p), r"\."))


def path_parent(p, levels: int = 3) -> Column:
    """The first ``levels`` labels of a path (ltree subpath(p, 0, levels))."""
    return F.substring_index(col(p), ".", levels)


def path_in_subtree(p, root: str) -> Column:
    """``p <@ root``: p equals root or lies below it.  Pushed to Parquet as
    Or(EqualTo, StringStartsWith)."""
    p = col(p)
    return (p == F.lit(root)) | p.startswith(root + ".")


def validate_path(p) -> Column:
    """True when p is a path inside the county's grid bounds.

    Township 1..15 N or 1..5 S, range 1..8 E or 1..3 W, section 1..36 and an
    optional cell letter A..P.
    """
    p = col(p)
    pattern = r"^(\d{1,2})([NS])\.(\d)([EW])\.(\d{1,2})(?:\.[A-P])?\z"
    t = F.regexp_extract(p, pattern, 1).try_cast("int")
    th = F.regexp_extract(p, pattern, 2)
    r = F.regexp_extract(p, pattern, 3).try_cast("int")
    rh = F.regexp_extract(p, pattern, 4)
    s = F.regexp_extract(p, pattern, 5).try_cast("int")
    south_ok = (th == "S") & (t.between(1, K.TOWNSHIP_SOUTH_MAX)) & (F.length(F.regexp_extract(p, pattern, 1)) == 1)
    north_ok = (th == "N") & t.between(1, K.TOWNSHIP_NORTH_MAX)
    east_ok = (rh == "E") & r.between(1, K.RANGE_EAST_MAX)
    west_ok = (rh == "W") & r.between(1, K.RANGE_WEST_MAX)
    ok = p.rlike(pattern) & (north_ok | south_ok) & (east_ok | west_ok) & s.between(1, 36)
    return F.coalesce(ok, F.lit(False))
