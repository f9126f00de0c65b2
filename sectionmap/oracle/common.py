"""DuckDB spellings of the codecs, shared by the oracle queries."""

from __future__ import annotations

from sectionmap import constants as K
from sectionmap.sources.fixtures import duckdb_with  # noqa: F401  (re-export)


def tstr(v: str) -> str:
    return (f"(CASE WHEN {v} BETWEEN 0 AND 98 THEN CAST({v} + 1 AS VARCHAR) || 'N' "
            f"WHEN {v} BETWEEN -99 AND -1 THEN CAST(-({v}) AS VARCHAR) || 'S' END)")


def rstr(v: str) -> str:
    return (f"(CASE WHEN {v} BETWEEN 0 AND 98 THEN CAST({v} + 1 AS VARCHAR) || 'E' "
            f"WHEN {v} BETWEEN -99 AND -1 THEN CAST(-({v}) AS VARCHAR) || 'W' END)")


def _num(s: str, prefix: str, pos: str, neg: str) -> str:
    pat = rf"'^{prefix}?(\d+)([{pos}{neg}])\z'"
    n = f"TRY_CAST(regexp_extract(upper({s}), {pat}, 1) AS INTEGER)"
    h = f"regexp_extract(upper({s}), {pat}, 2)"
    return (f"(CASE WHEN {n} = 0 THEN NULL WHEN {h} = '{pos}' THEN {n} - 1 "
            f"WHEN {h} = '{neg}' THEN -{n} END)")


def tnum(s: str) -> str:
    return _num(s, "T", "N", "S")


def rnum(s: str) -> str:
    return _num(s, "R", "E", "W")


def path_base(t: str, r: str, s: str) -> str:
    return f"concat_ws('.', {tstr(t)}, {rstr(r)}, CAST({s} AS VARCHAR))"


def paths_cte(src: str, name: str = "paths") -> str:
    """``name`` AS (map_id, trs_path, source_id) exploded from trs-shaped ``src``."""
    base = path_base("tshp", "rng", "sec")
    return f"""{name} AS (
  SELECT map_id, unnest(CASE WHEN subsec IS NULL THEN [{base}]
      ELSE list_transform(list_filter(range(16), lambda i: (subsec >> i) & 1 = 1),
                          lambda i: {base} || '.' || chr(CAST(65 + i AS INTEGER))) END) AS trs_path,
    source_id
  FROM {src})"""


def index_cte(paths: str = "paths", name: str = "idx") -> str:
    """``name``: paths without section paths covered by cells of the same map."""
    return f"""{name}_parents AS (
  SELECT DISTINCT map_id, array_to_string(string_split(trs_path, '.')[1:3], '.') AS p_path
  FROM {paths} WHERE len(string_split(trs_path, '.')) = 4),
{name} AS (
  SELECT p.* FROM {paths} p
  LEFT JOIN {name}_parents c ON c.map_id = p.map_id AND c.p_path = p.trs_path AND len(string_split(p.trs_path, '.')) = 3
  WHERE c.map_id IS NULL)"""


def subsec_names_values() -> str:
    rows = ", ".join(f"({b}, '{n}', {r}, {i})" for i, (b, n, r) in enumerate(K.SUBSEC_NAMES))
    return f"subsec_names(bits, str, rank, ord) AS (VALUES {rows})"


def maptype_values() -> str:
    rows = ", ".join(f"({i}, '{n}', '{a}')" for i, n, a in K.MAPTYPES)
    return f"maptype(id, maptype, abbrev) AS (VALUES {rows})"


def source_values() -> str:
    rows = ", ".join(f"({i}, '{d}', {q})" for i, d, q in K.SOURCES)
    return f"source(id, description, quality) AS (VALUES {rows})"
