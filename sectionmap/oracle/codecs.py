"""Oracle SQL: codecs."""

from sectionmap import constants as K
from sectionmap.oracle.common import duckdb_with, maptype_values, rnum, rstr, subsec_names_values, tnum, tstr


def _case_map(key: str, table: dict) -> str:
    return "(CASE " + " ".join(f"WHEN {key} = '{k}' THEN {v}" for k, v in table.items()) + " END)"


def subsec_bits_sql(s: str) -> str:
    """DuckDB spelling of the algebraic subsection parser."""
    q4, q2, q24 = (r"'^(?:([NS][EW])/4\s+)?([NS][EW])/4\z'", r"'^(?:([NSEW])/2\s+)?([NSEW])/2\z'",
                   r"'^([NSEW])/2\s+([NS][EW])/4\z'")

    def g(p, i):
        return f"nullif(regexp_extract({s}, {p}, {i}), '')"

    def comb(p, qi, qqi):
        outer = _case_map(g(p, qi), K.OUTER_MASKS)
        inner = _case_map(g(p, qqi), K.INNER_MASKS)
        return f"(CASE WHEN {g(p, qqi)} IS NULL THEN {outer} ELSE {outer} & {inner} END)"

    perp = (f"(({g(q2, 2)} IN ('N','S') AND {g(q2, 1)} IN ('E','W')) OR "
            f"({g(q2, 2)} IN ('E','W') AND {g(q2, 1)} IN ('N','S')))")
    return (f"(CASE WHEN {s} = '1/1' THEN 65535 "
            f"WHEN regexp_matches({s}, {q4}) THEN {comb(q4, 2, 1)} "
            f"WHEN regexp_matches({s}, {q2}) AND {perp} THEN NULL "
            f"WHEN regexp_matches({s}, {q2}) THEN {comb(q2, 2, 1)} "
            f"WHEN regexp_matches({s}, {q24}) THEN {comb(q24, 2, 1)} END)")


def cover_sql(v: str) -> str:
    pats = "[" + ", ".join(f"{{'bits': {b}, 'name': '{n}'}}" for b, n, _ in K.SUBSEC_NAMES) + "]"
    red = (f"list_reduce({pats}, lambda acc, p: CASE WHEN (acc.v & p.bits) = p.bits "
           f"THEN {{'v': acc.v & ~p.bits, 'o': list_append(acc.o, p.name)}} ELSE acc END, "
           f"{{'v': ({v}) & 65535, 'o': []::VARCHAR[]}}).o")
    return f"(CASE WHEN (({v}) & 65535) = 0 THEN NULL ELSE {red} END)"


def legacy_list_sql(v: str) -> str:
    nums = "[" + ", ".join(str(n) for n in K.LEGACY_QQ_OF_BIT) + "]"
    picked = f"list_transform(list_filter(range(16), lambda i: (({v}) >> i) & 1 = 1), lambda i: {nums}[i + 1])"
    return f"(CASE WHEN {v} IS NULL THEN NULL ELSE ',' || array_to_string(list_sort({picked}), ',') || ',' END)"


_PARTS = duckdb_with("f_desc") + f""",
parts AS (
  SELECT regexp_replace(token, '(?i)\\s*S\\d+\\z', '') AS part FROM (
    SELECT unnest(regexp_extract_all(description, '(?i){K.SUBSEC_TOKEN}', 0)) AS token FROM f_desc))"""

SQL = {
    "codec_township_range": duckdb_with("f_trs") + f"""
SELECT tshp, rng, {tstr('tshp')} AS t_str, {rstr('rng')} AS r_str,
  {tnum("'t' || lower(" + tstr('tshp') + ")")} AS t_back, {rnum("'R' || " + rstr('rng'))} AS r_back, count(*) AS n
FROM f_trs GROUP BY tshp, rng""",
    "codec_subsec_names": duckdb_with("f_trs") + ", " + subsec_names_values() + """
SELECT s.str AS name, count(*) AS n, count(DISTINCT t.subsec) AS n_bitmaps
FROM f_trs t LEFT JOIN subsec_names s ON s.bits = t.subsec WHERE t.subsec IS NOT NULL GROUP BY s.str""",
    "subsec_lookup": _PARTS + ", " + subsec_names_values() + """
SELECT p.part, s.bits, p.n FROM (SELECT part, count(*) AS n FROM parts GROUP BY part) p
LEFT JOIN subsec_names s ON s.str = regexp_replace(upper(trim(p.part)), '\\s\\s', ' ', 'g')""",
    "subsec_algebra": _PARTS + f"""
SELECT part, {subsec_bits_sql('part')} AS bits, count(*) AS n FROM parts GROUP BY part""",
    "subsec_cover": duckdb_with("f_trs") + f"""
SELECT subsec, array_to_string({cover_sql('subsec')}, ', ') AS cover, count(*) AS n
FROM f_trs WHERE subsec IS NOT NULL GROUP BY subsec""",
    "map_names": duckdb_with("f_map") + ", " + maptype_values() + """
SELECT m.id, lpad(CAST(m.book AS VARCHAR), 3, '0') || lower(t.abbrev) || lpad(CAST(m.page AS VARCHAR), 3, '0') AS map_name
FROM f_map m JOIN maptype t ON m.maptype_id = t.id""",
    "legacy_qq_lists": duckdb_with("f_trs") + f"""
SELECT subsec, {legacy_list_sql('subsec')} AS qq_list, count(*) AS n
FROM f_trs WHERE source_id = 1 AND subsec IS NOT NULL GROUP BY subsec""",
}
