"""Oracle SQL: legacy qq columns, trs build, reports and the XML export."""

import re

from sectionmap import constants as K
from sectionmap.oracle.codecs import legacy_list_sql
from sectionmap.oracle.common import duckdb_with, maptype_values, rnum, rstr, source_values, tnum, tstr
from sectionmap.oracle.index import FILES, MAPS, SURV
from sectionmap.oracle.parser import parser_ctes
from sectionmap.sources.fixtures import FIXTURES

_BITS = "CASE n " + " ".join(f"WHEN {i + 1} THEN {b}" for i, b in enumerate(K.LEGACY_QQ_BITS)) + " END"


def _qq_tags():
    """(tag, tshp, rng, sec) of the qq columns of the f_qq fixture."""
    out = []
    for tag in re.findall(r"`(_x\w+)`", FIXTURES["f_qq"]):
        code = chr(int(tag[2:6], 16)) + tag[7:]
        t, r, s = code[0:3], code[3:5], int(code[5:7])
        tn = int(t[:-1]) - 1 if t[-1] == "N" else -int(t[:-1])
        rn = int(r[:-1]) - 1 if r[-1] == "E" else -int(r[:-1])
        out.append((tag, tn, rn, s))
    return out


QQ = f"""qu AS (UNPIVOT f_qq ON COLUMNS(* EXCLUDE (id)) INTO NAME column_name VALUE qq),
qn AS (SELECT map_id, code, TRY_CAST(n AS INTEGER) AS n FROM (
  SELECT id AS map_id, lower(substr(column_name, 8)) AS code, unnest(string_split(trim(qq, ','), ',')) AS n
  FROM qu WHERE qq IS NOT NULL)),
qq AS (
  SELECT map_id, {tnum("regexp_extract(code, '(\\d+[ns])', 1)")} AS tshp, {rnum("regexp_extract(code, '\\d+[ns](\\d+[ew])', 1)")} AS rng,
    TRY_CAST(nullif(regexp_extract(code, '\\d+[ns]\\d+[ew](\\d+)', 1), '') AS INTEGER) AS sec, CAST(sum({_BITS}) AS INTEGER) AS subsec
  FROM qn WHERE n IS NOT NULL GROUP BY ALL)"""


def rollup(src: str, sources: str, unknown: bool = False) -> str:
    t = f"lpad({tstr('tshp')}, 3, '0')"
    r = rstr("rng")
    if unknown:
        t, r = f"coalesce({t}, '0')", f"coalesce({r}, '0')"
    return f"""SELECT map_id, {t} AS tshp, {r} AS rng, ',' || string_agg(CAST(sec AS VARCHAR), ',' ORDER BY sec) || ',' AS sec,
  tshp AS _t, rng AS _r
FROM (SELECT DISTINCT map_id, tshp, rng, sec FROM {src} WHERE source_id IN ({sources})) GROUP BY map_id, tshp, rng"""


SHEET_TRS = K.SHEET_TRS
SHEET = f"""sp AS (SELECT maptype, book, page, unnest(regexp_split_to_array(trs, ',\\s*')) AS part FROM f_sheet),
s4 AS (
  SELECT mk.map_id, {tnum(f"regexp_extract(part, '{SHEET_TRS}', 3)")} AS tshp, {rnum(f"regexp_extract(part, '{SHEET_TRS}', 4)")} AS rng,
    TRY_CAST(nullif(regexp_extract(part, '{SHEET_TRS}', 2), '') AS INTEGER) AS sec, nm.bits AS subsec, 4 AS source_id
  FROM sp JOIN mk ON mk.maptype_name = sp.maptype AND mk.book = sp.book AND mk.page = sp.page
  LEFT JOIN subsec_names nm ON nm.str = regexp_replace(upper(trim(nullif(regexp_extract(part, '{SHEET_TRS}', 1), ''))), '\\s\\s', ' ', 'g')
  WHERE regexp_matches(part, '{SHEET_TRS}'))"""

from sectionmap.oracle.common import subsec_names_values  # noqa: E402

_MAPS_WITH = duckdb_with("f_legacy_map", "f_sheet", "f_pm", "f_tract", "f_qq", "f_trs") + ",\n" + maptype_values() \
    + ",\n" + subsec_names_values() + ",\n" + MAPS

TRS_BUILD = _MAPS_WITH + ",\n" + QQ + ",\n" + SHEET + f""",
ht AS ({rollup('f_trs', '0, 1, 2, 3, 4')}),
s0 AS (SELECT map_id, {tnum('tshp')} AS tshp, {rnum('rng')} AS rng, TRY_CAST(s AS INTEGER) AS sec, CAST(NULL AS INTEGER) AS subsec, 0 AS source_id
       FROM (SELECT map_id, tshp, rng, unnest(string_split(trim(sec, ','), ',')) AS s FROM ht)),
base AS (SELECT * FROM s0 UNION ALL SELECT map_id, tshp, rng, sec, subsec, 1 FROM qq UNION ALL SELECT * FROM s4),
pmaps AS (SELECT id, description FROM maps WHERE description IS NOT NULL),
{parser_ctes('pmaps', 'base')}
SELECT * FROM base UNION ALL SELECT map_id, tshp, rng, sec, subsec, 3 FROM cls WHERE status = 'accepted'"""

_TAGS = _qq_tags()
_SEC_VALUES = "secl(tag, t, r, s) AS (VALUES " + ", ".join(f"('{a}', {b}, {c}, {d})" for a, b, c, d in _TAGS) + ")"
_PIVOT = ", ".join(f"string_agg(qq, ';' ORDER BY qq) FILTER (WHERE tag = '{t}') AS \"{t}\"" for t, *_ in _TAGS)
_PIVOT_COLS = ", ".join(f'w."{t}"' for t, *_ in _TAGS)
EXPORT_MAPS = duckdb_with("f_legacy_map", "f_sheet", "f_pm", "f_tract", "f_qq", "f_alias", "f_pdf", "f_file", "f_scan") \
    + ",\n" + maptype_values() + ",\n" + MAPS + ",\n" + FILES + ",\n" + SURV + ",\n" + QQ + ",\n" + _SEC_VALUES + f""",
qqe AS (SELECT q.map_id, l.tag, {legacy_list_sql('q.subsec')} AS qq FROM qq q JOIN secl l ON l.t = q.tshp AND l.r = q.rng AND l.s = q.sec),
w AS (SELECT map_id, {_PIVOT} FROM qqe GROUP BY map_id),
sl AS (SELECT m.id AS map_id, coalesce(string_agg(d.display, ' & ' ORDER BY concat_ws(' ', d.lastname, d.display)), 'UNKNOWN') AS surveyors
       FROM maps m LEFT JOIN signed_by sb ON sb.map_id = m.id LEFT JOIN disp d ON d.id = sb.surveyor_id GROUP BY m.id),
pd AS (SELECT map_id, max(path) AS pdffile FROM pdfs WHERE map_id IS NOT NULL GROUP BY map_id)
SELECT m.id AS "ID", mk.maptype_name AS maptype, m.book AS "BOOK", m.page AS "FIRSTPAGE", m.page + m.npages - 1 AS "LASTPAGE",
  strftime(m.recdate, '%Y-%m-%dT00:00:00') AS "RECDATE", sl.surveyors AS "SURVEYOR", m.client AS "DONEFOR",
  m.description AS "DESCRIP", pd.pdffile AS "Picture", {_PIVOT_COLS}
FROM maps m JOIN mk ON mk.map_id = m.id LEFT JOIN sl ON sl.map_id = m.id LEFT JOIN pd ON pd.map_id = m.id
LEFT JOIN w ON w.map_id = m.id"""

_T = duckdb_with("f_trs")
_CHECKS = " UNION ALL ".join(
    f"SELECT '{n}' AS \"check\", count(*) FILTER (WHERE NOT ({c} BETWEEN {lo} AND {hi})) AS violations FROM f_trs"
    for (n, (lo, hi)), c in zip(K.TRS_CHECKS.items(), ("tshp", "rng", "sec", "subsec")))

SQL = {
    "qq_unpivot": duckdb_with("f_qq") + ",\n" + QQ + "\nSELECT * FROM qq",
    "qq_cells_by_source": _T + ",\n" + source_values() + """
SELECT t.source_id, s.description, count(*) AS nrec, CAST(sum(bit_count(t.subsec & 65535)) AS BIGINT) AS bits
FROM f_trs t JOIN source s ON s.id = t.source_id WHERE t.subsec IS NOT NULL GROUP BY t.source_id, s.description""",
    "qq_sum_vs_or": duckdb_with("f_qq") + f""",
qu AS (UNPIVOT f_qq ON COLUMNS(* EXCLUDE (id)) INTO NAME column_name VALUE qq),
qn AS (SELECT id, column_name, TRY_CAST(n AS INTEGER) AS n FROM (
  SELECT id, column_name, unnest(string_split(trim(qq, ','), ',')) AS n FROM qu WHERE qq IS NOT NULL)),
g AS (SELECT id, column_name, sum({_BITS}) AS s, bit_or({_BITS}) AS o FROM qn GROUP BY id, column_name)
SELECT count(*) AS n_groups, count(*) FILTER (WHERE s <> o) AS n_differ FROM g""",
    "trs_build": TRS_BUILD,
    "trs_sheet_parse": _MAPS_WITH + ",\n" + SHEET + "\nSELECT * FROM s4",
    "trs_redundancy": _T + """
SELECT nrecs, count(*) AS sec_refs, nrecs * count(*) AS trs_recs, CAST(sum(nrecs - 1) AS BIGINT) AS redundant
FROM (SELECT count(*) AS nrecs FROM f_trs GROUP BY map_id, tshp, rng, sec) GROUP BY nrecs""",
    "trs_rollup": _T + f", r AS ({rollup('f_trs', '0, 1')})\nSELECT map_id, tshp, rng, sec FROM r",
    "trs_rollup_head": _T + f", r AS ({rollup('f_trs', '0, 1')})\nSELECT map_id, tshp, rng, sec, rank FROM (SELECT *, CAST(row_number() OVER (PARTITION BY _t, _r ORDER BY map_id) AS INTEGER) AS rank FROM r) x WHERE rank <= 100",
    "trs_extent": _T + f"""
SELECT {tstr('max(tshp)')} AS t_max, {tstr('min(tshp)')} AS t_min, {rstr('max(rng)')} AS r_max, {rstr('min(rng)')} AS r_min FROM f_trs""",
    "trs_range_checks": _T + f"""
{_CHECKS}
UNION ALL SELECT 'single_rec_per_sec', count(*) FILTER (WHERE n > 1) FROM (SELECT count(*) AS n FROM f_trs GROUP BY map_id, tshp, rng, sec)""",
    "export_maps": EXPORT_MAPS,
    "xml_roundtrip": EXPORT_MAPS,
    "export_trs": _T + f""", r AS ({rollup('f_trs', '0', True)})
SELECT map_id AS "ID", tshp AS "TOWNSHIP", rng AS "RANGE", sec AS "SECTION" FROM r""",
    "export_diff": _T + f""", a AS ({rollup('f_trs', '0', True)}), b AS ({rollup('f_trs', '0, 1', True)})
SELECT coalesce(a.map_id, b.map_id) AS "ID", coalesce(a.tshp, b.tshp) AS "TOWNSHIP", coalesce(a.rng, b.rng) AS "RANGE",
  CASE WHEN a.map_id IS NULL THEN 'missing' WHEN b.map_id IS NULL THEN 'extra' WHEN a.sec IS NOT DISTINCT FROM b.sec THEN 'same' ELSE 'changed' END AS status,
  a.sec AS export_value, b.sec AS check_value
FROM a FULL OUTER JOIN b ON a.map_id IS NOT DISTINCT FROM b.map_id AND a.tshp IS NOT DISTINCT FROM b.tshp AND a.rng IS NOT DISTINCT FROM b.rng""",
}
