"""Oracle SQL: path specs, HTML records, image plans, PDF manifest, checks."""

from sectionmap import constants as K
from sectionmap.constants import HEADING
from sectionmap.oracle.common import duckdb_with, index_cte, maptype_values, paths_cte, rstr, tstr
from sectionmap.oracle.index import CC, FILES, MAPS, SURV

VP = r"^(\d{1,2})([NS])\.(\d)([EW])\.(\d{1,2})(?:\.[A-P])?\z"


def valid_sql(p: str) -> str:
    g = lambda i: f"regexp_extract({p}, '{VP}', {i})"
    n = lambda i: f"TRY_CAST({g(i)} AS INTEGER)"
    return (f"coalesce(regexp_matches({p}, '{VP}') AND "
            f"(({g(2)} = 'N' AND {n(1)} BETWEEN 1 AND {K.TOWNSHIP_NORTH_MAX}) OR "
            f"({g(2)} = 'S' AND {n(1)} BETWEEN 1 AND {K.TOWNSHIP_SOUTH_MAX} AND length({g(1)}) = 1)) AND "
            f"(({g(4)} = 'E' AND {n(3)} BETWEEN 1 AND {K.RANGE_EAST_MAX}) OR ({g(4)} = 'W' AND {n(3)} BETWEEN 1 AND {K.RANGE_WEST_MAX})) AND "
            f"{n(5)} BETWEEN 1 AND 36, false)")


_SEC = "[CAST(n AS VARCHAR) FOR n IN range(1, 37)]"
_CELL = "string_split('ABCDEFGHIJKLMNOP', '')"


def _listed(names: str) -> str:
    """Paths of a bracket list whose item ends stand in the ordered list ``names``."""
    end = lambda i: f"list_position({names}, ltrim(string_split(it, '-')[{i}], '0'))"
    return (f"flatten(list_transform(string_split(tail[2:-2], ','), lambda it: CASE "
            f"WHEN len(string_split(it, '-')) > 2 OR {end(1)} IS NULL OR {end(-1)} IS NULL THEN [CAST(NULL AS VARCHAR)] "
            f"WHEN contains(it, '-') THEN list_transform({names}[least({end(1)}, {end(-1)}):greatest({end(1)}, {end(-1)})], lambda x: root || x) "
            f"ELSE [root || it] END))")


SPECS = f"""pairs AS (SELECT DISTINCT tshp, rng FROM f_trs),
roots AS (SELECT tshp, rng, {tstr('tshp')} || '.' || {rstr('rng')} || '.' AS root FROM pairs),
specs AS (SELECT root || '[1-3,11] ' || root || '7.[A-C,P] ' || root || '12.KLOP ' || root || '20 ' || root || '[36-34,007-8]'
            || CASE WHEN (tshp + rng) % 7 = 0 THEN ' ' || root || '40' ELSE '' END AS spec FROM roots),
els0 AS (SELECT spec, unnest(regexp_split_to_array(trim(spec), '\\s+')) AS elem FROM specs),
els AS (SELECT spec, elem, string_split(elem, '.')[-1] AS tail, elem[:len(elem) - len(string_split(elem, '.')[-1])] AS root,
          len(string_split(elem, '.')) - 1 AS depth FROM els0),
ex0 AS (SELECT spec, elem, unnest(CASE
    WHEN {valid_sql('elem')} THEN [elem]
    WHEN tail[1] = '[' AND tail[-1] = ']' AND depth = 2 THEN {_listed(_SEC)}
    WHEN tail[1] = '[' AND tail[-1] = ']' AND depth = 3 THEN {_listed(_CELL)}
    WHEN depth = 3 AND tail <> '' THEN list_transform(string_split(tail, ''),
      lambda c: CASE WHEN list_contains({_CELL}, c) THEN root || c END)
    ELSE [CAST(NULL AS VARCHAR)] END) AS path FROM els),
ex1 AS (SELECT *, {valid_sql('path')} AND path IS NOT NULL AS valid FROM ex0),
ex AS (SELECT *, bool_and(valid) OVER (PARTITION BY spec) AS spec_ok FROM ex1)"""

IDX = duckdb_with("f_trs") + ",\n" + paths_cte("f_trs") + ",\n" + index_cte()

_UNESC = lambda c: f"replace(replace(replace({c}, '&lt;', '<'), '&gt;', '>'), '&amp;', '&')"

HTML = duckdb_with("f_legacy_map", "f_sheet", "f_pm", "f_tract", "f_file", "f_scan", "f_pdf") + ",\n" + maptype_values() \
    + ",\n" + MAPS + ",\n" + FILES + """,
hm AS (
  SELECT mk.*, coalesce(h.surveyor, '') AS surveyors, coalesce(m.client, '') AS client, coalesce(m.description, '') AS description,
    coalesce(pd.pdf, '') AS pdf, mk.map_id % 23 <> 0 AS ok
  FROM mk JOIN maps m ON m.id = mk.map_id LEFT JOIN f_legacy_map h ON h.id = mk.map_id
  LEFT JOIN (SELECT map_id, max(path) AS pdf FROM pdfs WHERE map_id IS NOT NULL GROUP BY map_id) pd ON pd.map_id = mk.map_id),
bl AS (
  SELECT abbrev, book AS of_book, page AS of_page, 0 AS inner_no, ok, maptype_name AS maptype, book, page, npages, surveyors,
    strftime(recdate, '%Y-%m-%d') AS recdate, client, description, pdf FROM hm
  UNION ALL
  SELECT abbrev, book, page, 1, true, 'Inner Map', 1, 7, 3, '', '2001', '"x"', chr(160), 'in' FROM hm WHERE map_id % 8 = 2)
SELECT lower(abbrev) || '/' || lpad(CAST(of_book AS VARCHAR), CAST(greatest(length(CAST(of_book AS VARCHAR)), 3) AS INTEGER), '0') AS page_key,
  CAST(row_number() OVER (PARTITION BY abbrev, of_book ORDER BY of_page, inner_no) - 1 AS INTEGER) AS pos,
  CASE WHEN ok THEN maptype END AS maptype, CASE WHEN ok THEN book END AS book, CASE WHEN ok THEN page END AS page,
  CASE WHEN ok THEN npages END AS npages, CASE WHEN ok THEN surveyors END AS surveyors, CASE WHEN ok THEN recdate END AS recdate,
  CASE WHEN ok THEN client END AS client, CASE WHEN ok THEN description END AS description, CASE WHEN ok THEN pdf END AS pdf,
  CASE WHEN ok THEN 'ok' ELSE 'bad_heading' END AS status
FROM bl"""

FRAMES = duckdb_with("f_images", "f_cc_scan") + f""",
fr AS (SELECT src_file, frame, width_px, height_px, mode, regexp_extract(src_file, '^(\\d+)(\\D+)', 1) AS book,
         regexp_extract(src_file, '^(\\d+)(\\D+)', 2) AS maptype,
         CASE WHEN dpi = 96 THEN {K.DEFAULT_SCAN_DPI} ELSE dpi END AS scan_dpi FROM f_images),
fp AS (SELECT *, upper(maptype) IN ('PM', 'RM', 'RS') AND least(width_px, height_px) * 100 < scan_dpi * {K.CC_MIN_WIDTH_HUNDREDTHS} AS is_cc,
         regexp_replace(src_file, '\\.tif\\z', '') || '-' || lpad(CAST(frame AS VARCHAR), CAST(greatest(length(CAST(frame AS VARCHAR)), 3) AS INTEGER), '0') || '.tif' AS dest_file FROM fr)"""

MANIFEST = duckdb_with("f_map", "f_file", "f_cc_odd", "f_cc_file") + ",\n" + maptype_values() + r""",
imgs AS (SELECT nullif(regexp_extract(string_split(path, '/')[-1], '""" + K.MAP_PART + r"""', 1), '') AS map, path AS file FROM f_file),
docs0 AS (SELECT lpad(CAST(c.book AS VARCHAR), CAST(greatest(length(CAST(c.book AS VARCHAR)), 3) AS INTEGER), '0') || lower(t.abbrev) || lpad(CAST(c.page AS VARCHAR), CAST(greatest(length(CAST(c.page AS VARCHAR)), 3) AS INTEGER), '0') AS map, c.doc_number, c.npages, t.abbrev IS NULL AS unknown
          FROM f_cc_odd c LEFT JOIN maptype t ON t.maptype = c.maptype),
docs1 AS (SELECT map, npages, doc_number, unknown,
    CASE WHEN regexp_matches(doc_number, '^(\d+) OR (\d+)\z')
           THEN lpad(CAST(CAST(regexp_extract(doc_number, '^(\d+) OR (\d+)\z', 1) AS BIGINT) AS VARCHAR), CAST(greatest(length(CAST(CAST(regexp_extract(doc_number, '^(\d+) OR (\d+)\z', 1) AS BIGINT) AS VARCHAR)), 4) AS INTEGER), '0') || '-or-'
                || lpad(CAST(CAST(regexp_extract(doc_number, '^(\d+) OR (\d+)\z', 2) AS BIGINT) AS VARCHAR), CAST(greatest(length(CAST(CAST(regexp_extract(doc_number, '^(\d+) OR (\d+)\z', 2) AS BIGINT) AS VARCHAR)), 6) AS INTEGER), '0')
         WHEN regexp_matches(doc_number, '^(\d{4})-(\d+)-\d+\z')
           THEN lpad(CAST(CAST(regexp_extract(doc_number, '^(\d{4})-(\d+)-\d+\z', 1) AS BIGINT) AS VARCHAR), CAST(greatest(length(CAST(CAST(regexp_extract(doc_number, '^(\d{4})-(\d+)-\d+\z', 1) AS BIGINT) AS VARCHAR)), 4) AS INTEGER), '0') || '-doc-'
                || lpad(CAST(CAST(regexp_extract(doc_number, '^(\d{4})-(\d+)-\d+\z', 2) AS BIGINT) AS VARCHAR), CAST(greatest(length(CAST(CAST(regexp_extract(doc_number, '^(\d{4})-(\d+)-\d+\z', 2) AS BIGINT) AS VARCHAR)), 6) AS INTEGER), '0') END AS doc
  FROM docs0),
docs AS (SELECT * FROM docs1 WHERE NOT unknown AND doc IS NOT NULL AND upper(regexp_extract(map, '^\d+(\D{2})', 1)) IN ('PM', 'RM', 'RS') AND map IN (SELECT map FROM imgs WHERE map IS NOT NULL)),
ccf AS (SELECT nullif(regexp_extract(string_split(path, '/')[-1], '^(.*)-\d{3,}\.jpg\z', 1), '') AS doc, '/' || path AS file FROM f_cc_file),
d AS (SELECT docs.*, n.n_images, CASE WHEN n.n_images IS NULL THEN 'missing_cc' WHEN n.n_images <> docs.npages THEN 'bad_cc_pages' END AS issue
      FROM docs LEFT JOIN (SELECT doc, count(*) AS n_images FROM ccf GROUP BY doc) n ON n.doc = docs.doc),
pg AS (SELECT map, 0 AS part, CAST(NULL AS VARCHAR) AS doc, file FROM imgs WHERE map IS NOT NULL
       UNION ALL SELECT d.map, 1, d.doc, ccf.file FROM d JOIN ccf ON ccf.doc = d.doc WHERE d.issue IS NULL)"""

_CHECK_TABLES = duckdb_with("f_legacy_map", "f_sheet", "f_pm", "f_tract", "f_cc", "f_cc_file", "f_alias", "f_trs") + ",\n" \
    + maptype_values() + ",\n" + MAPS + ",\n" + CC + ",\n" + SURV


def _checks(maps: str, surveyor: str, signed_by: str, cc: str) -> str:
    return f"""
SELECT 'unknown_maptype' AS "check", count(*) AS violations FROM f_legacy_map WHERE maptype IS NOT NULL AND maptype NOT IN (SELECT maptype FROM maptype)
UNION ALL SELECT 'map_pk', count(*) FROM (SELECT id FROM {maps} GROUP BY id HAVING count(*) > 1)
UNION ALL SELECT 'surveyor_fullname_unique', count(*) FROM (SELECT fullname FROM {surveyor} GROUP BY fullname HAVING count(*) > 1)
UNION ALL SELECT 'alias_unique', count(*) FROM (SELECT legacy_name FROM f_alias GROUP BY legacy_name HAVING count(*) > 1)
UNION ALL SELECT 'alias_fk_surveyor', count(*) FROM f_alias WHERE fullname IS NOT NULL AND fullname NOT IN (SELECT fullname FROM {surveyor})
UNION ALL SELECT 'signed_by_pk', count(*) FROM (SELECT map_id, surveyor_id FROM {signed_by} GROUP BY ALL HAVING count(*) > 1)
UNION ALL SELECT 'signed_by_fk_map', count(*) FROM {signed_by} WHERE map_id NOT IN (SELECT id FROM {maps})
UNION ALL SELECT 'signed_by_fk_surveyor', count(*) FROM {signed_by} WHERE surveyor_id NOT IN (SELECT id FROM {surveyor})
UNION ALL SELECT 'trs_fk_map', count(*) FROM f_trs WHERE map_id IS NOT NULL AND map_id NOT IN (SELECT id FROM {maps})
UNION ALL SELECT 'cc_fk_map', count(*) FROM {cc} WHERE map_id IS NOT NULL AND map_id NOT IN (SELECT id FROM {maps})
UNION ALL SELECT 'cc_image_fk_cc', count(*) FROM cc_image WHERE cc_id IS NOT NULL AND cc_id NOT IN (SELECT cc_id FROM {cc})"""


CHECKS = _CHECK_TABLES + _checks("maps", "surveyor", "signed_by", "cc")
BROKEN = _CHECK_TABLES + """,
maps2 AS (SELECT * FROM (SELECT * FROM maps UNION ALL SELECT * FROM maps WHERE id % 101 = 0) x WHERE id % 103 <> 0),
surveyor2 AS (SELECT * FROM surveyor WHERE id % 29 <> 0 UNION ALL SELECT * FROM surveyor WHERE id % 31 = 0),
signed2 AS (SELECT * FROM signed_by UNION ALL SELECT * FROM signed_by WHERE map_id % 53 = 0),
cc2 AS (SELECT * FROM cc WHERE cc_id % 17 <> 0)""" + _checks("maps2", "surveyor2", "signed2", "cc2")

SQL = {
    "expanded_specs": duckdb_with("f_trs") + ",\n" + SPECS + "\nSELECT spec, elem, path, valid, spec_ok FROM ex",
    "search_specs": IDX + ",\n" + SPECS + """
SELECT DISTINCT e.spec, i.map_id FROM (SELECT DISTINCT spec, path FROM ex WHERE spec_ok) e JOIN idx i ON i.trs_path = e.path""",
    "path_validation": IDX + f"\nSELECT {valid_sql('trs_path')} AS valid, count(*) AS n FROM (SELECT DISTINCT trs_path FROM idx) GROUP BY ALL",
    "html_records": HTML,
    "page_headings": f"""
SELECT page_id, {_UNESC("regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)")} AS heading,
  CAST(len(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS INTEGER) AS n_links,
  CASE WHEN regexp_matches({_UNESC("regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)")}, '{HEADING}')
       THEN TRY_CAST(regexp_extract({_UNESC("regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)")}, '{HEADING}', 1) AS INTEGER) END AS book,
  CASE WHEN regexp_matches({_UNESC("regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)")}, '{HEADING}') THEN 'ok' ELSE 'bad_heading' END AS status
FROM pages""",
    "frame_plan": FRAMES + """
SELECT src_file, frame, scan_dpi, CAST((width_px * 100) // scan_dpi AS BIGINT) AS width_in_x100,
  CAST((height_px * 100) // scan_dpi AS BIGINT) AS height_in_x100,
  is_cc, CASE WHEN is_cc THEN 'cc' ELSE maptype || '/' || book END AS dest_dir, dest_file,
  CASE WHEN mode = 'P' THEN 'RGB' ELSE mode END AS mode,
  regexp_replace(src_file, '^\\D*(\\d{3,})(\\D{2})(\\d{3,}).*$', '\\2\\1\\3') AS sort_key FROM fp""",
    "resize_plan": FRAMES + f""",
al AS (SELECT dest_file, is_cc, scan_dpi, width_px, height_px, mode, maptype, book FROM fp
  UNION ALL SELECT lower(src_file), true, dpi, width_px, height_px, mode, NULL, NULL FROM f_cc_scan)
SELECT dest_file, least({K.MAP_DPI}, scan_dpi) AS map_dpi,
  CAST(round_even(width_px * least({K.MAP_DPI}, scan_dpi) / scan_dpi, 0) AS INTEGER) AS width_out,
  CAST(round_even(height_px * least({K.MAP_DPI}, scan_dpi) / scan_dpi, 0) AS INTEGER) AS height_out,
  CASE WHEN mode = 'P' THEN 'RGB' WHEN mode = '1' THEN 'L' ELSE mode END AS mode,
  CASE WHEN is_cc THEN 'map/cc' ELSE 'map/' || maptype || '/' || book END || '/' || regexp_replace(dest_file, '\\.tif\\z', '.jpg') AS target,
  CASE WHEN is_cc AND NOT regexp_matches(dest_file, '^\\d{{4}}-(or|doc)-\\d{{6,}}-\\d{{3,}}\\.tif\\z') THEN 'bad_cc_name' ELSE 'convert' END AS status
FROM al""",
    "pdf_manifest": MANIFEST + "\nSELECT map, CAST(row_number() OVER (PARTITION BY map ORDER BY part, doc DESC, file) AS INTEGER) AS seq, file FROM pg",
    "pdf_manifest_issues": MANIFEST + """
SELECT map, doc, doc_number, issue FROM d WHERE issue IS NOT NULL
UNION ALL SELECT map, doc, doc_number, CASE WHEN unknown THEN 'unknown_maptype' ELSE 'bad_doc_number' END FROM docs1 WHERE unknown OR doc IS NULL""",
    "constraint_checks": CHECKS,
    "broken_checks": BROKEN,
}
