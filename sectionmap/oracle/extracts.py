"""Oracle SQL: staging from extracts, whole XML documents, published counts."""

from sectionmap.oracle.common import duckdb_with, index_cte, maptype_values, paths_cte, rnum, source_values, subsec_names_values, tnum
from sectionmap.oracle.index import CC, FILES, MAPS, SURV
from sectionmap.oracle.parser import parser_ctes
from sectionmap.oracle.plans import HTML
from sectionmap.oracle.trs import QQ, SHEET, rollup

_QQ = QQ.replace("qn AS (", "qn AS (SELECT * FROM (", 1).replace("WHERE qq IS NOT NULL)),\nqq AS", "WHERE qq IS NOT NULL)) WHERE map_id IN (SELECT id FROM f_legacy_map)),\nqq AS", 1)

_ASIDE = """
q AS (
  SELECT 'map' AS extract, CASE kind WHEN 0 THEN NULL WHEN 3 THEN CAST(id AS VARCHAR) ELSE '-' || id END AS record_key,
    CASE kind WHEN 0 THEN 'missing ID' WHEN 1 THEN 'bad BOOK' WHEN 2 THEN 'unreadable' WHEN 3 THEN 'repeated ID'
              WHEN 4 THEN 'unreadable' ELSE 'bad BOOK, bad RECDATE' END AS reasons FROM f_bad_map
  UNION ALL
  SELECT 'trs', NULL, CASE WHEN id % 2 = 0 THEN 'missing SECTION' ELSE 'bad ID' END FROM f_bad_trs)"""

_LIST_COUNTS = " UNION ALL ".join(
    f"SELECT 'listing/{n}', count(*), 0, true, CAST(sum(strlen(path) + 1) AS BIGINT) FROM f_{n}" for n in ("file", "scan", "pdf", "cc_file"))

_PUB = duckdb_with("f_legacy_map", "f_sheet", "f_pm", "f_tract", "f_qq", "f_trs", "f_alias", "f_file", "f_scan", "f_pdf", "f_cc", "f_cc_file") \
    + ",\n" + maptype_values() + ",\n" + source_values() + ",\n" + subsec_names_values() + ",\n" + MAPS + ",\n" + FILES + ",\n" + CC + ",\n" + SURV \
    + ",\n" + _QQ + ",\n" + SHEET + f""",
ht AS ({rollup('f_trs', '0, 1, 2, 3, 4')}),
s0 AS (SELECT map_id, {tnum('tshp')} AS tshp, {rnum('rng')} AS rng, TRY_CAST(s AS INTEGER) AS sec, CAST(NULL AS INTEGER) AS subsec, 0 AS source_id
       FROM (SELECT map_id, tshp, rng, unnest(string_split(trim(sec, ','), ',')) AS s FROM ht)),
base AS (SELECT * FROM s0 UNION ALL SELECT map_id, tshp, rng, sec, subsec, 1 FROM qq UNION ALL SELECT * FROM s4),
pmaps AS (SELECT id, description FROM maps WHERE description IS NOT NULL),
{parser_ctes('pmaps', 'base')},
built AS (SELECT * FROM base UNION ALL SELECT map_id, tshp, rng, sec, subsec, 3 FROM cls WHERE status = 'accepted'),
trs AS (SELECT * FROM built WHERE map_id IN (SELECT id FROM maps)),
{paths_cte('trs')},
{index_cte()}
""" + " UNION ALL ".join(
    f"SELECT '{name}' AS \"table\", count(*) AS records FROM {src}" for name, src in (
        ("map", "maps"), ("maptype", "maptype"), ("source", "source"), ("surveyor", "surveyor"), ("signed_by", "signed_by"), ("map_image", "images"),
        ("scan", "scans"), ("pdf", "pdfs"), ("cc", "cc"), ("cc_image", "cc_image"), ("trs", "trs"),
        ("trs_reject", "(SELECT 1 FROM built WHERE map_id IS NULL OR map_id NOT IN (SELECT id FROM maps))"), ("trs_path", "idx")))

_DOC = duckdb_with("f_legacy_map", "f_sheet", "f_pm", "f_tract", "f_alias", "f_trs") + ",\n" + maptype_values() + ",\n" + MAPS + ",\n" + SURV + f""",
sv AS (SELECT 0 AS n, 'UNKNOWN' AS "Surveyor", 'UNKNOWN' AS lastname, '' AS firstname UNION ALL SELECT 1, display, lastname, firstname FROM disp),
r AS ({rollup('f_trs', '0', True)}),
svp AS (SELECT CAST(row_number() OVER (ORDER BY n, lastname, firstname) AS INTEGER) AS pos, "Surveyor", lastname FROM sv)"""

SQL = {
    "extract_maps": duckdb_with("f_legacy_map") + """
SELECT id, maptype, book, firstpage, lastpage, recdate, surveyor, donefor, descript,
  CASE WHEN id % 3 = 0 THEN '/old/' || id || '.tif' END AS image, comment FROM f_legacy_map""",
    "extract_sections": duckdb_with("f_qq", "f_legacy_map") + ",\n" + _QQ + "\nSELECT * FROM qq",
    "extract_quarantine": duckdb_with("f_bad_map", "f_bad_trs") + "," + _ASIDE + "\nSELECT * FROM q",
    "extract_lists": duckdb_with("f_surveyor", "f_section_code") + """
SELECT 'surveyor' AS kind, concat_ws(' ', firstname, secondname, thirdname, lastname, suffix) AS name, lastname AS value FROM f_surveyor
UNION ALL SELECT 'subsection', subsection, CAST("OrderCode" AS VARCHAR) FROM f_section_code""",
    "extract_sheets": duckdb_with("f_sheet", "f_cc") + """
SELECT 'sheet' AS kind, maptype, book, page, npages, recdate, trs, CAST(NULL AS VARCHAR) AS doc_number FROM f_sheet
UNION ALL SELECT 'cc', maptype, book, page, npages, recdate, NULL, doc_number FROM f_cc""",
    "extract_listing": duckdb_with("f_file", "f_scan", "f_pdf", "f_cc_file") + "\n" + " UNION ALL ".join(
        f"SELECT '{n}' AS listing, path FROM f_{n}" for n in ("file", "scan", "pdf", "cc_file")),
    "extract_manifest": duckdb_with("f_bad_map", "f_bad_trs", "f_trs", "f_surveyor", "f_section_code", "f_file", "f_scan", "f_pdf", "f_cc_file") + f""",
ht AS ({rollup('f_trs', '0, 1, 2, 3, 4')})
SELECT 'map.xml' AS extract, count(*) AS good, (SELECT count(*) FROM f_bad_map) AS aside, true AS has_bytes, CAST(NULL AS BIGINT) AS listing_bytes FROM f_legacy_map
UNION ALL SELECT 'trs.xml', count(*), (SELECT count(*) FROM f_bad_trs), true, NULL FROM ht
UNION ALL SELECT 'surveyor.xml', count(*), 0, true, NULL FROM f_surveyor
UNION ALL SELECT 'subsection.xml', count(*), 0, true, NULL FROM f_section_code
UNION ALL {_LIST_COUNTS}""",
    "object_listing": duckdb_with("f_file") + """
SELECT regexp_extract(path, '^/map/(..)/', 1) AS type, regexp_extract(path, '^/map/../(\\d+)/', 1) AS book, CAST(sum(strlen(path) + 1) AS BIGINT) AS bytes
FROM f_file GROUP BY ALL""",
    "scrape_sheet": f"""WITH h AS ({HTML})
SELECT maptype AS "MAPTYPE", book AS "BOOK", page AS "PAGE", npages AS "NPAGES", nullif(surveyors, '') AS "SURVEYORS", nullif(recdate, '') AS "RECDATE",
  nullif(client, '') AS "CLIENT", nullif(description, '') AS "DESC", nullif(pdf, '') AS "PDF", CAST(NULL AS VARCHAR) AS "TRS", CAST(NULL AS VARCHAR) AS "NOTE"
FROM h WHERE status = 'ok'""",
    "published_counts": _PUB,
    "xml_document": _DOC + """
SELECT 'Surveyor' AS kind, count(*) AS records, CAST(0 AS BIGINT) AS unreadable, arg_min("Surveyor", pos) AS first_key, arg_max("Surveyor", pos) AS last_key FROM svp
UNION ALL SELECT 'map', count(*), 0, CAST(min(map_id) AS VARCHAR), CAST(max(map_id) AS VARCHAR) FROM mk
UNION ALL SELECT 'TRS', count(*), 0, CAST(min(map_id) AS VARCHAR), CAST(max(map_id) AS VARCHAR) FROM r""",
    "xml_surveyors": _DOC + "\nSELECT * FROM svp",
    "xml_trs": _DOC + """\nSELECT map_id AS "ID", tshp AS "TOWNSHIP", rng AS "RANGE", sec AS "SECTION" FROM r""",
    "xml_diff": duckdb_with("f_trs") + f""",
a AS ({rollup('f_trs', '0', True)}), b0 AS ({rollup('f_trs', '0, 1', True)}),
b AS (SELECT * FROM b0 WHERE map_id % 13 <> 0 UNION ALL SELECT * FROM b0 WHERE map_id % 13 <> 0 AND map_id % 11 = 0),
u AS (SELECT map_id, tshp, rng, sec, sum(e) AS e, sum(c) AS c FROM (
  SELECT map_id, tshp, rng, sec, 1 AS e, 0 AS c FROM a UNION ALL SELECT map_id, tshp, rng, sec, 0, 1 FROM b) x GROUP BY ALL)
SELECT map_id AS "ID", tshp AS "TOWNSHIP", rng AS "RANGE", sec AS "SECTION", CAST(e AS BIGINT) AS n_export, CAST(c AS BIGINT) AS n_check,
  CASE WHEN e = c THEN 'same' WHEN e > 0 AND c > 0 THEN 'repeated' WHEN sum(e) OVER k = 0 THEN 'missing' WHEN sum(c) OVER k = 0 THEN 'extra' ELSE 'changed' END AS status
FROM u WINDOW k AS (PARTITION BY map_id, tshp, rng)""",
}
