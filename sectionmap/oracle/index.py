"""Oracle SQL: maps, files, certificates of correction, surveyors, totals."""

from sectionmap import constants as K
from sectionmap.oracle.common import duckdb_with, maptype_values, source_values

FT = K.FULL_TOWNSHIP
BOOK, PAGE, ABBREV, IMAGE = (f"'{p}'" for p in (K.BOOK_PART, K.PAGE_PART, K.ABBREV_PART, K.IMAGE_PART))


def _sfx(sheet: str, kind: str, order: int) -> str:
    return (f"SELECT maptype, book, page, regexp_replace(pm, '(?s)^(.*?)(\\d+)(.*)\\z', '\\1 ({kind}\\2)\\3') AS suffix, "
            f"{order} AS sheet, seq FROM {sheet}")


MAPS0 = f"""legacy AS (
  SELECT h.id, t.id AS maptype_id, h.book, h.firstpage AS page, h.lastpage - h.firstpage + 1 AS npages, h.recdate,
    h.donefor AS client, h.descript AS description, h.comment AS note
  FROM f_legacy_map h LEFT JOIN maptype t ON t.maptype = h.maptype),
sheetm AS (
  SELECT CAST((SELECT coalesce(max(id), 0) FROM legacy) + row_number() OVER (ORDER BY s.maptype, s.book, s.page) AS INTEGER) AS id,
    t.id AS maptype_id, s.book, s.page, s.npages, s.recdate, s.client, s.description, s.note
  FROM f_sheet s JOIN maptype t ON t.maptype = s.maptype),
maps0 AS (SELECT * FROM legacy UNION ALL SELECT * FROM sheetm),
mk0 AS (SELECT m.id AS map_id, m.book, m.page, t.maptype AS maptype_name FROM maps0 m JOIN maptype t ON t.id = m.maptype_id)"""


def sfx_cte(name: str, sheets: list[tuple[str, str]]) -> str:
    parts = " UNION ALL ".join(_sfx(s, k, i) for i, (s, k) in enumerate(sheets))
    return f"""{name} AS (
  SELECT mk0.map_id, string_agg(x.suffix, '' ORDER BY x.sheet, x.seq) AS suffix
  FROM ({parts}) x JOIN mk0 ON mk0.book = x.book AND mk0.page = x.page AND mk0.maptype_name = x.maptype
  GROUP BY mk0.map_id)"""


MAPS = MAPS0 + ",\n" + sfx_cte("sfx", [("f_pm", "PM"), ("f_tract", "TR")]) + f""",
maps AS (
  SELECT m.id, m.maptype_id, m.book, m.page, m.npages, m.recdate,
    CASE WHEN s.suffix IS NULL THEN m.client ELSE m.client || s.suffix END AS client,
    regexp_replace(m.description, '(?s)^(.*?){FT}', '\\1FULL TOWNSHIP') AS description, m.note
  FROM maps0 m LEFT JOIN sfx s ON s.map_id = m.id),
mk AS (SELECT m.id AS map_id, t.abbrev, t.maptype AS maptype_name, m.book, m.page, m.npages, m.recdate
       FROM maps m JOIN maptype t ON t.id = m.maptype_id)"""

BASE = duckdb_with("f_legacy_map", "f_sheet", "f_pm", "f_tract") + ",\n" + maptype_values() + ",\n" + MAPS


def _link(listing: str, kind: str, with_page: bool = True) -> str:
    page = f"TRY_CAST(nullif(regexp_extract(path, {IMAGE}, 1), '') AS INTEGER)" if with_page else "CAST(NULL AS INTEGER)"
    return f"""SELECT '{kind}' AS kind, f.path, mk.map_id, {page} AS page FROM {listing} f
  LEFT JOIN mk ON mk.book = TRY_CAST(nullif(regexp_extract(f.path, {BOOK}, 1), '') AS INTEGER)
   AND mk.page = TRY_CAST(nullif(regexp_extract(f.path, {PAGE}, 1), '') AS INTEGER)
   AND mk.abbrev = upper(nullif(regexp_extract(f.path, {ABBREV}, 1), ''))"""


FILES = f"""images AS ({_link('f_file', 'map')}),
scans AS ({_link('f_scan', 'scan')}),
pdfs AS ({_link('f_pdf', 'pdf', False)})"""

RUN = """rd AS (SELECT DISTINCT map_id, page FROM images WHERE map_id IS NOT NULL AND page >= 1),
run AS (
  SELECT a.map_id, CAST(CASE WHEN bool_or(a.page = 1) THEN min(CASE WHEN b.map_id IS NULL THEN a.page END) ELSE 0 END AS INTEGER) AS contiguous
  FROM rd a LEFT JOIN rd b ON b.map_id = a.map_id AND b.page = a.page + 1 GROUP BY a.map_id)"""

WITH_FILES = duckdb_with("f_legacy_map", "f_sheet", "f_pm", "f_tract", "f_file", "f_scan", "f_pdf") + \
    ",\n" + maptype_values() + ",\n" + MAPS + ",\n" + FILES

CC = r"""cc AS (
  SELECT CAST(row_number() OVER (ORDER BY c.doc_number) AS INTEGER) AS cc_id, mk.map_id, c.doc_number, c.npages,
    CASE WHEN regexp_matches(c.doc_number, '^(\d+) OR (\d+)\z')
           THEN lpad(CAST(CAST(regexp_extract(c.doc_number, '^(\d+) OR (\d+)\z', 1) AS BIGINT) AS VARCHAR), CAST(greatest(length(CAST(CAST(regexp_extract(c.doc_number, '^(\d+) OR (\d+)\z', 1) AS BIGINT) AS VARCHAR)), 4) AS INTEGER), '0') || '-or-'
                || lpad(CAST(CAST(regexp_extract(c.doc_number, '^(\d+) OR (\d+)\z', 2) AS BIGINT) AS VARCHAR), CAST(greatest(length(CAST(CAST(regexp_extract(c.doc_number, '^(\d+) OR (\d+)\z', 2) AS BIGINT) AS VARCHAR)), 6) AS INTEGER), '0')
         WHEN regexp_matches(c.doc_number, '^(\d{4})-(\d+)-\d+\z')
           THEN lpad(CAST(CAST(regexp_extract(c.doc_number, '^(\d{4})-(\d+)-\d+\z', 1) AS BIGINT) AS VARCHAR), CAST(greatest(length(CAST(CAST(regexp_extract(c.doc_number, '^(\d{4})-(\d+)-\d+\z', 1) AS BIGINT) AS VARCHAR)), 4) AS INTEGER), '0') || '-doc-'
                || lpad(CAST(CAST(regexp_extract(c.doc_number, '^(\d{4})-(\d+)-\d+\z', 2) AS BIGINT) AS VARCHAR), CAST(greatest(length(CAST(CAST(regexp_extract(c.doc_number, '^(\d{4})-(\d+)-\d+\z', 2) AS BIGINT) AS VARCHAR)), 6) AS INTEGER), '0') END AS doc_base
  FROM f_cc c LEFT JOIN mk ON mk.maptype_name = c.maptype AND mk.book = c.book AND mk.page = c.page AND mk.recdate = c.recdate),
ccf0 AS (
  SELECT path, nullif(regexp_extract(path, '.*/(.*)-(\d{3,})', 1), '') AS base,
    TRY_CAST(nullif(regexp_extract(path, '.*/(.*)-(\d{3,})', 2), '') AS INTEGER) AS pg,
    string_split(path, '/')[-1] AS fname FROM f_cc_file),
ccf1 AS (SELECT f.*, m.max_page, string_split(regexp_replace(fname, '\.jpg\z', ''), '-') AS parts
         FROM ccf0 f LEFT JOIN (SELECT base, max(pg) AS max_page FROM ccf0 GROUP BY base) m ON m.base = f.base),
ccf AS (
  SELECT CASE WHEN regexp_replace(parts[2], '^0+', '') = 'or'
              THEN concat_ws(' OR ', regexp_replace(parts[1], '^0+', ''), regexp_replace(parts[3], '^0+', ''))
              ELSE concat_ws('-', regexp_replace(parts[1], '^0+', ''), regexp_replace(parts[3], '^0+', ''), CAST(max_page AS VARCHAR)) END AS doc_number,
    TRY_CAST(regexp_replace(parts[4], '^0+', '') AS INTEGER) AS page, '/' || path AS imagefile FROM ccf1),
cc_image AS (SELECT cc.cc_id, ccf.page, ccf.imagefile FROM ccf LEFT JOIN cc ON cc.doc_number = ccf.doc_number)"""

WITH_CC = duckdb_with("f_legacy_map", "f_sheet", "f_pm", "f_tract", "f_cc", "f_cc_file") + \
    ",\n" + maptype_values() + ",\n" + MAPS + ",\n" + CC

SURV = r"""sv0 AS (SELECT *, row_number() OVER (PARTITION BY fullname ORDER BY row_no) AS rn FROM f_alias),
surveyor AS (
  SELECT fullname, firstname, secondname, thirdname, lastname, suffix, pls, rce,
    CAST(row_number() OVER (ORDER BY row_no) AS INTEGER) AS id FROM sv0 WHERE rn = 1),
alias AS (SELECT DISTINCT legacy_name, fullname FROM f_alias),
names AS (
  SELECT id AS map_id, unnest(regexp_split_to_array(upper(surveyor), '\s*&\s*')) AS legacy_name FROM f_legacy_map
  UNION ALL
  SELECT mk.map_id, unnest(regexp_split_to_array(upper(s.surveyor), '\s*&\s*')) FROM f_sheet s
    JOIN mk ON mk.maptype_name = s.maptype AND mk.book = s.book AND mk.page = s.page),
signed_by AS (SELECT DISTINCT n.map_id, s.id AS surveyor_id FROM names n JOIN alias a USING (legacy_name)
              JOIN surveyor s ON s.fullname = a.fullname),
disp AS (
  SELECT id, fullname, lastname, firstname,
    firstname || coalesce(' ' || left(secondname, 1), '') || coalesce(' ' || left(thirdname, 1), '') || ' ' || lastname
      || coalesce(' ' || suffix, '') AS display,
    concat_ws(' ', firstname, left(secondname, 1), left(thirdname, 1), lastname, suffix) AS display_ws,
    array_to_string(list_transform(string_split(concat_ws(' ', firstname, secondname, thirdname, lastname, suffix), ''),
      lambda c, i: CASE WHEN i = 1 OR NOT regexp_matches(string_split(concat_ws(' ', firstname, secondname, thirdname, lastname, suffix), '')[i - 1], '[\p{L}\p{N}]')
                        THEN upper(c) ELSE lower(c) END), '') AS n1,
    concat_ws(' ', firstname, left(secondname, 1), left(thirdname, 1), lastname, suffix) AS n2
  FROM surveyor)"""

WITH_SURV = duckdb_with("f_legacy_map", "f_sheet", "f_pm", "f_tract", "f_alias", "f_batch") + \
    ",\n" + maptype_values() + ",\n" + MAPS + ",\n" + SURV

# Q19 in SQL: page p of a map counts if the names of pages 1..p are all in the store.
COVER = duckdb_with("f_legacy_map", "f_sheet", "f_pm", "f_tract", "f_file", "f_scan", "f_pdf", "f_batch", "f_object", "f_alias") + \
    ",\n" + maptype_values() + ",\n" + MAPS + ",\n" + FILES + r""",
nm AS (SELECT map_id, printf('%s/%03d/%03d%s%03d', lower(abbrev), book, book, lower(abbrev), page) AS name FROM mk),
own AS (SELECT nm.map_id, CAST(left(right(f_object.path, 7), 3) AS INTEGER) AS page, f_object.path FROM f_object
        JOIN nm ON f_object.path LIKE '%.jpg' AND '/map/' || nm.name = left(f_object.path, length(f_object.path) - 8)),
ranked AS (SELECT map_id, page, row_number() OVER (PARTITION BY map_id ORDER BY page) AS rn
           FROM (SELECT DISTINCT map_id, page FROM own WHERE page > 0)),
run AS (SELECT map_id, count(*) AS contiguous FROM ranked WHERE page = rn GROUP BY map_id),
pdf_now AS (SELECT DISTINCT nm.map_id, path AS pdffile FROM f_object JOIN nm ON path = '/pdf/' || nm.name || '.pdf'),
ni AS (SELECT map_id, count(DISTINCT path) AS n FROM images WHERE map_id IS NOT NULL GROUP BY map_id),
np AS (SELECT map_id, count(DISTINCT path) AS n FROM pdfs WHERE map_id IS NOT NULL GROUP BY map_id),
cover AS (
  SELECT b.maptype, b.book, b.page, mk.map_id, coalesce(ni.n, 0) AS map_images, coalesce(np.n, 0) AS pdfs,
    CAST(coalesce(run.contiguous, 0) AS INTEGER) AS contiguous, pdf_now.pdffile IS NOT NULL AS pdf_found,
    CASE WHEN ni.n <> coalesce(run.contiguous, 0) THEN 'warning' WHEN ni.n IS NULL AND run.contiguous > 0 THEN 'missing_rows' ELSE 'ok' END AS status,
    CASE WHEN ni.n IS NULL OR ni.n = coalesce(run.contiguous, 0) THEN CAST(coalesce(run.contiguous, 0) AS INTEGER) END AS sheet_images,
    CASE WHEN pdf_now.pdffile IS NOT NULL THEN 1 END AS sheet_pdfs, pdf_now.pdffile
  FROM f_batch b JOIN mk ON mk.maptype_name = b.maptype AND mk.book = b.book AND mk.page = b.page
  LEFT JOIN ni USING (map_id) LEFT JOIN np USING (map_id) LEFT JOIN run USING (map_id) LEFT JOIN pdf_now USING (map_id))"""
DISP = "\n" + SURV

SQL = {
    "map_page_overlaps": duckdb_with("f_long_map") + """
SELECT map_id, abbrev, book, page, npages, covered_to FROM (
  SELECT id AS map_id, abbrev, book, page, npages, max(page + npages - 1) OVER (
    PARTITION BY abbrev, book ORDER BY page, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS covered_to
  FROM f_long_map WHERE npages >= 1) x WHERE page <= covered_to""",
    "map_build": BASE + "\nSELECT * FROM maps",
    "parcel_numbers": duckdb_with("f_legacy_map", "f_sheet", "f_pm") + ",\n" + maptype_values() + ",\n" + MAPS0
    + ",\n" + sfx_cte("s", [("f_pm", "PM")]) + "\nSELECT map_id, suffix FROM s",
    "tract_numbers": duckdb_with("f_legacy_map", "f_sheet", "f_tract") + ",\n" + maptype_values() + ",\n" + MAPS0
    + ",\n" + sfx_cte("s", [("f_tract", "TR")]) + "\nSELECT map_id, suffix FROM s",
    "number_reports": BASE + r"""
SELECT 'PM' AS kind, mk.maptype_name AS maptype, mk.book, mk.page,
  trim(regexp_replace(m.client, '(?s)^.*\(PM(\d+)\)\s*(\w*)', '\1 \2')) AS number
FROM mk JOIN maps m ON m.id = mk.map_id WHERE mk.abbrev = 'PM'
UNION ALL
SELECT 'TR', mk.maptype_name, mk.book, mk.page, regexp_replace(m.client, '(?s)^.*\(TR(\d+)\)(.*)\z', '\1\2')
FROM mk JOIN maps m ON m.id = mk.map_id WHERE mk.abbrev = 'RM' AND regexp_matches(m.client, '(?i)(TR\d+)')""",
    "full_township_descriptions": BASE + f"""
SELECT id, regexp_replace(description, '(?s)^(.*?){FT}', '\\1FULL TOWNSHIP') AS description
FROM maps0 WHERE regexp_matches(description, '{FT}')""",
    "map_page_lookup": duckdb_with("f_map", "f_file") + f""",
pts AS (SELECT path, upper(nullif(regexp_extract(path, {ABBREV}, 1), '')) AS abbrev,
          TRY_CAST(nullif(regexp_extract(path, {BOOK}, 1), '') AS INTEGER) AS book,
          TRY_CAST(nullif(regexp_extract(path, {PAGE}, 1), '') AS INTEGER) + TRY_CAST(nullif(regexp_extract(path, {IMAGE}, 1), '') AS INTEGER) - 1 AS lookup_page
        FROM f_file)
SELECT p.path, min(m.id) AS map_id FROM pts p
LEFT JOIN f_map m ON m.abbrev = p.abbrev AND m.book = p.book AND m.page <= p.lookup_page AND m.page + m.npages > p.lookup_page
GROUP BY p.path""",
    "files_to_maps": WITH_FILES + "\nSELECT * FROM images UNION ALL SELECT * FROM scans UNION ALL SELECT * FROM pdfs",
    "files_not_indexed": WITH_FILES + r"""
SELECT DISTINCT nullif(regexp_extract(path, '/map/(..)', 1), '') AS maptype, nullif(regexp_extract(path, '.*/(.*)-', 1), '') AS map
FROM images WHERE map_id IS NULL""",
    "contiguous_pages": WITH_FILES + ",\n" + RUN + "\nSELECT map_id, contiguous FROM run",
    "image_coverage": COVER + "\nSELECT * EXCLUDE (pdffile) FROM cover",
    "missing_images": COVER + """
SELECT DISTINCT c.map_id, o.page, o.path AS imagefile FROM cover c JOIN own o ON o.map_id = c.map_id
WHERE c.map_images = 0 AND o.page <= c.contiguous AND o.page > 0""",
    "missing_pdfs": COVER + "\nSELECT DISTINCT map_id, pdffile FROM cover WHERE pdf_found AND pdfs = 0",
    "sheet_write_back": COVER + "," + DISP + r""",
n1 AS (SELECT n1, max(n2) AS new_value FROM disp GROUP BY n1)
SELECT b.maptype, b.book, b.page, coalesce(n1.new_value, b.surveyors) AS surveyors, c.map_id, c.sheet_images, c.sheet_pdfs
FROM f_batch b LEFT JOIN n1 ON n1.n1 = regexp_replace(b.surveyors, '\s+\(.*', '')
LEFT JOIN cover c ON c.maptype = b.maptype AND c.book = b.book AND c.page = b.page""",
    "cc_load": WITH_CC + "\nSELECT cc_id, map_id, doc_number, npages, doc_base FROM cc",
    "cc_images": WITH_CC + "\nSELECT cc_id, page, imagefile FROM cc_image",
    "cc_npages_mismatch": WITH_CC + """,
q1 AS (SELECT cc_id, max(page) AS npages FROM cc_image GROUP BY cc_id)
SELECT cc.map_id, cc.doc_number, cc.npages AS cc_pages, q1.npages AS pages, i.imagefile
FROM cc LEFT JOIN cc_image i ON i.cc_id = cc.cc_id LEFT JOIN q1 ON q1.cc_id = cc.cc_id
WHERE cc.npages <> q1.npages""",
    "cc_missing": WITH_CC + """
SELECT mk.maptype_name AS maptype, mk.book, mk.page, cc.doc_number
FROM cc JOIN mk ON mk.map_id = cc.map_id
WHERE cc.cc_id NOT IN (SELECT cc_id FROM cc_image WHERE cc_id IS NOT NULL)""",
    "signed_by": WITH_SURV + "\nSELECT map_id, surveyor_id FROM signed_by",
    "unknown_surveyors": WITH_SURV + r"""
SELECT DISTINCT n.legacy_name FROM (
  SELECT unnest(regexp_split_to_array(upper(surveyor), '\s+&\s+')) AS legacy_name FROM f_legacy_map) n
WHERE n.legacy_name NOT IN (SELECT legacy_name FROM alias)""",
    "surveyor_lists": WITH_SURV + """
SELECT m.id AS map_id,
  coalesce(string_agg(d.display, ' & ' ORDER BY concat_ws(' ', d.lastname, d.display)), 'UNKNOWN') AS surveyors,
  count(sb.surveyor_id) AS n_signers
FROM maps m LEFT JOIN signed_by sb ON sb.map_id = m.id LEFT JOIN disp d ON d.id = sb.surveyor_id
GROUP BY m.id""",
    "multi_signer_maps": WITH_SURV + """
SELECT m.id AS map_id,
  coalesce(string_agg(d.display, ' & ' ORDER BY concat_ws(' ', d.lastname, d.display)), 'UNKNOWN') AS surveyors,
  count(sb.surveyor_id) AS n_signers
FROM maps m LEFT JOIN signed_by sb ON sb.map_id = m.id LEFT JOIN disp d ON d.id = sb.surveyor_id
GROUP BY m.id HAVING count(*) > 1""",
    "surveyor_display": WITH_SURV + "\nSELECT id, fullname, display, display_ws, n1, n2 FROM disp",
    "alias_conflicts": WITH_SURV + """
SELECT 'duplicate_alias' AS kind, legacy_name AS name, count(*) AS n FROM f_alias GROUP BY legacy_name HAVING count(*) > 1
UNION ALL
SELECT 'conflicting_rows', fullname, count(*) FROM (SELECT DISTINCT fullname, firstname, secondname, thirdname, lastname, suffix, pls, rce FROM f_alias)
  GROUP BY fullname HAVING count(*) > 1
UNION ALL
SELECT 'bad_fullname', fullname, CAST(1 AS BIGINT) FROM surveyor
  WHERE fullname <> concat_ws(' ', firstname, secondname, thirdname, lastname, suffix)
UNION ALL
SELECT 'duplicate_display', display, count(*) FROM disp GROUP BY display HAVING count(*) > 1""",
    "name_cleanup": WITH_SURV + r""",
n1 AS (SELECT n1, max(n2) AS new_value FROM disp GROUP BY n1),
n2 AS (SELECT DISTINCT n2 AS canon FROM disp),
b AS (SELECT *, regexp_replace(surveyors, '\s+\(.*', '') AS k FROM f_batch)
SELECT b.maptype, b.book, b.page, b.surveyors,
  CASE WHEN n1.n1 IS NOT NULL THEN 'mapped' WHEN n2.canon IS NOT NULL THEN 'canonical' ELSE 'unknown' END AS status,
  CASE WHEN n1.n1 IS NOT NULL THEN n1.new_value ELSE b.surveyors END AS new_value
FROM b LEFT JOIN n1 ON n1.n1 = b.k LEFT JOIN n2 ON n2.canon = b.k""",
    "map_totals": BASE + """
SELECT t.maptype, count(m.id) AS maps FROM maptype t LEFT JOIN maps m ON m.maptype_id = t.id GROUP BY t.id, t.maptype
UNION ALL SELECT 'Total Maps', count(*) FROM maps""",
    "trs_totals": duckdb_with("f_trs") + ",\n" + source_values() + """
SELECT s.description AS source, count(t.map_id) AS records FROM source s LEFT JOIN f_trs t ON t.source_id = s.id GROUP BY s.id, s.description
UNION ALL SELECT 'Total TRS Records', count(*) FROM f_trs""",
    "signature_totals": WITH_SURV + """
SELECT 'Surveyors' AS "table", CAST(count(*) AS BIGINT) AS records FROM surveyor
UNION ALL SELECT 'Signed By', count(*) FROM signed_by""",
    "cc_totals": WITH_CC + """,
f AS (SELECT cc.cc_id, EXISTS (SELECT 1 FROM cc_image i WHERE i.cc_id = cc.cc_id) AS has FROM cc)
SELECT 'Without Image Files' AS ccs, count(DISTINCT cc_id) AS records FROM f WHERE NOT has
UNION ALL SELECT 'With Image Files', count(DISTINCT cc_id) FROM f WHERE has
UNION ALL SELECT 'Total', count(*) FROM cc""",
    "file_totals": WITH_FILES + """
SELECT 'Map Images' AS image_files, count(*) AS n FROM images
UNION ALL SELECT 'Scan Images', count(*) FROM scans
UNION ALL SELECT 'PDF Files', count(*) FROM pdfs""",
}
SQL["map_page_lookup_exploded"] = SQL["map_page_lookup"]
