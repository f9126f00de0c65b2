"""Derived inputs built from the driver tables.

The legacy extracts, workbooks and object-store listings the index is built
from are not public, so each input is derived by one SELECT over the driver
tables (orders, lineitem, customer, part).  Each text is written once and runs
in Spark (``spark.sql(text, **frames)``) and, inlined as a CTE, in the DuckDB
oracle.  ``{name}`` marks a table or another fixture.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F

from sectionmap.functions._util import once
from sectionmap.sources.tables import read_table

_TSTR = ("CASE WHEN {v} BETWEEN 0 AND 98 THEN CAST({v} + 1 AS STRING) || 'N' "
         "WHEN {v} BETWEEN -99 AND -1 THEN CAST(-{v} AS STRING) || 'S' END")
_ABBREV = ("CASE CAST({k} % 7 AS INT) WHEN 0 THEN 'CR' WHEN 1 THEN 'HM' WHEN 2 THEN 'MM' "
           "WHEN 3 THEN 'PM' WHEN 4 THEN 'RM' WHEN 5 THEN 'RS' ELSE 'UR' END")
_TYPENAME = ("CASE {a} WHEN 'CR' THEN 'Corner Record' WHEN 'HM' THEN 'Highway Map' "
             "WHEN 'MM' THEN 'Monument Map' WHEN 'PM' THEN 'Parcel Map' WHEN 'RM' THEN 'Record Map' "
             "WHEN 'RS' THEN 'Survey' ELSE 'Unrecorded Map' END")
# Padded, never cut.
_MAPNAME = "lpad(CAST({b} AS STRING), CAST(greatest(length(CAST({b} AS STRING)), 3) AS INT), '0') || lower({a}) || lpad(CAST({p} AS STRING), CAST(greatest(length(CAST({p} AS STRING)), 3) AS INT), '0')"


# One pass over orders with the columns of f_map, f_signed (surveyor) and
# f_desc (description): the same expressions as those fixtures, so the derived
# inputs below need no self-joins of orders.
_MAP_ROW = """SELECT CAST(o_orderkey AS INT) AS id, o_custkey AS custkey,
  CASE CAST(o_orderkey % 7 AS INT) WHEN 0 THEN 'CR' WHEN 1 THEN 'HM' WHEN 2 THEN 'MM' WHEN 3 THEN 'PM' WHEN 4 THEN 'RM' WHEN 5 THEN 'RS' ELSE 'UR' END AS abbrev,
  CAST(floor(floor(o_orderkey / 7) / 40) + 1 AS INT) AS book,
  CAST(floor(o_orderkey / 7) % 40 * 4 + 1 AS INT) AS page,
  CAST(o_custkey % 4 + 1 AS INT) AS npages,
  CAST(o_orderdate AS DATE) AS recdate,
  CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE 'CLIENT ' || CAST(o_custkey AS STRING) END AS client,
  'L' || CAST(o_custkey AS STRING) || CASE WHEN o_orderkey % 4 = 0 THEN ' & L' || CAST((o_custkey + 1) AS STRING) WHEN o_orderkey % 9 = 0 THEN '&UNKNOWN' ELSE '' END AS surveyor,
  CASE WHEN CAST(o_orderkey AS INT) % 7 = 0 THEN 'N/2 E/2 S5 & ' ELSE '' END || 'NE/4 S' || CAST(CAST(o_orderkey AS INT) % 36 + 1 AS STRING) || CASE WHEN CAST(o_orderkey AS INT) % 4 = 1 THEN ' & sw/4 S' ELSE ' & SW/4 S' END || CAST(CAST(o_orderkey AS INT) % 30 + 1 AS STRING) || CASE WHEN CAST(o_orderkey AS INT) % 3 = 0 THEN ' 1N,2E' ELSE '' END || CASE WHEN CAST(o_orderkey AS INT) % 5 = 0 THEN ' + E/2 SE/4 S31 2N, 2E  HWY 36' WHEN CAST(o_orderkey AS INT) % 5 = 1 THEN ' & se/4 s31 2n,2e' ELSE ' & N/2 N/2 S7' END AS description
FROM {orders}"""


def _ic(x: str) -> str:
    return f"upper(substr({x}, 1, 1)) || lower(substr({x}, 2))"


FIXTURES: dict[str, str] = {
    # ---- fixtures of FIXTURES.md, verbatim ------------------------------
    "f_map": """
SELECT CAST(o_orderkey AS INT) AS id,
  CAST(o_orderkey % 7 + 1 AS INT) AS maptype_id,
  CASE CAST(o_orderkey % 7 AS INT) WHEN 0 THEN 'CR' WHEN 1 THEN 'HM' WHEN 2 THEN 'MM' WHEN 3 THEN 'PM' WHEN 4 THEN 'RM' WHEN 5 THEN 'RS' ELSE 'UR' END AS abbrev,
 CAST(floor(floor(o_orderkey / 7) / 40) + 1 AS INT) AS book,
  CAST(floor(o_orderkey / 7) % 40 * 4 + 1 AS INT) AS page,
 CAST(o_custkey % 4 + 1 AS INT) AS npages,
  CAST(o_orderdate AS DATE) AS recdate,
 CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE 'CLIENT ' || CAST(o_custkey AS STRING) END AS client FROM {orders}
""",
    "f_trs": """
SELECT CAST(l_orderkey AS INT) AS map_id,
  CAST(l_partkey % 20 - 5 AS INT) AS tshp,
  CAST(l_suppkey % 11 - 3 AS INT) AS rng,
 CAST(l_partkey % 36 + 1 AS INT) AS sec,
  CASE WHEN l_linenumber % 2 = 0 THEN NULL ELSE CAST((l_partkey * 40503 + l_suppkey * 7 + l_linenumber) % 65535 + 1 AS INT) END AS subsec,
 CAST(l_linenumber % 5 AS INT) AS source_id FROM {lineitem}
""",
    "f_surveyor": """
SELECT CAST(c_custkey AS INT) AS id, upper(c_mktsegment) AS firstname,
  CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE 'QUINCY' END AS secondname,
 CASE WHEN c_custkey % 5 = 0 THEN 'ROY' ELSE NULL END AS thirdname, 'L' || CAST(c_custkey AS STRING) AS lastname,
  CASE WHEN c_custkey % 7 = 0 THEN 'JR' ELSE NULL END AS suffix FROM {customer}
""",
    "f_signed": """
SELECT CAST(o_orderkey AS INT) AS map_id, 'L' || CAST(o_custkey AS STRING) || CASE WHEN o_orderkey % 4 = 0 THEN ' & L' || CAST((o_custkey + 1) AS STRING) WHEN o_orderkey % 9 = 0 THEN '&UNKNOWN' ELSE '' END AS surveyor FROM {orders}
""",
    "f_qq": """
SELECT id,
  CASE WHEN id % 2 = 0 THEN ',' || CAST(id % 16 + 1 AS STRING) || ',' || CAST((id + 5) % 16 + 1 AS STRING) || ',' ELSE NULL END AS `_x0030_5N1W26`,
  CASE WHEN id % 3 = 0 THEN ',1,2,3,4,' ELSE NULL END AS `_x0030_7N1E31` FROM {f_map}
""",
    "f_desc": """
SELECT id,
  CASE WHEN id % 7 = 0 THEN 'N/2 E/2 S5 & ' ELSE '' END || 'NE/4 S' || CAST(id % 36 + 1 AS STRING) || CASE WHEN id % 4 = 1 THEN ' & sw/4 S' ELSE ' & SW/4 S' END || CAST(id % 30 + 1 AS STRING) || CASE WHEN id % 3 = 0 THEN ' 1N,2E' ELSE '' END || CASE WHEN id % 5 = 0 THEN ' + E/2 SE/4 S31 2N, 2E  HWY 36' WHEN id % 5 = 1 THEN ' & se/4 s31 2n,2e' ELSE ' & N/2 N/2 S7' END AS description FROM (SELECT CAST(o_orderkey AS INT) AS id FROM {orders}) o
""",
    "f_desc_trs": """
SELECT id AS map_id, 0 AS tshp, 1 AS rng,
  CAST(id % 36 + 1 AS INT) AS sec,
  CASE WHEN id % 17 = 0 THEN 255 ELSE NULL END AS subsec FROM (SELECT CAST(o_orderkey AS INT) AS id FROM {orders}) o WHERE id % 8 <> 2
UNION ALL SELECT id, 0, 1,
  CAST(id % 30 + 1 AS INT), NULL FROM (SELECT CAST(o_orderkey AS INT) AS id FROM {orders}) o WHERE id % 36 <> id % 30
UNION ALL SELECT id, 2, 1,
  CAST(id % 36 + 1 AS INT), NULL FROM (SELECT CAST(o_orderkey AS INT) AS id FROM {orders}) o WHERE id % 4 = 0
UNION ALL SELECT id, 1, 1, 31, NULL FROM (SELECT CAST(o_orderkey AS INT) AS id FROM {orders}) o WHERE id % 25 <> 0 AND id % 36 <> 30 AND id % 30 <> 30
UNION ALL SELECT id, 0, 1, 7, NULL FROM (SELECT CAST(o_orderkey AS INT) AS id FROM {orders}) o WHERE id % 6 <> 1 AND id % 36 <> 6 AND id % 30 <> 6
""",
    "f_file": """
SELECT '/map/' || lower(abbrev) || '/' || lpad(CAST(book AS STRING),3,'0') || '/' || lpad(CAST(book AS STRING),3,'0') || lower(abbrev) || lpad(CAST(page + CASE WHEN id % 13 = 0 THEN 500 ELSE 0 END AS STRING),3,'0') || '-' || lpad(CAST(p AS STRING),3,'0') || '.jpg' AS path FROM (SELECT *, explode(sequence(1, npages)) AS p FROM {f_map}) x WHERE NOT (id % 11 = 0 AND p = 2)
""",
    # ---- further derived inputs (this repository) -------------------------
    # Legacy map extract: type names (one unknown type), first/last page,
    # surveyor text, description (some with the full-township section list).
    "f_legacy_map": f"""
SELECT m.id AS id,
  CASE WHEN m.id % 997 = 0 THEN 'Misc Map' ELSE {_TYPENAME.format(a='m.abbrev')} END AS maptype,
  m.book AS book, m.page AS firstpage, m.page + m.npages - 1 AS lastpage, m.recdate AS recdate,
  m.surveyor AS surveyor, m.client AS donefor,
  CASE WHEN m.id % 50 = 0 THEN 'ALL S1,S2,S3,S4,S5,S6,S7,S8,S9,S10,S11,S12,S13,S14,S15,S16,S17,S18,S19,S20,S21,S22,S23,S24,S25,S26,S27,S28,S29,S30,S31,S32,S33,S34,S35,S36 ' || m.description ELSE m.description END AS descript,
  CAST(NULL AS STRING) AS comment
FROM ({_MAP_ROW}) m
WHERE m.id % 10 <> 9
""",
    # Map workbook: maps entered outside the legacy system, with a free-text trs column.
    "f_sheet": f"""
SELECT {_TYPENAME.format(a='m.abbrev')} AS maptype, m.book AS book, m.page AS page, m.npages AS npages,
  m.recdate AS recdate, m.surveyor AS surveyor, m.client AS client, m.description AS description,
  CASE WHEN m.id % 3 = 0 THEN 'NE/4 S' || CAST(m.id % 36 + 1 AS STRING) || ' T2N R3E, S' || CAST(m.id % 35 + 1 AS STRING) || ' 1N 1W'
       WHEN m.id % 3 = 1 THEN 'S/2 S' || CAST(m.id % 30 + 1 AS STRING) || ' 7N 1E,HWY 36' ELSE NULL END AS trs,
  CAST(NULL AS STRING) AS note
FROM ({_MAP_ROW}) m
WHERE m.id % 10 = 9
""",
    # Parcel-number workbook (some maps carry two numbers; seq is sheet order).
    "f_pm": """
SELECT 'Parcel Map' AS maptype, book, page, CAST(id % 500 + 1 AS STRING) || CASE WHEN id % 4 = 0 THEN ' AMENDED' ELSE '' END AS pm,
  CAST(NULL AS STRING) AS note, 1 AS seq FROM {f_map} WHERE abbrev = 'PM'
UNION ALL
SELECT 'Parcel Map', book, page + CASE WHEN id % 3 = 0 THEN 0 ELSE 500 END, 'UNIT ' || CAST(id % 7 + 1 AS STRING), CAST(NULL AS STRING), 2 FROM {f_map} WHERE abbrev = 'PM'
""",
    # Tract-number workbook.
    "f_tract": """
SELECT 'Record Map' AS maptype, book, page + CASE WHEN id % 4 = 0 THEN 0 ELSE 500 END AS page, CAST(id % 800 + 1 AS STRING) || CASE WHEN id % 8 = 0 THEN ' UNIT 1' ELSE '' END AS pm,
  CAST(NULL AS STRING) AS note, 1 AS seq FROM {f_map} WHERE abbrev = 'RM'
""",
    # PDF listing: one file per order; a third carry a page that no map has.
    "f_pdf": f"""
SELECT '/pdf/' || lower(abbrev) || '/' || lpad(CAST(book AS STRING), CAST(greatest(length(CAST(book AS STRING)), 3) AS INT), '0') || '/' || {_MAPNAME.format(a='abbrev', b='book', p='page + CASE WHEN id % 3 = 0 THEN 500 ELSE 0 END')} || '.pdf' AS path
FROM {{f_map}}
""",
    # Scan listing: page scans of every order; four fifths carry a page that no map has.
    "f_scan": f"""
SELECT '/scan/' || lower(abbrev) || '/' || lpad(CAST(book AS STRING), CAST(greatest(length(CAST(book AS STRING)), 3) AS INT), '0') || '/' || {_MAPNAME.format(a='abbrev', b='book', p='page + CASE WHEN id % 5 = 0 THEN 0 ELSE 500 END')} || '-' || lpad(CAST(p AS STRING), CAST(greatest(length(CAST(p AS STRING)), 3) AS INT), '0') || '.tif' AS path
FROM (SELECT *, explode(sequence(1, npages)) AS p FROM {{f_map}}) x
""",
    # Certificate-of-correction workbook: one cc for each of the
    # recorded maps; old (yyyy OR n) and new (yyyy-n-pages) numbers; some record dates off by a day.
    "f_cc": f"""
SELECT {_TYPENAME.format(a='abbrev')} AS maptype, book, page,
  CASE WHEN id % 15 = 0 THEN recdate + 1 ELSE recdate END AS recdate, CAST(NULL AS STRING) AS surveyor,
  CASE WHEN id % 4 = 0 THEN CAST(year(recdate) AS STRING) || ' OR ' || CAST(id AS STRING)
       ELSE CAST(year(recdate) AS STRING) || '-' || CAST(id AS STRING) || '-' || CAST(id % 3 + 1 AS STRING) END AS doc_number,
  CAST(id % 3 + 1 AS INT) AS npages, id AS src_id
FROM {{f_map}} WHERE abbrev IN ('PM', 'RM', 'RS')
""",
    # cc image listing (object keys without the leading '/'): a year that no
    # document has for some, one page too many for others.
    "f_cc_file": """
SELECT 'map/cc/' || CAST(year(recdate) + CASE WHEN src_id % 9 = 0 THEN 100 ELSE 0 END AS STRING) || CASE WHEN src_id % 4 = 0 THEN '-or-' ELSE '-doc-' END
  || lpad(CAST(src_id AS STRING), CAST(greatest(length(CAST(src_id AS STRING)), 6) AS INT), '0') || '-' || lpad(CAST(p AS STRING), CAST(greatest(length(CAST(p AS STRING)), 3) AS INT), '0') || '.jpg' AS path
FROM (SELECT *, explode(sequence(1, npages + CASE WHEN src_id % 5 = 0 THEN 1 ELSE 0 END)) AS p FROM {f_cc}) x
""",
    # Object store as it is now, read against the loaded tables: page images and
    # one PDF of every map under its own name; some first pages are numbered
    # wrongly (no run) and some PDFs carry a page that no map has.
    "f_object": f"""
SELECT '/map/' || lower(abbrev) || '/' || lpad(CAST(book AS STRING), CAST(greatest(length(CAST(book AS STRING)), 3) AS INT), '0') || '/' || {_MAPNAME.format(a='abbrev', b='book', p='page')} || '-' || lpad(CAST(p + CASE WHEN id % 17 = 0 AND p = 1 THEN 900 ELSE 0 END AS STRING), CAST(greatest(length(CAST(p + CASE WHEN id % 17 = 0 AND p = 1 THEN 900 ELSE 0 END AS STRING)), 3) AS INT), '0') || '.jpg' AS path
FROM (SELECT *, explode(sequence(1, npages)) AS p FROM {{f_map}}) x
UNION ALL
SELECT '/pdf/' || lower(abbrev) || '/' || lpad(CAST(book AS STRING), CAST(greatest(length(CAST(book AS STRING)), 3) AS INT), '0') || '/' || {_MAPNAME.format(a='abbrev', b='book', p='page + CASE WHEN id % 5 = 0 THEN 500 ELSE 0 END')} || '.pdf'
FROM {{f_map}}
""",
    # Scanned certificate pages: named after their document, some not.
    "f_cc_scan": """
SELECT CASE WHEN src_id % 6 = 0 THEN 'scan ' ELSE '' END || CAST(year(recdate) AS STRING) || CASE WHEN src_id % 4 = 0 THEN '-OR-' ELSE '-doc-' END
  || lpad(CAST(src_id AS STRING), CAST(greatest(length(CAST(src_id AS STRING)), 6) AS INT), '0') || '-' || lpad(CAST(p AS STRING), CAST(greatest(length(CAST(p AS STRING)), 3) AS INT), '0') || '.tif' AS src_file,
  CAST(1000 + (src_id % 1000) * 31 % 900 + p * 7 AS INT) AS width_px, CAST(1500 + src_id % 1700 AS INT) AS height_px,
  CASE CAST(src_id % 3 AS INT) WHEN 0 THEN 200 WHEN 1 THEN 150 ELSE 300 END AS dpi,
  CASE CAST(src_id % 5 AS INT) WHEN 0 THEN '1' WHEN 1 THEN 'L' WHEN 2 THEN 'P' WHEN 3 THEN 'RGB' ELSE 'RGBA' END AS mode
FROM (SELECT *, explode(sequence(1, npages)) AS p FROM {f_cc}) x
""",
    # Bad records of the legacy map XML, as text: no id, numbers and dates that are none,
    # markup that is none, a record that never ends, an id that was there before.
    "f_bad_map": """
SELECT id, kind, CASE kind
    WHEN 0 THEN '<map><maptype>Survey</maptype><BOOK>1</BOOK></map>'
    WHEN 1 THEN '<map><ID>-' || CAST(id AS STRING) || '</ID><maptype>Survey</maptype><BOOK>B' || CAST(id AS STRING) || '</BOOK></map>'
    WHEN 2 THEN '<map><ID>-' || CAST(id AS STRING) || '</ID><BOOK>4<BOOK></map>'
    WHEN 3 THEN '<map><ID>' || CAST(id AS STRING) || '</ID><maptype>Survey</maptype><BOOK>1</BOOK></map>'
    WHEN 4 THEN '<map><ID>-' || CAST(id AS STRING) || '</ID><maptype>Survey</maptype>'
    ELSE '<map note="a &lt; b"><ID>-' || CAST(id AS STRING) || '</ID><BOOK>x</BOOK><RECDATE>2001-13-45T00:00:00</RECDATE></map>' END AS xml
FROM (SELECT id, CAST(floor(id / 7) % 6 AS INT) AS kind FROM {f_legacy_map} WHERE id % 7 = 3) x
""",
    # Bad records of the legacy TRS XML.
    "f_bad_trs": """
SELECT id, CASE WHEN id % 2 = 0 THEN '<TRS><ID>-' || CAST(id AS STRING) || '</ID><TOWNSHIP>05N</TOWNSHIP><RANGE>1W</RANGE></TRS>'
    ELSE '<TRS><ID>x' || CAST(id AS STRING) || '</ID><TOWNSHIP>05N</TOWNSHIP><RANGE>1W</RANGE><SECTION>,1,</SECTION></TRS>' END AS xml
FROM {f_legacy_map} WHERE id % 11 = 5
""",
    # Query boxes: one section in every range of a township, with masks of several kinds;
    # some boxes lie where no map is.
    "f_box": """
SELECT DISTINCT 'B' || CAST(tshp AS STRING) || '/' || CAST(sec AS STRING) AS box_id, CAST(tshp + CASE WHEN sec = 36 THEN 40 ELSE 0 END AS INT) AS tshp, rng, sec,
  CASE CAST((sec + rng + 3) % 5 AS INT) WHEN 0 THEN 65535 WHEN 1 THEN 52428 WHEN 2 THEN 13107 WHEN 3 THEN 204 ELSE 32768 END AS mask
FROM {f_trs}
""",
    # Maps whose page ranges run into the next ones of their book.
    "f_long_map": """
SELECT id, abbrev, book, page, CAST(npages + CASE WHEN id % 19 = 0 THEN 11 WHEN id % 23 = 0 THEN 0 - npages ELSE 0 END AS INT) AS npages FROM {f_map}
""",
    # Certificate rows that cannot be read: an unknown map type, a number of no kind.
    "f_cc_odd": """
SELECT CASE WHEN src_id % 12 = 0 THEN 'Misc Map' ELSE maptype END AS maptype, book, page, recdate, surveyor,
  CASE WHEN src_id % 10 = 0 THEN 'no ' || CAST(src_id AS STRING) ELSE doc_number END AS doc_number, npages, src_id FROM {f_cc}
""",
    # trs records that break every range rule, and some that break none.
    "f_trs_odd": """
SELECT map_id, CAST(tshp + CASE WHEN map_id % 11 = 0 THEN 30 WHEN map_id % 13 = 0 THEN 0 - 30 ELSE 0 END AS INT) AS tshp,
  CAST(rng + CASE WHEN map_id % 7 = 0 THEN 12 WHEN map_id % 17 = 0 THEN 0 - 12 ELSE 0 END AS INT) AS rng,
  CAST(CASE WHEN map_id % 19 = 0 THEN 0 WHEN map_id % 23 = 0 THEN 37 WHEN map_id % 29 = 0 THEN NULL ELSE sec END AS INT) AS sec,
  CAST(CASE WHEN map_id % 31 = 0 THEN 0 WHEN map_id % 37 = 0 THEN 65536 ELSE subsec END AS INT) AS subsec, source_id FROM {f_trs}
""",
    # qq lists that name a cell twice, hold none or no number.
    "f_qq_odd": """
SELECT id, CASE WHEN id % 5 = 0 THEN ',3,3,' WHEN id % 7 = 0 THEN ',1,2,x,' WHEN id % 11 = 0 THEN ',,' ELSE `_x0030_5N1W26` END AS `_x0030_5N1W26`,
  CASE WHEN id % 13 = 0 THEN ',4,1,4,1,' ELSE `_x0030_7N1E31` END AS `_x0030_7N1E31` FROM {f_qq}
""",
    # Surveyors whose displayed names agree although their full names do not, and
    # last names of two words.
    "f_alias_odd": """
SELECT * FROM {f_alias}
UNION ALL
SELECT 'OTHER ' || legacy_name, firstname || ' QUENTIN ' || lastname, firstname, 'QUENTIN', CAST(NULL AS STRING), lastname, CAST(NULL AS STRING), pls, rce, row_no + 3
FROM {f_alias} WHERE row_no % 110 = 0
UNION ALL
SELECT 'DE LA ' || legacy_name, firstname || ' DE LA ' || lastname, firstname, CAST(NULL AS STRING), CAST(NULL AS STRING), 'DE LA ' || lastname, CAST(NULL AS STRING), pls, rce, row_no + 4
FROM {f_alias} WHERE row_no % 90 = 0
""",
    # Section codes of the legacy list.
    "f_section_code": """
SELECT DISTINCT CAST(tshp * 10000 + rng * 100 + sec AS INT) AS `OrderCode`, CASE WHEN tshp < 9 THEN '0' ELSE '' END || CAST(tshp + 1 AS STRING) || 'N' || CAST(rng + 1 AS STRING) || 'E'
  || CASE WHEN sec < 10 THEN '0' ELSE '' END || CAST(sec AS STRING) AS subsection
FROM {f_trs} WHERE tshp >= 0 AND rng >= 0
""",
    # Surveyor workbook: alias (legacy name) -> surveyor; second aliases,
    # a conflicting duplicate and some full names that disagree with their parts.
    "f_alias": """
SELECT lastname AS legacy_name,
  CASE WHEN id % 40 = 0 THEN concat_ws(' ', firstname, lastname) ELSE concat_ws(' ', firstname, secondname, thirdname, lastname, suffix) END AS fullname,
  firstname, secondname, thirdname, lastname, suffix,
  CASE WHEN id % 2 = 0 THEN 'PLS ' || CAST(id AS STRING) ELSE NULL END AS pls, CAST(NULL AS STRING) AS rce, id * 10 AS row_no
FROM {f_surveyor}
UNION ALL
SELECT firstname || ' ' || lastname, concat_ws(' ', firstname, secondname, thirdname, lastname, suffix),
  firstname, secondname, thirdname, lastname, suffix,
  CASE WHEN id % 2 = 0 THEN 'PLS ' || CAST(id AS STRING) ELSE NULL END, CAST(NULL AS STRING), id * 10 + 1
FROM {f_surveyor} WHERE id % 50 = 0 AND id % 40 <> 0
UNION ALL
SELECT lastname, concat_ws(' ', firstname, secondname, thirdname, lastname, suffix),
  firstname, secondname, thirdname, lastname, suffix, 'PLS 9999', CAST(NULL AS STRING), id * 10 + 2
FROM {f_surveyor} WHERE id % 70 = 0 AND id % 40 <> 0
""",
    # Batch "Maps" workbook: one row per map; the surveyor cell is a
    # capitalised full name, an initialled name or an unknown name.
    "f_batch": f"""
SELECT {_TYPENAME.format(a='m.abbrev')} AS maptype, m.book AS book, m.page AS page,
  CASE WHEN m.id % 3 = 0 THEN concat_ws(' ', {_ic('s.firstname')}, {_ic('s.secondname')}, {_ic('s.thirdname')}, {_ic('s.lastname')}, {_ic('s.suffix')})
         || CASE WHEN m.id % 6 = 0 THEN ' (PLS ' || CAST(s.id AS STRING) || ')' ELSE '' END
       WHEN m.id % 3 = 1 THEN concat_ws(' ', s.firstname, substr(s.secondname, 1, 1), substr(s.thirdname, 1, 1), s.lastname, s.suffix)
       ELSE 'NOBODY ' || CAST(m.id AS STRING) END AS surveyors
FROM ({_MAP_ROW}) m JOIN {{f_surveyor}} s ON s.id = m.custkey
""",
    # Scanned-frame metadata (pixel size, dpi, colour mode) per part.
    "f_images": f"""
SELECT lpad(CAST(p_partkey % 999 + 1 AS STRING), CAST(greatest(length(CAST(p_partkey % 999 + 1 AS STRING)), 3) AS INT), '0') || lower({_ABBREV.format(k='p_partkey')}) || lpad(CAST(p_partkey % 157 + 1 AS STRING), CAST(greatest(length(CAST(p_partkey % 157 + 1 AS STRING)), 3) AS INT), '0') || '.tif' AS src_file,
  CAST(frame AS INT) AS frame,
  CAST(1000 + (p_partkey * 37 + frame * 11) % 4000 AS INT) AS width_px,
  CAST(1200 + (p_size * 53 + p_partkey) % 4000 AS INT) AS height_px,
  CASE CAST(p_partkey % 4 AS INT) WHEN 0 THEN 96 WHEN 1 THEN 200 WHEN 2 THEN 300 ELSE 150 END AS dpi,
  CASE CAST(p_partkey % 5 AS INT) WHEN 0 THEN '1' WHEN 1 THEN 'L' WHEN 2 THEN 'P' WHEN 3 THEN 'RGB' ELSE 'RGBA' END AS mode
FROM (SELECT *, explode(sequence(1, p_size % 3 + 1)) AS frame FROM {{part}}) x
""",
}

# Which base tables / fixtures each fixture reads.
DEPENDS = {name: re.findall(r"\{(\w+)\}", text) for name, text in FIXTURES.items()}
BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def fixture(spark: SparkSession, sf_dir: str, name: str, _cache: dict | None = None) -> DataFrame:
    """The fixture ``name`` as a DataFrame over the parquet tables in ``sf_dir``."""
    cache = {} if _cache is None else _cache
    if name in cache:
        return cache[name]
    if name in BASE_TABLES:
        df = read_table(spark, sf_dir, name)
    else:
        deps = {d: fixture(spark, sf_dir, d, cache) for d in dict.fromkeys(DEPENDS[name])}
        df = spark.sql(FIXTURES[name], **deps)
        if df.columns == ["path"]:  # a listing: filters on a key's parts must not build the key again
            df = once(df.withColumnRenamed("path", "_path"), path=F.col("_path")).select("path")
    cache[name] = df
    return df


class Inputs:
    """Lazy accessor: ``Inputs(spark, sf_dir).f_map`` etc."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir, self._cache = spark, sf_dir, {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return fixture(self.spark, self.sf_dir, name, self._cache)


def duckdb_text(name: str) -> str:
    """The fixture text in DuckDB's dialect."""
    t = FIXTURES[name]
    t = re.sub(r"\{(\w+)\}", r"\1", t)
    t = t.replace("`", '"').replace("AS STRING", "AS VARCHAR")
    t = re.sub(r"explode\(sequence\(1, ([^()]+(?:\([^()]*\))?[^()]*)\)\) AS (\w+)",
               r"unnest(range(1, \1 + 1)) AS \2", t)
    return t


def duckdb_with(*names: str) -> str:
    """A WITH prefix defining the given fixtures (and what they read)."""
    order: list[str] = []

    def visit(n):
        if n in BASE_TABLES or n in order:
            return
        for d in DEPENDS[n]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    return "WITH " + ",\n".join(f"{n} AS ({duckdb_text(n)})" for n in order)
