"""Oracle SQL: path index and searches."""

from sectionmap.oracle.common import duckdb_with, index_cte, path_base, paths_cte

_IDX = duckdb_with("f_trs") + ",\n" + paths_cte("f_trs") + ",\n" + index_cte()
_CELLS_26 = ", ".join(f"'5N.1W.26.{chr(65 + i)}'" for i in range(16))
_SPAN_PATHS = ", ".join(
    [f"'5N.1W.26.{c}'" for c in "CDGHKLOP"] + [f"'5N.1E.30.{c}'" for c in "ABEFIJMN"])
_SPAN_BITMAP = """SELECT DISTINCT map_id FROM f_trs WHERE
  (tshp = 4 AND rng = -1 AND sec = 26 AND (subsec & 52428) > 0) OR
  (tshp = 4 AND rng = 0 AND sec = 30 AND (subsec & 13107) > 0)"""

SQL = {
    "trs_paths": duckdb_with("f_trs") + ",\n" + paths_cte("f_trs") + "\nSELECT map_id, trs_path, source_id FROM paths",
    "paths_without_parents": _IDX + "\nSELECT map_id, trs_path, source_id FROM idx",
    "search_sections": duckdb_with("f_trs") + "\nSELECT DISTINCT map_id FROM f_trs WHERE tshp = 4 AND rng = -1 AND sec IN (23, 24, 25, 26)",
    "search_mask": duckdb_with("f_trs") + "\nSELECT DISTINCT map_id FROM f_trs WHERE tshp = 4 AND rng = -1 AND sec = 26 AND (subsec & 65535) > 0",
    "search_paths": _IDX + f"\nSELECT DISTINCT map_id FROM idx WHERE trs_path IN ({_CELLS_26})",
    "search_section_paths": _IDX + "\nSELECT DISTINCT map_id FROM idx WHERE trs_path IN ('5N.1W.23', '5N.1W.24', '5N.1W.25', '5N.1W.26')",
    "search_subtree": _IDX + "\nSELECT DISTINCT map_id FROM idx WHERE trs_path = '5N.1W' OR starts_with(trs_path, '5N.1W.')",
    "search_span": duckdb_with("f_trs") + "\n" + _SPAN_BITMAP,
    "box_search": duckdb_with("f_trs", "f_box") + """
SELECT DISTINCT b.box_id, t.map_id FROM f_trs t JOIN f_box b ON b.tshp = t.tshp AND b.rng = t.rng AND b.sec = t.sec WHERE (t.subsec & b.mask) <> 0""",
    "box_equivalence": duckdb_with("f_trs", "f_box") + ",\n" + paths_cte("f_trs") + ",\n" + index_cte() + """,
q1 AS (SELECT DISTINCT b.box_id, t.map_id FROM f_trs t JOIN f_box b ON b.tshp = t.tshp AND b.rng = t.rng AND b.sec = t.sec WHERE (t.subsec & b.mask) <> 0),
q2 AS (SELECT DISTINCT b.box_id, i.map_id FROM idx i JOIN (SELECT box_id, mask, """ + path_base("tshp", "rng", "sec") + """ AS base FROM f_box) b
       ON i.trs_path = b.base OR (len(i.trs_path) = len(b.base) + 2 AND starts_with(i.trs_path, b.base || '.')
          AND ((b.mask >> (ascii(i.trs_path[-1]) - 65)) & 1) = 1)),
m AS (SELECT coalesce(q1.box_id, q2.box_id) AS box_id, q1.map_id AS a, q2.map_id AS b FROM q1 FULL OUTER JOIN q2 ON q1.box_id = q2.box_id AND q1.map_id = q2.map_id)
SELECT x.box_id, count(m.a) FILTER (m.b IS NOT NULL) AS n_both, count(m.a) FILTER (m.b IS NULL) AS n_bitmap_only, count(m.b) FILTER (m.a IS NULL) AS n_path_only
FROM (SELECT DISTINCT box_id FROM f_box) x LEFT JOIN m USING (box_id) GROUP BY 1""",
    "search_equivalence": _IDX + f""",
q1 AS ({_SPAN_BITMAP}),
q2 AS (SELECT DISTINCT map_id FROM idx WHERE trs_path IN ({_SPAN_PATHS}))
SELECT q1.map_id, 'bitmap' AS side FROM q1 LEFT JOIN q2 USING (map_id) WHERE q2.map_id IS NULL
UNION ALL
SELECT q2.map_id, 'path' AS side FROM q2 LEFT JOIN q1 USING (map_id) WHERE q1.map_id IS NULL""",
}
