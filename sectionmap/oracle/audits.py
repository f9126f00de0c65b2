"""Oracle SQL: the audits on inputs with rows that break their rules."""

from sectionmap.oracle.common import duckdb_with, maptype_values, paths_cte
from sectionmap.oracle.index import MAPS, SURV, SQL as INDEX
from sectionmap.oracle.plans import valid_sql
from sectionmap.oracle.trs import SQL as TRS

_ODD = duckdb_with("f_legacy_map", "f_sheet", "f_pm", "f_tract", "f_alias_odd") + ",\n" + maptype_values() + ",\n" + MAPS + ",\n" + SURV.replace("f_alias", "f_alias_odd")


def _body(sql: str, after: str) -> str:
    """A query's text behind the definition of its input."""
    return sql[sql.index(after):]


SQL = {
    "broken_ranges": duckdb_with("f_trs_odd") + "\n" + _body(TRS["trs_range_checks"], "SELECT 'valid_tshp'").replace("f_trs", "f_trs_odd"),
    "repeated_cells": duckdb_with("f_qq_odd") + ",\n" + _body(TRS["qq_sum_vs_or"], "qu AS (").replace("UNPIVOT f_qq ", "UNPIVOT f_qq_odd "),
    "invalid_paths": duckdb_with("f_trs_odd") + ",\n" + paths_cte("f_trs_odd") + f"""
SELECT CAST(len(string_split(trs_path, '.')) AS INTEGER) AS labels, {valid_sql('trs_path')} AS valid, count(*) AS n
FROM (SELECT DISTINCT trs_path FROM paths) GROUP BY ALL""",
    "name_conflicts": _ODD + "\n" + _body(INDEX["alias_conflicts"], "SELECT 'duplicate_alias'").replace("f_alias", "f_alias_odd"),
    "signer_order": _ODD + """
SELECT m.id AS map_id, coalesce(string_agg(d.display, ' & ' ORDER BY concat_ws(' ', d.lastname, d.display)), 'UNKNOWN') AS surveyors, count(d.id) AS n_signers
FROM f_map m LEFT JOIN disp d ON string_split(d.lastname, ' ')[-1] = 'L' || (m.id % 60 + 1) GROUP BY m.id""",
    "map_diff": duckdb_with("f_map", "f_legacy_map") + """,
b AS (SELECT id, CASE WHEN id % 21 = 0 THEN NULL WHEN id % 22 = 0 THEN 'X' ELSE donefor END AS client FROM f_legacy_map)
SELECT coalesce(a.id, b.id) AS id, CASE WHEN a.id IS NULL THEN 'missing' WHEN b.id IS NULL THEN 'extra'
    WHEN a.client IS NOT DISTINCT FROM b.client THEN 'same' ELSE 'changed' END AS status, a.client AS export_value, b.client AS check_value
FROM f_map a FULL OUTER JOIN b ON a.id = b.id""",
}
