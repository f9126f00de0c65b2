"""Oracle SQL (DuckDB dialect) for each registered query."""


def all_sql() -> dict[str, str]:
    from sectionmap.oracle import audits, codecs, extracts, index, parser, plans, search, trs
    out: dict[str, str] = {}
    for mod in (audits, codecs, extracts, index, parser, plans, search, trs):
        out.update(mod.SQL)
    return out
