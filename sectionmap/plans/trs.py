"""trs table: legacy section records, legacy qq columns, workbook records and
parsed description records (C11, P7), plus its reports (Q3, Q9-Q11, Q18, A6)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from sectionmap import constants as K
from sectionmap.functions import (
    legacy_qq_bit, popcount16, range_number, range_str, subsec_bits_lookup, township_number, township_str,
)
from sectionmap.functions._util import group
from sectionmap.plans import parser as P
from sectionmap.plans.files import map_keys
from sectionmap.session import staged

TRS_COLUMNS = ["map_id", "tshp", "rng", "sec", "subsec", "source_id"]
# The 11 fixed child tags of a legacy map record (lower case).
FIXED_TAGS = ("id", "maptype", "book", "firstpage", "lastpage", "recdate",
              "surveyor", "donefor", "descrip", "picture", "comment")
SHEET_TRS = K.SHEET_TRS


def qq_columns(wide: DataFrame) -> list[str]:
    """The open-ended qq columns: every column that is not a fixed tag."""
    return [c for c in wide.columns if c.lower() not in FIXED_TAGS]


def section_of_column(name: str):
    """(tshp, rng, sec) Columns parsed from a qq column name such as
    ``_x0030_5N1W26`` (escape dropped, lower case: '5n1w26').  The input is a
    literal, so Catalyst folds the codecs to constants at planning time."""
    code = F.lit(name[7:].lower())
    return (township_number(group(code, r"(\d+[ns])", 1)), range_number(group(code, r"\d+[ns](\d+[ew])", 1)),
            group(code, r"\d+[ns]\d+[ew](\d+)", 1).try_cast("int"))


def qq_bits(records: DataFrame) -> DataFrame:
    """(map_id, tshp, rng, sec, qq = ',1,2,') -> the legacy numbers of a map's
    section summed as bits; one aggregate shuffle on the section."""
    nums = records.filter(F.col("qq").isNotNull()).select(
        "map_id", "tshp", "rng", "sec", F.explode(F.split(F.trim(F.col("qq"), F.lit(",")), ",")).alias("_n"))
    rec = nums.withColumn("n", F.col("_n").try_cast("int")).filter(F.col("n").isNotNull())
    return rec.groupBy("map_id", "tshp", "rng", "sec").agg(F.sum(legacy_qq_bit("n")).cast("int").alias("subsec"))


def unpivot_qq(wide: DataFrame, id_col: str = "id") -> DataFrame:
    """C11: wide legacy qq columns (``_x0030_5N1W26`` = ',1,2,') to
    (map_id, tshp, rng, sec, subsec) with the legacy numbers summed as bits.

    ``unpivot`` + ``explode`` inside the scan stage; the section of each
    column comes from a folded literal map."""
    cols = qq_columns(wide)
    meta = F.create_map(*[x for c in cols for x in (
        F.lit(c), F.struct(*[v.alias(k) for k, v in zip(("tshp", "rng", "sec"), section_of_column(c))]))])
    long = wide.unpivot([id_col], cols, "column_name", "qq").filter(F.col("qq").isNotNull())
    return qq_bits(long.select(F.col(id_col).alias("map_id"), meta[F.col("column_name")].alias("s"), "qq").select("map_id", "s.*", "qq"))


def qq_of_elements(elements: DataFrame) -> DataFrame:
    """C11 from parsed elements (map_id, tag, qq): the section is read from the tag
    of each row, so no list of the names is needed.  The escaped first character
    (``_x0031_`` = '1') belongs to the section code."""
    first = F.char(F.conv(F.substring("tag", 3, 4), 16, 10).try_cast("int"))
    code = F.lower(F.when(F.col("tag").rlike(r"^_x[0-9a-fA-F]{4}_"), F.concat(first, F.substr("tag", F.lit(8)))).otherwise(F.col("tag")))
    return qq_bits(elements.select(
        "map_id", township_number(group(code, r"(\d+[ns])", 1)).alias("tshp"), range_number(group(code, r"\d+[ns](\d+[ew])", 1)).alias("rng"),
        group(code, r"\d+[ns]\d+[ew](\d+)", 1).try_cast("int").alias("sec"), "qq"))


#: Sections that a bit stands for (real ones are 1 to 36), and the text of every byte of such bits.
BIT_SECTIONS = 40
_BYTE_TEXTS = [[",".join(str(8 * k + i) for i in range(8) if n >> i & 1) or None for n in range(256)] for k in range(BIT_SECTIONS // 8)]


def section_lists(records: DataFrame) -> DataFrame:
    """(map_id, tshp, rng, _secs = '1,2,3'): the distinct sections in their order, NULL without any.

    Sections are added as bits of a number, one shuffle of numbers; only the groups that
    hold a section without a bit are listed row by row."""
    keys = ["map_id", "tshp", "rng"]
    has_bit = F.col("sec").between(0, BIT_SECTIONS - 1)
    g = records.groupBy(*keys).agg(
        F.bit_or(F.when(has_bit, F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("sec")))).alias("_bits"), F.max(~has_bit).alias("_odd"))
    texts = [F.get(F.array(*[F.lit(t).cast("string") for t in texts]), F.shiftright("_bits", 8 * k).bitwiseAND(255).cast("int"))
             for k, texts in enumerate(_BYTE_TEXTS)]
    odd = F.coalesce("_odd", F.lit(False))
    listed = g.where(~odd).select(*keys, F.when(F.col("_bits").isNotNull(), F.concat_ws(",", *texts)).alias("_secs"))
    bits = F.filter(F.sequence(F.lit(0), F.lit(BIT_SECTIONS - 1)), lambda i: F.call_function("getbit", F.col("_bits"), i) == 1)
    rest = g.where(odd).select(*keys, F.explode_outer(bits).alias("sec")).unionByName(records.where(~has_bit).select(*keys, "sec").distinct())
    return listed.unionByName(rest.groupBy(*keys).agg(
        F.expr("listagg(CAST(sec AS STRING), ',') WITHIN GROUP (ORDER BY sec)").alias("_secs")))


def rollup_sections(trs: DataFrame, sources: list[int], unknown: str | None = None) -> DataFrame:
    """Q10: (map_id, tshp text, rng text, ',1,2,3,') over the given sources.

    ``unknown`` replaces a township / range without a text form (the export
    writes '0')."""
    g = section_lists(trs.filter(F.col("source_id").isin(sources)))
    t = F.lpad(township_str("tshp"), 3, "0")
    r = range_str("rng")
    if unknown is not None:
        t, r = F.coalesce(t, F.lit(unknown)), F.coalesce(r, F.lit(unknown))
    return g.select("map_id", t.alias("tshp"), r.alias("rng"),
                    F.concat(F.lit(","), "_secs", F.lit(",")).alias("sec"), F.col("tshp").alias("_t"),
                    F.col("rng").alias("_r"))


def legacy_sections(legacy_trs: DataFrame) -> DataFrame:
    """Source 0: legacy (map, township, range, ',1,2,3,') rows -> one row per section."""
    secs = F.explode(F.split(F.trim(F.col("section"), F.lit(",")), ","))
    return legacy_trs.select(
        "map_id", township_number("township").alias("tshp"), range_number("range").alias("rng"),
        secs.alias("_s")).select(
        "map_id", "tshp", "rng", F.col("_s").try_cast("int").alias("sec"),
        F.lit(None).cast("int").alias("subsec"), F.lit(K.SOURCE_LEGACY_SECTION).alias("source_id"))


def sheet_records(sheet: DataFrame, maps: DataFrame, maptype: DataFrame) -> DataFrame:
    """Source 4: workbook trs text 'NE/4 S12 T2N R3E, S5 1N 1W' -> records of
    the map matched on type name, book and page."""
    parts = sheet.select("maptype", "book", "page",
                         F.explode(F.split("trs", r",\s*")).alias("part")).filter(F.col("part").rlike(SHEET_TRS))
    p = F.col("part")
    rec = parts.select("maptype", "book", "page",
                       township_number(group(p, SHEET_TRS, 3)).alias("tshp"),
                       range_number(group(p, SHEET_TRS, 4)).alias("rng"),
                       group(p, SHEET_TRS, 2).try_cast("int").alias("sec"),
                       subsec_bits_lookup(group(p, SHEET_TRS, 1)).alias("subsec"))
    mk = map_keys(maps, maptype).select("map_id", F.col("maptype_name").alias("_t"), F.col("book").alias("_b"),
                                        F.col("page").alias("_p"))
    j = rec.join(mk, (rec["maptype"] == mk["_t"]) & (rec["book"] == mk["_b"]) & (rec["page"] == mk["_p"]))
    return j.select("map_id", "tshp", "rng", "sec", "subsec", F.lit(K.SOURCE_SHEET).alias("source_id"))


def sections_of(trs: DataFrame) -> DataFrame:
    """Source 0 straight from section records: the rows that their lists (``rollup_sections``)
    would split into again."""
    d = trs.select("map_id", "tshp", "rng", "sec").distinct()
    named = lambda c: F.when(F.col(c).between(-99, 98), F.col(c)).alias(c)
    return d.where(F.col("sec").isNotNull()).select("map_id", named("tshp"), named("rng"), "sec", F.lit(None).cast("int").alias("subsec"),
                                                    F.lit(K.SOURCE_LEGACY_SECTION).alias("source_id"))


def build_trs(sections: DataFrame, qq_records: DataFrame, sheet: DataFrame, maps: DataFrame,
              maptype: DataFrame) -> DataFrame:
    """All four feeds appended (unionByName), one DataFrame, one write.  The parsed records
    are written first, so what the parser shuffles is gone when the feeds are put together."""
    s1 = qq_records.withColumn("source_id", F.lit(K.SOURCE_LEGACY_SUBSECTION))
    s4 = sheet_records(sheet, maps, maptype)
    base = sections.unionByName(s1.select(*TRS_COLUMNS)).unionByName(s4)
    # The three feeds are read three times (eligible maps, their records, the final union):
    # write them once to the shared folder.
    base = staged(base, "trs_feeds")
    # The parser reads the records of eligible maps only; the others need not be shuffled by it.
    eligible = staged(base.join(P.eligible_maps(base), "map_id", "left_semi"), "trs_eligible")
    s3 = staged(P.parsed_records(maps.select("id", "description").filter(F.col("description").isNotNull()), eligible), "trs_parsed")
    return base.unionByName(s3.select(*TRS_COLUMNS))


def rollup_top(trs: DataFrame, sources: list[int], n: int) -> DataFrame:
    """O2 as a ranking: per township and range the ``n`` first maps of the
    rollup.  Rows beyond rank n leave each task before the exchange, so a hot
    township costs n rows a task."""
    w = Window.partitionBy("_t", "_r").orderBy("map_id")
    r = rollup_sections(trs, sources).withColumn("rank", F.row_number().over(w))
    return r.filter(F.col("rank") <= n)


def cells_by_source(trs: DataFrame, source: DataFrame) -> DataFrame:
    """Q3: records and set qq cells per source (NULL bitmaps excluded)."""
    g = trs.filter(F.col("subsec").isNotNull()).groupBy("source_id").agg(
        F.count(F.lit(1)).alias("nrec"), F.sum(popcount16("subsec")).cast("bigint").alias("bits"))
    return g.join(source, g["source_id"] == source["id"]).select("source_id", "description", "nrec", "bits")


def redundancy(trs: DataFrame) -> DataFrame:
    """Q9: histogram of records per (map, township, range, section)."""
    per = trs.groupBy("map_id", "tshp", "rng", "sec").agg(F.count(F.lit(1)).alias("nrecs"))
    return per.groupBy("nrecs").agg(
        F.count(F.lit(1)).alias("sec_refs"), (F.col("nrecs") * F.count(F.lit(1))).alias("trs_recs"),
        F.sum(F.col("nrecs") - 1).alias("redundant"))


def extent(trs: DataFrame) -> DataFrame:
    """Q11: the geographic extent as township / range text."""
    a = trs.agg(F.max("tshp").alias("a"), F.min("tshp").alias("b"), F.max("rng").alias("c"), F.min("rng").alias("d"))
    return a.select(township_str("a").alias("t_max"), township_str("b").alias("t_min"),
                    range_str("c").alias("r_max"), range_str("d").alias("r_min"))


def range_checks(trs: DataFrame) -> DataFrame:
    """Q18 / Q23: rows failing each table check (NULL passes a CHECK) and
    keys holding more than one record."""
    aggs = [F.count(F.when(~F.col(c).between(lo, hi), 1)).alias(name)
            for name, (lo, hi), c in zip(K.TRS_CHECKS, K.TRS_CHECKS.values(), ("tshp", "rng", "sec", "subsec"))]
    counts = trs.agg(*aggs)
    per = trs.groupBy("map_id", "tshp", "rng", "sec").agg(F.count(F.lit(1)).alias("n"))
    dup = per.agg(F.count(F.when(F.col("n") > 1, 1)).alias("single_rec_per_sec"))
    names = list(K.TRS_CHECKS) + ["single_rec_per_sec"]
    rows = None
    for n in names:
        src = dup if n == "single_rec_per_sec" else counts
        part = src.select(F.lit(n).alias("check"), F.col(n).cast("bigint").alias("violations"))
        rows = part if rows is None else rows.unionByName(part)
    return rows


def sum_vs_or(qq_wide: DataFrame) -> DataFrame:
    """Groups where the summed legacy bits differ from their OR (a qq
    number listed twice)."""
    cols = qq_columns(qq_wide)
    long = qq_wide.unpivot(["id"], cols, "column_name", "qq").filter(F.col("qq").isNotNull())
    nums = long.select("id", "column_name", F.explode(F.split(F.trim(F.col("qq"), F.lit(",")), ",")).alias("n"))
    bits = nums.select("id", "column_name", legacy_qq_bit(F.col("n").try_cast("int")).alias("bit"))
    g = bits.groupBy("id", "column_name").agg(F.sum("bit").alias("s"), F.bit_or("bit").alias("o"))
    return g.agg(F.count(F.lit(1)).alias("n_groups"),
                 F.count(F.when(F.col("s") != F.col("o"), 1)).alias("n_differ"))
