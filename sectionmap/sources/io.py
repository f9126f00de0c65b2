"""Sources and sinks.

All are Spark data sources: XML (built into Spark 4), CSV, text, Parquet and
``binaryFile`` for object listings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


XML_OPTIONS = {"attributePrefix": "@attr@", "valueTag": "@value@"}
#: The order of rows in their files.
PLACE = ["_file", "_block", "_place"]
# Header of the scrape sheet.
SCRAPE_COLUMNS = ["MAPTYPE", "BOOK", "PAGE", "NPAGES", "SURVEYORS", "RECDATE", "CLIENT", "DESC", "PDF", "TRS", "NOTE"]
SCRAPE_SCHEMA = ("MAPTYPE STRING, BOOK INT, PAGE INT, NPAGES INT, SURVEYORS STRING, RECDATE STRING, CLIENT STRING, DESC STRING, "
                 "PDF STRING, TRS STRING, NOTE STRING")


# ---- sources -------------------------------------------------------------------

def read_records(spark: SparkSession, path: str, row_tag: str, schema: T.StructType | str,
                 root_tag: str | None = None) -> DataFrame:
    """XML records with fixed child elements.  A missing child is NULL;
    ``missing_fields`` can flag the rows where a required one is absent."""
    opts = {"rowTag": row_tag, "attributePrefix": "@attr@", "valueTag": "@value@", "mode": "PERMISSIVE"}
    if root_tag:
        opts["rootTag"] = root_tag
    return spark.read.format("xml").options(**opts).schema(schema).load(path)


def read_raw_records(spark: SparkSession, path: str, tag: str, fields: list[str]) -> DataFrame:
    """Records named ``tag`` of a document that may hold others: the text of each field
    (NULL when absent), the text of a record that is no XML in ``_unreadable``, and
    its place (file, block, number in the block).

    Records are cut out one by one, so one bad record costs no other; a child may have
    its record's name (one of that name left open hides the records after it in its block)."""
    schema = ", ".join(f"`{f}` STRING" for f in fields) + ", _unreadable STRING"
    options = {"rowTag": tag, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_unreadable", "useLegacyXMLParser": "true", **XML_OPTIONS}
    return with_place(spark.read.format("xml").options(**options).schema(schema).load(path))


def with_place(df: DataFrame) -> DataFrame:
    """``_file``, ``_block`` and ``_place``: the order of rows in their files, however the files are split."""
    return df.select("*", F.input_file_name().alias("_file"), F.input_file_block_start().alias("_block"),
                     F.monotonically_increasing_id().alias("_place"))


def missing_fields(df: DataFrame, required: list[str]) -> DataFrame:
    """Rows with a NULL required field, with the names of the missing fields."""
    missing = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in required]))
    return df.withColumn("missing", missing).filter(F.size("missing") > 0)


def read_sheet(spark: SparkSession, path: str, schema: T.StructType | str, sep: str = ",") -> DataFrame:
    """S3: a workbook sheet exported with one header line, read with a declared
    schema (positional); no inference pass over the data."""
    return (spark.read.option("header", True).option("sep", sep).option("mode", "PERMISSIVE")
            .schema(schema).csv(path))


def list_files(spark: SparkSession, root: str, glob: str = "*", leading_slash_of: str | None = None) -> DataFrame:
    """Object listing as a table (path, length).  ``binaryFile`` with the
    content column pruned from the scan; file names are made relative to
    ``leading_slash_of`` and given a leading '/', like the stored keys."""
    df = (spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob)
          .load(root).select("path", "length"))
    if leading_slash_of is not None:
        base = leading_slash_of.rstrip("/")
        df = df.withColumn("path", F.concat(F.lit("/"), F.regexp_replace(
            F.regexp_replace("path", r"^file:", ""), "^" + _re_escape(base) + "/?", "")))
    return df


def read_listing(spark: SparkSession, path: str) -> DataFrame:
    """A listing text file, one key per line (the K5 format)."""
    return spark.read.text(path).select(F.col("value").alias("path")).filter(F.length("path") > 0)


def _re_escape(s: str) -> str:
    import re
    return re.escape(s)


# ---- sinks ----------------------------------------------------------------------

def write_listing(paths: DataFrame, path: str, col: str = "path") -> None:
    """K5: one key per line with a leading '/'."""
    keys = F.when(F.col(col).startswith("/"), F.col(col)).otherwise(F.concat(F.lit("/"), F.col(col)))
    paths.select(keys.alias("value")).write.mode("overwrite").text(path)


def write_report(df: DataFrame, path: str, sep: str = "\t", compression: str = "none") -> None:
    """K6 / K7: a delimited report with a header line."""
    df.write.mode("overwrite").option("header", True).option("sep", sep).option("compression", compression).csv(path)


def write_scrape(records: DataFrame, path: str) -> None:
    """K7: scraped map records as a sheet with the eleven scrape columns; the last two are for the reader."""
    filled = {"DESC": "description", "TRS": None, "NOTE": None}
    cols = [F.lit(None).cast("string").alias(c) if c in filled and filled[c] is None else F.col(filled.get(c) or c.lower()).alias(c) for c in SCRAPE_COLUMNS]
    write_report(records.select(*cols), path, sep=",")


def write_back(sheet: DataFrame, results: DataFrame, keys: list[str], path: str) -> DataFrame:
    """K8: computed columns joined back onto the sheet (left join: sheet rows
    without a result keep their values), written as the new sheet."""
    out = sheet.join(results, keys, "left")
    write_report(out, path, sep=",")
    return out
