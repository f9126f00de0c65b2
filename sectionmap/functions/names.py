"""Names and numbers: map names, file names, cc document numbers, surveyor
display names and the parcel / tract number suffixes of a client field."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from sectionmap import constants as K
from sectionmap.functions._util import col, pad


def map_name(book, abbrev, page) -> Column:
    """'073pm123': 3-digit book, lower-case type abbreviation, 3-digit page
    (lpad truncates longer numbers, as the database does)."""
    return F.concat(F.lpad(col(book).cast("string"), 3, "0"), F.lower(col(abbrev)),
                    F.lpad(col(page).cast("string"), 3, "0"))


def file_name(book, abbrev, page) -> Column:
    """The map's name in file names: numbers of 3 digits or more, so that maps of
    book 1000 do not share the names of book 100."""
    return F.concat(pad(book), F.lower(col(abbrev)), pad(page))


def _strip_zeros(c: Column) -> Column:
    # Python's lstrip('0'): an all-zero field becomes ''.
    return F.regexp_replace(c, r"^0+", "")


def cc_doc_number(filename, max_page) -> Column:
    """Document number of a cc image file name ``yyyy-(or|doc)-nnnnnn-ppp.jpg``.

    Old style: '2001 OR 123'; new style '2001-1234-<max page of the document>'.
    """
    parts = F.split(F.regexp_replace(col(filename), r"\.jpg\z", ""), "-")
    s1 = _strip_zeros(F.element_at(parts, 1))
    kind = _strip_zeros(F.element_at(parts, 2))
    s2 = _strip_zeros(F.element_at(parts, 3))
    return F.when(kind == "or", F.concat_ws(" OR ", s1, s2)).otherwise(
        F.concat_ws("-", s1, s2, col(max_page).cast("string")))


def cc_doc_basename(doc_number) -> Column:
    """Inverse of ``cc_doc_number``: 'yyyy-or-nnnnnn' or 'yyyy-doc-nnnnnn';
    NULL when the number has neither form."""
    d = col(doc_number)
    old = r"^(\d+) OR (\d+)\z"
    new = r"^(\d{4})-(\d+)-\d+\z"
    fmt = lambda a, kind, b: F.concat(pad(a, 4), F.lit(f"-{kind}-"), pad(b, 6))
    num = lambda pat, i: F.regexp_extract(d, pat, i).try_cast("bigint").cast("string")
    return (F.when(d.rlike(old), fmt(num(old, 1), "or", num(old, 2)))
            .when(d.rlike(new), fmt(num(new, 1), "doc", num(new, 2))))


def surveyor_display(first, second, third, last, suffix) -> Column:
    """'JOHN Q R SMITH JR' (initials of the middle names).  A NULL first or
    last name makes the whole name NULL, as ``||`` does."""
    opt = lambda c: F.coalesce(F.concat(F.lit(" "), c), F.lit(""))
    return F.concat(col(first), opt(F.left(col(second), F.lit(1))), opt(F.left(col(third), F.lit(1))),
                    F.lit(" "), col(last), opt(col(suffix)))


def surveyor_display_ws(first, second, third, last, suffix) -> Column:
    """The concat_ws spelling: NULL parts are skipped."""
    return F.concat_ws(" ", col(first), F.left(col(second), F.lit(1)), F.left(col(third), F.lit(1)),
                       col(last), col(suffix))


def full_name(first, second, third, last, suffix) -> Column:
    return F.concat_ws(" ", col(first), col(second), col(third), col(last), col(suffix))


def initcap_words(s) -> Column:
    """Database-style initcap: a letter after a non-alphanumeric character (or
    at the start) is upper-cased, every other letter lower-cased -- so
    "O'HERN" becomes "O'Hern" (Spark's ``initcap`` only looks at blanks)."""
    chars = F.split(col(s), "")

    def one(c, i):
        prev = F.try_element_at(chars, F.greatest(i, F.lit(1)))
        starts = (i == 0) | ~prev.rlike(r"[\p{L}\p{N}]")
        return F.when(starts, F.upper(c)).otherwise(F.lower(c))

    return F.array_join(F.transform(chars, one), "")


def full_township(description) -> Column:
    """Replace the first literal 'S1,S2,...,S36' by 'FULL TOWNSHIP'."""
    return F.regexp_replace(col(description), rf"(?s)^(.*?){K.FULL_TOWNSHIP}", "$1FULL TOWNSHIP")


def number_suffix(number, kind: str) -> Column:
    """'12 AMENDED' -> ' (PM12) AMENDED' (first leading number only)."""
    return F.regexp_replace(col(number), r"(?s)^(.*?)(\d+)(.*)\z", rf"$1 ({kind}$2)$3")


def number_from_client(client, kind: str = "PM") -> Column:
    """Inverse of ``number_suffix`` for the parcel report: '<n> <word>' of the
    last '(PMn)' in the client; the text unchanged when there is none."""
    return F.trim(F.regexp_replace(col(client), rf"(?s)^.*\({kind}(\d+)\)\s*(\w*)", "$1 $2"))


def tract_from_client(client) -> Column:
    """Tract report: number and rest after the last '(TRn)'."""
    return F.regexp_replace(col(client), r"(?s)^.*\(TR(\d+)\)(.*)\z", "$1$2")
