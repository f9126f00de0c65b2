"""Elements of web pages as rows: a balanced-tag scan.

Tags become rows with their place in the page.  Per element name a running depth is
kept; an element ends at the tag where its depth returns, so blocks may be
nested, of any name, and hold unbalanced inner markup of other names.  A page is one
row's text: all windows are per page or per block of a page.  ``block_rows`` reads whole
pages in one pass of each text, without a row a tag and without a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Container, Iterator
from functools import cache
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from sectionmap import constants as K
from sectionmap.operators.intervals import interval_join

#: A comment or a tag; '>' may stand inside quoted values.
TAG = r"""(?s)<!--.*?-->|</?[A-Za-z](?:[^<>"']++|"[^"]*+"|'[^']*+')*+>"""
NAME = r"^</?([A-Za-z][\w:\-]*)"


def attribute(tag, name: str) -> Column:
    """Value of an attribute, whatever its quotes and order; NULL when absent."""
    pattern = rf"""(?is)\s{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
    values = [F.regexp_extract(tag, pattern, i) for i in (1, 2, 3)]
    return F.when(F.col(tag).rlike(pattern), F.concat(*values))


def has_class(tag, name: str) -> Column:
    """The class attribute holds ``name`` as one of its blank-separated tokens."""
    return F.coalesce(F.array_contains(F.split(attribute(tag, "class"), r"\s+"), name), F.lit(False))


def tag_rows(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """(key, idx, tag, text, name, kind) for every tag and comment: ``text`` follows it up to
    the next one; kind is 'open', 'close' or 'void' (elements without content, '/>', comments)."""
    tags, texts = F.regexp_extract_all(html, F.lit(TAG), 0), F.split(html, TAG, -1)
    rest = F.slice(texts, 2, F.size(tags))
    rows = pages.select(key, F.posexplode(F.arrays_zip(tags.alias("tag"), rest.alias("text"))).alias("idx", "t")).select(key, "idx", "t.tag", "t.text")
    name = F.lower(F.regexp_extract("tag", NAME, 1))
    kind = (F.when(F.col("tag").startswith("</"), "close")
            .when(F.col("tag").startswith("<!") | F.col("tag").endswith("/>") | F.col("name").isin(*K.VOID_ELEMENTS), "void").otherwise("open"))
    return rows.withColumn("name", name).withColumn("kind", kind)


def _step() -> Column:
    return F.when(F.col("kind") == "open", 1).when(F.col("kind") == "close", -1).otherwise(0)


def blocks(tags: DataFrame, key: str, wanted: Column) -> DataFrame:
    """(key, start, length, closed) of the elements whose open tag is ``wanted``: the
    tags from its own to the one that returns to its depth, which is left out; to the
    end of the page when none does."""
    order = Window.partitionBy(key, "name").orderBy("idx")
    depth = F.sum(_step()).over(order.rowsBetween(Window.unboundedPreceding, 0))
    level = tags.withColumn("_level", depth + (F.col("kind") == "close").cast("int")).withColumn(
        "_last", F.max("idx").over(Window.partitionBy(key))).where(F.col("kind") != "void")
    end = F.lead("idx").over(Window.partitionBy(key, "name", "_level").orderBy("idx"))
    found = level.withColumn("_end", end).where(wanted & (F.col("kind") == "open"))
    return found.select(key, F.col("idx").alias("start"), (F.coalesce("_end", F.col("_last") + 1) - F.col("idx")).alias("length"),
                        F.col("_end").isNotNull().alias("closed"))


def block_tags(tags: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """The tags of every block with their depth in it (the block's own tag has 1) and the
    name of the element at depth 2 they are in.  Elements whose end tag may be left out
    never open a level.  A tag of a nested block is in both."""
    inside = interval_join(tags, found, [key], "idx", "start", "length", how="inner", bucket=256)
    order = Window.partitionBy(key, "start").orderBy("idx")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    step = F.when(F.col("name").isin(*K.OPTIONAL_END), 0).otherwise(_step())
    rows = inside.withColumn("depth", F.sum(step).over(so_far))
    child = F.when((F.col("kind") == "open") & (F.col("depth") == 2) & ~F.col("name").isin(*K.OPTIONAL_END), F.col("name"))
    return rows.withColumn("child", F.last(child, ignorenulls=True).over(so_far))


class Tag(NamedTuple):
    """An open tag inside a block, as ``block_tags`` has it."""

    name: str
    tag: str
    text: str
    depth: int
    child: str | None


#: ``TAG`` with its slash and its name as groups.
_TAG = re.compile(r"""<!--.*?-->|<(/?)([A-Za-z][\w:\-]*)(?:[^<>"']++|"[^"]*+"|'[^']*+')*+>""", re.DOTALL | re.ASCII)


_VOID, _OPTIONAL = frozenset(K.VOID_ELEMENTS), frozenset(K.OPTIONAL_END)


@cache
def _attribute(name: str) -> re.Pattern:
    return re.compile(rf"""\s{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.DOTALL | re.IGNORECASE | re.ASCII)


def attribute_of(tag: str, name: str) -> str | None:
    """``attribute`` of one tag."""
    m = _attribute(name).search(tag)
    return None if m is None else "".join(g or "" for g in m.groups())


def _has_class(tag: str, name: str) -> bool:
    return name in tag and name in re.split(r"\s+", attribute_of(tag, "class") or "", flags=re.ASCII)


def scan(html: str, class_name: str, names: Container[str] | None = None) -> Iterator[tuple[int, list[Tag]]]:
    """(start, open tags) of every element of the class, by start: the elements of
    ``blocks`` with the open tags of ``block_tags``, all or those of the ``names``."""
    found = list(_TAG.finditer(html))
    # start, name, depth of its own name, depth, child, open tags
    every, live = [], []
    for i, m in enumerate(found):
        slash, name = m.groups()
        if name is None:
            continue
        name = name.lower()
        optional = name in _OPTIONAL
        if slash:
            ended = False
            for b in live:
                if b[1] == name:
                    b[2] -= 1
                    ended = ended or not b[2]
                if not optional:
                    b[3] -= 1
            if ended:
                live = [b for b in live if b[2]]
            continue
        if name in _VOID or html[m.end() - 2] == "/":
            continue
        tag = m[0]
        if class_name in tag and _has_class(tag, class_name):
            every.append([i, name, 0, 0, None, []])
            live.append(every[-1])
        if not live:
            continue
        wanted = names is None or name in names
        if wanted:
            text = html[m.end():found[i + 1].start() if i + 1 < len(found) else len(html)]
        for b in live:
            if b[1] == name:
                b[2] += 1
            if not optional:
                b[3] += 1
                if b[3] == 2:
                    b[4] = name
            if wanted:
                b[5].append(Tag(name, tag, text, b[3], b[4]))
    return ((b[0], b[5]) for b in every)


def block_rows(pages: DataFrame, key: str, class_name: str, read: Callable[[list[Tag]], tuple], schema: str, html: str = "html",
               names: Container[str] | None = None) -> DataFrame:
    """(key, start, pos, *schema): what ``read`` makes of the open tags (of the ``names``) of each
    element of the class, numbered within its page.  Pages without a key have no rows."""

    def rows(text):
        return [] if text is None else [(start, pos, *read(tags)) for pos, (start, tags) in enumerate(scan(text, class_name, names))]

    found = F.udf(rows, f"array<struct<start: int, pos: int, {schema}>>", useArrow=False)
    return pages.where(F.col(key).isNotNull()).select(key, F.inline(found(html)))
