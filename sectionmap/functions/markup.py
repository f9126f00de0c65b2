"""Markup codecs: entities, and the child elements of a record's text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from sectionmap import constants as K
from sectionmap.functions._util import col

ENTITY = r"&(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);"
#: One child element: its name, and its text unless it is empty.
CHILD = r"(?s)<([A-Za-z_][\w.\-]*+)(?:\s[^<>]*)?(?:/>|>([^<]*+)</\1\s*>)"
COMMENT = r"(?s)<!--.*?-->"


def _code_point(n: Column) -> Column:
    """The character of a code point; NULL beyond Unicode and for surrogates."""
    ok = n.between(1, 0xD7FF) | n.between(0xE000, 0x10FFFF)
    return F.when(ok, F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32"))


def _entity(name: Column) -> Column:
    named = F.create_map(*[x for k, v in K.ENTITIES.items() for x in (F.lit(k), F.lit(v))])
    hexed = F.conv(F.substr(name, F.lit(3)), 16, 10).try_cast("int")
    value = (F.when(F.lower(F.substring(name, 1, 2)) == "#x", _code_point(hexed))
             .when(F.substring(name, 1, 1) == "#", _code_point(F.substr(name, F.lit(2)).try_cast("int")))
             .otherwise(F.try_element_at(named, name)))
    return F.coalesce(value, F.concat(F.lit("&"), name, F.lit(";")))


def decode_entities(c) -> Column:
    """Text with its entities replaced, each once and left to right; unknown ones stay."""
    c = col(c)
    # '&' comes last: what it leaves is not read again, and no other entity gives one.
    named = c
    for name, text in sorted(K.ENTITIES.items(), key=lambda e: e[0] == "amp"):
        named = F.replace(named, F.lit(f"&{name};"), F.lit(text))
    pieces, names = F.split(c, ENTITY, -1), F.regexp_extract_all(c, F.lit(ENTITY), 1)
    rest = F.zip_with(names, F.slice(pieces, 2, F.size(names)), lambda n, p: F.concat(_entity(n), p))
    numbered = F.concat(F.get(pieces, F.lit(0)), F.array_join(rest, ""))
    # Without another '&' the most frequent entity is the only one.
    only_amp = ~F.contains(F.replace(c, F.lit("&amp;"), F.lit("")), F.lit("&"))
    return (F.when(~F.contains(c, F.lit("&")), c).when(only_amp, F.replace(c, F.lit("&amp;"), F.lit("&")))
            .when(F.contains(c, F.lit("&#")), numbered).otherwise(named))


def escape_entities(c) -> Column:
    c = F.regexp_replace(F.regexp_replace(col(c), "&", "&amp;"), "<", "&lt;")
    return F.regexp_replace(c, ">", "&gt;")


def without_comments(c) -> Column:
    """Text without its comments; the pattern runs only over texts that hold one."""
    c = col(c)
    return F.when(F.contains(c, F.lit("<!--")), F.regexp_replace(c, COMMENT, "")).otherwise(c)


def child_elements(body: Column) -> tuple[Column, Column]:
    """(names, texts) of the child elements, in order, entities decoded and an empty
    element as NULL.  Repeated names stay."""
    texts = F.regexp_extract_all(body, F.lit(CHILD), 2)
    # No entity decodes to nothing, so only an empty text is one.
    return F.regexp_extract_all(body, F.lit(CHILD), 1), F.transform(texts, lambda x: F.when(x != "", decode_entities(x)))


def stray_text(body: Column) -> Column:
    """What is left of a record without its child elements; not blank when a tag is open or misspelt."""
    return F.trim(F.regexp_replace(F.regexp_replace(body, CHILD, ""), r"\s+", " "))


def child_text(tags, texts, tag: str) -> Column:
    """Text of the first child with that name, NULL when there is none."""
    return F.get(col(texts), F.array_position(col(tags), F.lit(tag)).cast("int") - 1)
