"""Registry of the driver queries: name -> fn(spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, QueryFn] = {}


def query(fn: QueryFn) -> QueryFn:
    REGISTRY[fn.__name__] = fn
    return fn


def all_queries() -> dict[str, QueryFn]:
    from sectionmap.queries import audits, codecs, extracts, index, parser, plans, search, trs  # noqa: F401
    return dict(REGISTRY)
