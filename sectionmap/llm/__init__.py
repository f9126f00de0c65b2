"""Training-data operators: mixing, quality, decontamination, chat formatting,
sharding, deduplication, language identification, token counts and alignment,
embedding whitening.

``all_queries()`` and ``all_sql()`` are what the driver entry adds; nothing
else in the library imports this package.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value, so these need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def all_queries() -> dict:
    from sectionmap.llm.queries import QUERIES
    return dict(QUERIES)


def all_sql() -> dict:
    from sectionmap.llm.oracle import SQL
    return dict(SQL)
