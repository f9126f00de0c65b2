import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from sectionmap.session import checkpoint_base, local_session
    s = local_session("*", 8, app="sectionmap-tests")
    # The checkpoint folder comes from spark.checkpoint.dir when configured;
    # otherwise (tests only) a local one is registered with the SparkContext.
    checkpoint_base(s)
    yield s


def rows(df, *cols):
    cols = cols or df.columns
    return [tuple(r[c] for c in cols) for r in df.collect()]
