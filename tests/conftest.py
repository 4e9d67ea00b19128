from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from starlattice.session import checkpoint_root, get_session
    s = get_session("local[4]", "starlattice-tests", 4)
    s.sparkContext.setLogLevel("ERROR")
    checkpoint_root(s)  # set a folder only when the session has none
    yield s


MASTER_SCHEMA = ("`Date` string, `Month` string, `Product Type` string, `Unit Size` string, "
                 "`Quantity` string, `Revenue` string, `Profit` string, `Profit Margin` string")
CATALOGUE_SCHEMA = ("a string, b string, c string, d string, e string, f string, g string, "
                    "_row bigint")


def raw_master(spark, rows):
    """rows: (date, month, product, size, qty, revenue, profit, margin) as text."""
    return spark.createDataFrame(rows, MASTER_SCHEMA)


def raw_catalogue(spark, rows):
    """rows: (product, category, row order)."""
    return spark.createDataFrame(
        [(p, None, None, None, None, None, c, r) for p, c, r in rows], CATALOGUE_SCHEMA)
