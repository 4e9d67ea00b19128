"""Plan shapes: one scan and one shuffle for the cube, top-N without a full
sort, filters and column pruning at the scan, and no Python in any plan."""

from __future__ import annotations

import contextlib
import io
import re

import pytest

from starlattice.operators import analytics as A
from starlattice.operators import olap as O
from starlattice.plans.registry import queries, star_for
from starlattice.sources import readers

from conftest import SMALL


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def tree(df) -> str:
    """The operator tree of the formatted plan (before the per-node details)."""
    return plan(df).split("\n\n")[0]


@pytest.fixture(scope="module")
def star(spark):
    return star_for(spark, SMALL)


def test_cube_is_one_shuffle_over_one_scan(star):
    cube = O.star_cube(star)
    text, full = tree(cube), plan(cube)
    assert text.count("Expand") == 1
    shuffles = [ln for ln in text.splitlines()
                if "Exchange" in ln and "BroadcastExchange" not in ln]
    # facts to cells by key, cells to grouping sets
    assert len(shuffles) == 2, text
    fact_scans = [blk for blk in full.split("\n\n") if "Scan parquet" in blk
                  and "fact_sales" in blk]
    assert len(fact_scans) == 1, fact_scans
    # the Expand lies above the aggregate to cells, so it copies cells, not facts
    assert text.index("Expand") < text.rindex("HashAggregate")


def test_cube_of_a_lazy_star_reads_the_raw_sheet_once(spark):
    from starlattice.plans.star import build_star
    from starlattice.sources import fixtures
    raw = fixtures.stage_transactions(spark, SMALL)
    lazy = build_star(readers.read_transactions(spark, raw), fixtures.raw_catalogue(spark, SMALL))
    scans = [blk for blk in plan(O.star_cube(lazy)).split("\n\n")
             if "Scan parquet" in blk and "raw-transactions" in blk]
    assert len(scans) == 1, scans


def test_one_pass_foreign_keys(star):
    from starlattice.operators import checks as Q
    links = [(k, star.dim(d), k, d) for k, d in (("date_id", "dim_date"), ("product_id", "dim_product"),
                                                 ("month_id", "dim_month"))]
    full = plan(Q.check_foreign_keys(star.measures, links, "fact_sales"))
    assert len([b for b in full.split("\n\n") if "Scan parquet" in b and "fact_sales" in b]) == 1


def test_best_members_reads_the_fact_once_per_dimension(star):
    full = plan(A.best_members(star))
    assert len([b for b in full.split("\n\n") if "Scan parquet" in b and "fact_sales" in b]) == 2


def test_top_n_is_take_ordered(star):
    text = tree(A.top_records(star)) + tree(A.best_days(star))
    assert text.count("TakeOrderedAndProject") == 2


def test_filter_and_pruning_reach_the_scan(spark):
    df = readers.read_transactions(spark, f"{SMALL}/lineitem.parquet", lineage=False)
    q = df.where("l_quantity > 10").select("l_orderkey")
    text = plan(q)
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,10.0)]" in text
    assert re.search(r"ReadSchema: struct<l_orderkey:bigint,l_quantity:double>", text)


def test_no_python_in_any_registered_plan(spark):
    for name, fn in queries().items():
        text = plan(fn(spark, SMALL))
        for bad in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas",
                    "MapInPandas"):
            assert bad not in text, (name, bad)
