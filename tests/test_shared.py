"""The bundle from shared cells: its grain, its one scan, results equal to each query on its own, one document."""

from __future__ import annotations

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from starlattice.plans.bundle import query_bundle
from starlattice.plans.registry import star_for
from starlattice.plans.shared import (Report, bundle_document, bundle_reports, common_grain, document_rows, run_report,
                                      shared_bundle, shared_cells, _states)
from starlattice.functions.measures import money_sum
from starlattice.session import scratch_path

from conftest import SMALL


def plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def star(spark):
    return star_for(spark, SMALL)


def test_grain_and_states_are_the_fewest(star):
    reports = bundle_reports(star.spec)
    assert common_grain(list(reports.values())) == ["date_id", "month_id", "product_id"]
    assert common_grain([reports["margin_by_size"], reports["category_size"]]) == ["product_id"]
    # revenue, profit, units, margin sum and count, rows: six states for the seventeen partials of the eight queries
    assert len(_states(list(reports.values()))) == 6


def test_bundle_equals_each_query_in_order_and_never_scans_the_fact(star):
    for shared, own in zip(shared_bundle(star), query_bundle(star, False)):
        assert shared["df"].columns == own["df"].columns
        assert shared["df"].collect() == own["df"].collect(), shared["id"]
        text = plan(shared["df"])
        assert "shared-cells" in text and "fact_sales" not in text and "positions" not in text


def test_unresolved_keys_count_in_the_whole_only(spark, star):
    report = Report(("month_name",), (money_sum("profit", "p", 2),), share=("p", "profit", "pct"))
    class Half:
        spec, measures = star.spec, star.measures.withColumn("month_id", F.when(F.col("date_id") % 2 == 0, F.col("month_id")))
        dim = staticmethod(star.dim)
    out = run_report(Half, report, shared_cells(Half, [report]), [report])
    own = Half.measures.where("month_id is not null").agg(F.sum("profit")).first()[0]
    whole = Half.measures.agg(F.sum("profit")).first()[0]
    assert sum(r.pct for r in out.collect()) == pytest.approx(float(own / whole * 100), abs=0.5)
    assert own != whole


def test_document_holds_unlike_rows(spark, star):
    bundle = query_bundle(star, False)
    document = bundle_document(bundle, scratch_path(spark, "bundle-document"))
    assert dict(document.dtypes)["result"] == "variant"
    for item in bundle:
        back = document_rows(document, item["id"], item["df"].schema)
        assert back.schema.simpleString() == item["df"].schema.simpleString()
        assert sorted(map(str, back.collect())) == sorted(map(str, item["df"].collect()))
