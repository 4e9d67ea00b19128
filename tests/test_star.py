"""Star build and analytics on hand-made sheets (golden totals and edge cases)."""

from __future__ import annotations

from decimal import Decimal

import pytest

from starlattice.operators import analytics as A
from starlattice.operators import checks as Q
from starlattice.operators import olap as O
from starlattice.operators.clean import clean_monthly, keep_date_like
from starlattice.plans.star import build_star

from conftest import raw_catalogue, raw_master


def _rows_for(total: Decimal, count: int, date: str, month: str, product: str, size: str,
              profit_total: Decimal | None = None, margin: str = "0.4000"):
    """``count`` sale rows whose revenue sums exactly to ``total``."""
    each = (total / count).quantize(Decimal("0.01"))
    last = total - each * (count - 1)
    p_total = profit_total if profit_total is not None else Decimal(0)
    p_each = (p_total / count).quantize(Decimal("0.01"))
    p_last = p_total - p_each * (count - 1)
    rows = []
    for i in range(count):
        rev = last if i == count - 1 else each
        prof = p_last if i == count - 1 else p_each
        rows.append((date, month, product, size, "1", str(rev), str(prof), margin))
    return rows


@pytest.fixture(scope="module")
def published(spark):
    """Three months whose totals are the published monthly table."""
    rows = (_rows_for(Decimal("635876.00"), 82, "2025-06-10", "2025-06", "mango pickle", "500g")
            + _rows_for(Decimal("667207.00"), 99, "2025-07-10", "2025-07", "lemon pickle", "500g")
            + _rows_for(Decimal("489299.00"), 58, "2025-08-10", "2025-08", "mango pickle", "1kg"))
    cat = raw_catalogue(spark, [(" Mango Pickle ", "Pickle", 1), ("lemon pickle", None, 2)])
    return build_star(raw_master(spark, rows), cat)


def test_published_monthly_totals(published):
    got = {r.month_name: (r.revenue, ) for r in A.revenue_by_month(published).collect()}
    assert got == {"2025-06": (635876.0,), "2025-07": (667207.0,), "2025-08": (489299.0,)}
    k = A.kpis(published).collect()[0]
    assert k.total_revenue == 1792382.0 and k.total_transactions == 239
    sm = {r.month_name: r.num_transactions for r in published.summary_monthly.collect()}
    assert sm == {"2025-06": 82, "2025-07": 99, "2025-08": 58}


def test_dimensions_and_default_category(published):
    dp = {(r.product_name, r.package_size): (r.product_id, r.category)
          for r in published.dim_product.collect()}
    # ids follow (name, size); lemon has only a NULL category -> the default
    assert dp == {("lemon pickle", "500g"): (1, "pickle"), ("mango pickle", "1kg"): (2, "pickle"),
                  ("mango pickle", "500g"): (3, "pickle")}
    ids = sorted(r.sales_id for r in published.fact.select("sales_id").collect())
    assert ids == list(range(1, 240))


def test_product_and_profit_shares(spark):
    revenue = [558544, 413217, 326128, 270155, 224338]
    profit = [Decimal("247318.5"), Decimal("182166.5"), Decimal("166956.8"),
              Decimal("153082.6"), Decimal("1514.4")]
    rows = []
    for i, (r, p) in enumerate(zip(revenue, profit)):
        rows += _rows_for(Decimal(r), 3, "2025-06-0%d" % (i + 1), "2025-06", f"p{i}", "500g", p)
    star = build_star(raw_master(spark, rows), None)
    share = {r.product_name: r.revenue_share_pct for r in A.revenue_share(star, 1).collect()}
    assert share == {"p0": 31.2, "p1": 23.1, "p2": 18.2, "p3": 15.1, "p4": 12.5}
    ps = {r.product_name: r.profit_share_pct for r in A.profit_share(star).collect()}
    assert ps == {"p0": 32.93, "p1": 24.26, "p2": 22.23, "p3": 20.38, "p4": 0.2}
    assert sum(ps.values()) == pytest.approx(100.0, abs=1e-9)


def test_mean_of_ratios_not_ratio_of_sums(spark):
    rows = [("2025-06-01", "2025-06", "a", "500g", "1", "2", "1", "0.5"),
            ("2025-06-01", "2025-06", "a", "500g", "1", "10", "1", "0.1")]
    star = build_star(raw_master(spark, rows), None)
    assert A.kpis(star).collect()[0].avg_margin_pct == pytest.approx(30.0)
    assert A.margin_by_size(star).collect()[0].avg_margin_pct == 30.0


def test_unknown_month_and_null_size(spark):
    rows = [("2025-06-01", " June-ish ", "a", "500g", "1", "5", "1", "0.2"),
            ("2025-06-01", "2025-06", "a", None, "2", "9", "3", ""),
            ("2025-06-02", "2025-06", "b", "1kg", "x", "9", "3", "0.1")]   # dropped: bad qty
    star = build_star(raw_master(spark, rows), None)
    fact = star.fact.orderBy("sales_id").collect()
    assert len(fact) == 2 and fact[0].month_id is None and fact[1].month_id == 1
    c = {(r.slice, r.package_size): r for r in O.star_cube(star).collect()}
    # the unknown month is absent from joined sets, present in the grand total
    assert c[("grand_total", "All")].total_transactions == 2
    assert c[("rollup_month", "All")].total_transactions == 1
    # NULL size is its own member, never 'All'; and the product summary drops it
    assert c[("rollup_size", None)].total_transactions == 1
    assert c[("rollup_size", None)].avg_margin_pct is None
    assert {r.package_size for r in star.summary_product.collect()} == {"500g"}
    ck = Q.check_month_agreement(star).collect()[0]
    assert (ck.unmapped_month, ck.agree, ck.disagree) == (1, 1, 0)


def test_repeated_headers_dropped(spark):
    names = ["d", "p", "s", "q", "pp", "sp", "r", "cp", "tc", "pr", "m"]
    rows = [("date",) + ("x",) * 10 + ("june_month_sales",),
            ("date ",) + ("x",) * 10 + ("june_month_sales",),
            ("Date",) + ("x",) * 10 + ("june_month_sales",),
            ("2025-06-01",) + (" Mango ",) + ("x",) * 9 + ("june_month_sales",),
            (None,) + ("x",) * 10 + ("july_month_sales",)]
    df = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names) + ", sheet string")
    out = clean_monthly(df).collect()
    assert len(out) == 1 and out[0].product_type == "mango" and out[0].month_source == "June"
    kept = keep_date_like(df.withColumnRenamed("d", "date"), "date").collect()
    assert len(kept) == 1


def test_zero_total_share_is_null(spark):
    rows = [("2025-06-01", "2025-06", "a", "500g", "1", "5", "0", "0"),
            ("2025-06-01", "2025-06", "b", "500g", "1", "5", "0", "0")]
    star = build_star(raw_master(spark, rows), None)
    assert {r.profit_share_pct for r in A.profit_share(star).collect()} == {None}


def test_ties_are_broken_the_same_way(spark):
    rows = [(f"2025-06-0{d}", "2025-06", "a", "500g", "1", "100", "1", "0.01") for d in range(1, 6)]
    star = build_star(raw_master(spark, rows), None)
    first = [r.full_date for r in A.best_days(star, 3).collect()]
    assert first == sorted(first) and len(first) == 3
    assert [r.full_date for r in A.best_days(star, 3).collect()] == first


def test_empty_input(spark):
    star = build_star(raw_master(spark, []), None)
    k = A.kpis(star).collect()
    assert len(k) == 1 and k[0].total_revenue is None and k[0].total_transactions == 0
    cube = O.star_cube(star).collect()
    assert [r.slice for r in cube] == ["grand_total"] and cube[0].total_transactions == 0


def test_primary_and_foreign_keys_hold(published):
    pk = Q.check_primary_key(published.fact, "sales_id", "fact_sales").collect()[0]
    assert (pk.rows, pk.null_keys, pk.duplicate_keys) == (239, 0, 0)
    fk = Q.check_foreign_key(published.fact, "product_id", published.dim_product, "product_id",
                             "fact_sales", "dim_product").collect()[0]
    assert fk.orphan_rows == 0
    dup = published.fact.unionByName(published.fact.limit(1))
    assert Q.check_primary_key(dup, "sales_id", "x").collect()[0].duplicate_keys == 1


def test_one_pass_summaries_with_unknown_month_and_null_size(spark):
    from starlattice.plans.star import both_summaries
    rows = [("2025-06-01", " June-ish ", "a", "500g", "1", "5", "1", "0.2"),
            ("2025-06-01", "2025-06", "a", None, "2", "9", "3", ""),
            ("2025-06-03", "2025-06", "b", "1kg", "4", "9", "3", "0.1")]
    star = build_star(raw_master(spark, rows), None)
    monthly, product = both_summaries(star)
    assert sorted(map(tuple, monthly.collect())) == sorted(map(tuple, star.summary_monthly.collect()))
    assert sorted(map(tuple, product.collect())) == sorted(map(tuple, star.summary_product.collect()))
    assert {r.package_size for r in product.collect()} == {"500g", "1kg"}


def test_fixed_month_dimension_as_in_the_reference(spark):
    from starlattice.operators.dims import month_dim_from_rows
    months = month_dim_from_rows(spark, [(1, "June", "june", 2, 2025), (2, "July", "july", 3, 2025),
                                         (3, "August", "august", 3, 2025)])
    rows = [("2025-06-01", " June ", "a", "500g", "1", "5", "1", "0.2"),
            ("2025-07-01", "JULY", "a", "500g", "1", "7", "2", "0.3"),
            ("2025-09-01", "september", "a", "500g", "1", "9", "3", "0.3")]
    star = build_star(raw_master(spark, rows), None, dim_month=months)
    got = {r.month_name: r.revenue for r in A.revenue_by_month(star).collect()}
    assert got == {"June": 5.0, "July": 7.0}
    assert A.kpis(star).collect()[0].total_transactions == 3
