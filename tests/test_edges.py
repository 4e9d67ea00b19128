"""Edges of the builders and writers that the fixture alone would not show."""

from __future__ import annotations

import pytest
from conftest import SMALL, raw_master
from pyspark.sql import functions as F

from starlattice.functions.text import path_leaf_dir, source_tag
from starlattice.operators import analytics as A
from starlattice.operators import checks as Q
from starlattice.operators import olap as O
from starlattice.operators.clean import MONTHLY_COLUMNS, clean_monthly
from starlattice.operators.dims import month_dim_from_rows
from starlattice.operators.numbering import sequential_ids
from starlattice.plans.bundle import cube_metadata
from starlattice.plans.registry import star_for
from starlattice.plans.star import build_star
from starlattice.session import scratch_path
from starlattice.sinks import writers
from starlattice.sources import readers
from starlattice.spec import StarSpec

SALES = [("2025-06-01", "June ", "Mango", "500g", "2", "6.00", "1.00", "0.1667"),
         ("2025-08-02", "august", "Lime", "500g", "1", "6.00", "2.00", "0.3333")]
MONTHS = [(1, "June", "june", 2, 2025), (2, "July", "july", 3, 2025), (3, "August", "august", 3, 2025)]


def named(spark, rows=SALES, months=MONTHS, **spec):
    return build_star(raw_master(spark, rows), None, StarSpec(**spec), dim_month=month_dim_from_rows(spark, months))


def test_named_months_end_to_end(spark):
    star = named(spark)
    assert star.measures.count() == 2
    assert tuple(Q.check_month_agreement(star).first()) == (0, 2, 0, 0)
    assert cube_metadata(O.star_cube(star), star).first().period == "June - August"
    assert A.kpis(star).first().total_revenue == 12.0


def test_months_without_a_number_are_counted(spark):
    star = named(spark, months=[(1, "Summer", "june", 2, 2025), (2, "August", "august", 3, 2025)])
    assert tuple(Q.check_month_agreement(star).first()) == (0, 1, 0, 1)


def test_repeated_month_keys_are_rejected(spark):
    with pytest.raises(ValueError, match="month_key"):
        named(spark, months=[*MONTHS, (4, "Juin", "June", 2, 2025)])
    rows = [*SALES, ("2024-06-01", "june", "Mango", "500g", "2", "6.00", "1.00", "0.1")]
    with pytest.raises(ValueError, match="month_key"):
        build_star(raw_master(spark, rows), None, StarSpec(month_key_format="MMMM"))


def test_blank_date_keeps_the_sale(spark):
    star = named(spark, [*SALES, ("  ", "June", "Mango", "500g", "1", "1.00", "1.00", "1")])
    rows = star.measures.collect()
    assert len(rows) == 3 and sum(r.date_id is None for r in rows) == 1


def test_quantities_are_never_rounded_away(spark):
    star = named(spark, [(*SALES[0][:4], "0.00004", *SALES[0][5:])])
    assert float(star.measures.first().quantity) == 0.00004
    with pytest.raises(Exception, match="digits lost"):
        named(spark, [(*SALES[0][:4], "0.00000004", *SALES[0][5:])]).measures.collect()
    with pytest.raises(Exception, match="does not fit"):
        named(spark, [(*SALES[0][:4], "1e30", *SALES[0][5:])])


def test_blank_size_and_category_count_as_other(spark):
    star = named(spark, [*SALES, (*SALES[0][:3], "  ", *SALES[0][4:])])
    assert {r.package_size: r.revenue for r in A.size_totals(star).collect()} == {"500g": 12.0, "Other": 6.0}


def test_source_tags_are_title_case_and_decoded(spark):
    df = spark.createDataFrame([("june-b_month_sales", "file:/a/june%20month+x/p.parquet"),
                                ("it's_month_sales", "file:/a/sheet=100%/p.parquet")], "sheet string, path string")
    got = [tuple(r) for r in df.select(source_tag("sheet", "_month_sales"), path_leaf_dir("path")).collect()]
    assert got == [("June-B", "june month+x"), ("It'S", "100%")]


def test_sheets_with_other_headers_are_all_read(spark):
    root = scratch_path(spark, "sheets")
    row = ["2025-06-01", "Mango", "500", "1", "2", "3", "4", "5", "6", "7", "8"]
    for sheet, head in (("june_month_sales", MONTHLY_COLUMNS),
                        ("july_month_sales", ["Sale Date", "Item", *MONTHLY_COLUMNS[2:]])):
        spark.createDataFrame([row], [*head]).write.parquet(f"{root}/{sheet}")
    paths = [f"{root}/june_month_sales", f"{root}/july_month_sales"]
    assert sorted(r.month_source for r in clean_monthly(readers.read_monthly(spark, paths)).collect()) == ["July", "June"]
    spark.createDataFrame([row[:10]], MONTHLY_COLUMNS[:10]).write.parquet(f"{root}/may_month_sales")
    with pytest.raises(ValueError, match="expected 11"):
        readers.read_monthly(spark, [*paths, f"{root}/may_month_sales"])


def test_a_failed_switch_leaves_the_previous_build(spark, monkeypatch):
    star = star_for(spark, SMALL)
    root = scratch_path(spark, "wh-switch")
    first = writers.write_star(star, root)

    def broken(*args):
        raise RuntimeError("switch failed")

    monkeypatch.setattr(writers, "switch_build", broken)
    with pytest.raises(RuntimeError):
        writers.write_star(star, root)
    assert writers.current_build(spark, root) == first


def test_equal_csv_rows_spread_over_numbering_partitions(spark):
    path = scratch_path(spark, "csv")
    spark.range(30_000).selectExpr("if(id % 3 = 0, 0, id) as k").repartition(4).write.csv(path)
    df = readers.read_transactions(spark, path, "k bigint", "csv")
    keep: dict = {}
    out = sequential_ids(df, [F.col("k"), F.col("_src")], "rid", partitions=8, keep=keep)
    assert out.count() == 30_000
    assert max(r.rows for r in keep["partition_rows"].collect()) < 30_000 // 4


def test_empty_star_has_one_grand_total(spark):
    star = named(spark, [])
    rows = O.star_cube(star).collect()
    assert [(r.slice, r.total_revenue, r.total_transactions) for r in rows] == [("grand_total", None, 0)]
