"""Readers and writers: fall-back paths, star round trip, exports, generic cube."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from starlattice.functions.measures import mean_ratio, money_sum, row_count
from starlattice.operators import olap as O
from starlattice.plans.registry import star_for
from starlattice.plans.star import star_from_tables
from starlattice.session import scratch_path
from starlattice.sinks import writers
from starlattice.sources import fixtures, readers

from conftest import SMALL


def test_first_existing_falls_back_and_fails_clearly(spark):
    read = lambda s, p: s.read.parquet(p)
    df = readers.first_existing(spark, ["/nonexistent/a", f"{SMALL}/part.parquet"], read)
    assert "p_partkey" in df.columns
    with pytest.raises(FileNotFoundError) as err:
        readers.first_existing(spark, ["/nonexistent/a", "/nonexistent/b"], read)
    assert "/nonexistent/b" in str(err.value)


def test_star_round_trip_and_pointer(spark):
    star = star_for(spark, SMALL)
    root = scratch_path(spark, "wh-test")
    with pytest.raises(Exception):
        readers.read_star(spark, root)
    first = writers.write_star(star, root)
    back = star_from_tables(readers.read_star(spark, root), star.spec)
    assert back.fact.count() == star.fact.count()
    assert back.fact.agg(F.sum("revenue")).first()[0] == star.fact.agg(F.sum("revenue")).first()[0]
    second = writers.write_star(star, root)
    assert writers.current_build(spark, root) == second != first


def test_exports_keep_nulls_and_order(spark):
    star = star_for(spark, SMALL)
    path = scratch_path(spark, "export-test")
    writers.export_tables({"dim_product": star.dim_product}, path)
    raw = spark.read.text(f"{path}/dim_product")
    assert raw.where(F.col("value").contains('"package_size":null')).count() >= 1
    back = readers.read_bundle(spark, f"{path}/dim_product", star.dim_product.schema)
    assert back.count() == star.dim_product.count()


def test_generic_cube_on_events(spark):
    ev = spark.read.parquet(f"{SMALL}/events.parquet").select(
        F.to_date("ts").alias("day"), "event_type", "user_id",
        F.col("value").cast("decimal(18,2)").alias("value"),
        (F.col("value") / F.lit(100)).cast("decimal(18,4)").alias("ratio"))
    measures = [row_count("events"), money_sum("value", "total_value", 2),
                mean_ratio("ratio", "mean_ratio_pct", 2, True)]
    cube = O.cube(ev, ["event_type", "day"], measures)
    n = ev.count()
    sums = {r.slice: r.e for r in cube.groupBy("slice").agg(F.sum("events").alias("e")).collect()}
    assert set(sums) == {"full_cube", "rollup_event_type", "rollup_day", "grand_total"}
    assert all(v == n for v in sums.values())


def test_catalogue_csv_with_a_title_row(spark):
    from starlattice.operators.clean import clean_catalogue
    from starlattice.operators.dims import category_lookup
    path = scratch_path(spark, "catalogue-csv")
    lines = ["Product Catalogue 2025,,,,,,",
             "Product,Size,Pieces,Price,Box Price,Shelf Life,Category",
             " Mango Pickle ,500g,10,12.5,125,12 months,",
             "mango pickle,1kg,20,12.5,250,12 months, Sweet ",
             "Lemon Pickle,500g,10,11,110,9 months,Sour"]
    spark.createDataFrame([(ln,) for ln in lines], "value string").coalesce(1) \
        .write.mode("overwrite").text(path)
    first = F.col("_c0")
    raw = readers.read_catalogue(
        spark, path, fmt="csv", options={"header": "false"},
        title_rows=lambda df: first.isin("Product Catalogue 2025", "Product"))
    cat = clean_catalogue(raw)
    got = {r.product_type: r.category for r in category_lookup(cat).collect()}
    assert got == {"mango pickle": "sweet", "lemon pickle": "sour"}


def test_reconcile_reads_the_stored_summaries(spark):
    from starlattice.operators import checks as Q
    star = star_for(spark, SMALL)
    root = scratch_path(spark, "wh-reconcile")
    writers.write_star(star, root)
    back = star_from_tables(readers.read_star(spark, root), star.spec)
    assert "summary_monthly" in back.stored
    rows = {r.source: r for r in Q.reconcile(back).collect()}
    assert rows["summary_monthly"].revenue == rows["fact_with_month"].revenue
    assert rows["summary_monthly"].transactions == rows["fact_with_month"].transactions
    assert rows["fact"].transactions >= rows["summary_product"].transactions


def test_readme_path_with_generic_readers(spark):
    """The README's use: generic readers over files, build, cube, write."""
    from starlattice.operators import analytics as A
    from starlattice.plans.star import build_star
    from starlattice.sources import fixtures
    master_path = fixtures.stage_transactions(spark, SMALL)
    cat_path = scratch_path(spark, "catalogue")
    fixtures.raw_catalogue(spark, SMALL).drop("_row").write.parquet(cat_path)
    star = build_star(readers.read_transactions(spark, master_path),
                      readers.read_catalogue(spark, cat_path))
    registry_star = star_for(spark, SMALL)
    assert star.rows == registry_star.rows
    assert O.star_cube(star).count() == O.star_cube(registry_star).count()
    assert sorted(map(tuple, A.profit_share(star).collect())) == \
        sorted(map(tuple, A.profit_share(registry_star).collect()))
    root = scratch_path(spark, "wh-readme")
    assert writers.write_star(star, root) == writers.current_build(spark, root)


@pytest.mark.parametrize("threshold", ["10m", "-1"])
@pytest.mark.parametrize("sheet", [fixtures.raw_transactions, fixtures.raw_monthly])
def test_sheets_of_sales_compile(spark, sheet, threshold):
    """No generated method of the sheets reaches the 8000 bytes above which the JVM only interprets."""
    keys = {"spark.sql.autoBroadcastJoinThreshold": threshold, "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        plan = sheet(spark, SMALL, 4)._jdf.queryExecution().executedPlan()
        module = getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$").__getattr__("MODULE$")
        codes = module.codegenStringSeq(plan)
        assert max(codes.apply(i)._3().maxMethodCodeSize() for i in range(codes.size())) < 8000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_monthly_sheets_join_the_tables_once(spark, monkeypatch):
    calls = []
    made = fixtures.sales_lines
    monkeypatch.setattr(fixtures, "sales_lines", lambda *a: calls.append(a) or made(*a))
    paths = fixtures.stage_monthly_sheets(spark, SMALL)
    assert len(calls) == 1 and len(paths) == 12
    text = [p for p in paths if "june_month" in p or "november_month" in p]
    assert [spark.read.parquet(p).columns[0] for p in text] == ["Sale Date", "Day"]
    rows = sum(spark.read.parquet(p).count() for p in paths)
    assert rows == made(spark, SMALL).where("sheet IS NOT NULL").count()
