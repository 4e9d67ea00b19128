"""Properties of numbering and the OLAP operators on the sf0.001 star."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from starlattice.functions.measures import mean_ratio, money_sum
from starlattice.operators import analytics as A
from starlattice.operators import olap as O
from starlattice.operators.numbering import sequential_ids
from starlattice.plans.registry import CALENDAR_MONTHS, star_for

from conftest import SMALL


@pytest.fixture(scope="module")
def star(spark):
    return star_for(spark, SMALL)


def test_distributed_ids_are_dense_and_ordered(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("k"),
                                     (F.col("id") % 3).alias("g"))
    out = sequential_ids(df, [F.col("k").asc()], "rid", partitions=6).collect()
    pairs = sorted((r.rid, r.k) for r in out)
    assert [p[0] for p in pairs] == list(range(1, 5001))
    assert [p[1] for p in pairs] == sorted(p[1] for p in pairs)


def test_distributed_ids_split_a_hot_key(spark):
    # one leading key holds every row: ties are split by the next key
    df = spark.range(0, 3000).select(F.lit(1).alias("hot"), F.col("id").alias("tie"))
    out = sequential_ids(df, [F.col("hot").asc(), F.col("tie").asc()], "rid", partitions=4)
    rows = out.collect()
    assert sorted(r.rid for r in rows) == list(range(1, 3001))
    assert all(r.rid == r.tie + 1 for r in rows)


def test_ids_do_not_depend_on_the_partition_count(spark):
    df = spark.range(0, 500).select(((F.col("id") * 37) % 500).alias("k"))
    a = {r.k: r.rid for r in sequential_ids(df, [F.col("k")], "rid", partitions=3).collect()}
    b = {r.k: r.rid for r in sequential_ids(df, [F.col("k")], "rid", partitions=1).collect()}
    assert a == b


def test_fact_ids_are_one_to_n(star):
    ids = [r.sales_id for r in star.fact.select("sales_id").orderBy("sales_id").collect()]
    assert ids == list(range(1, len(ids) + 1))


def _joined(star):
    return O.denormalize(star, None, ("dim_month", "dim_product"))


def test_cube_sets_sum_to_the_joined_total(star):
    cube = O.star_cube(star)
    joined_total = _joined(star).agg(F.count(F.lit(1)).alias("n")).collect()[0].n
    per_set = {r.slice: r.n for r in cube.groupBy("slice").agg(
        F.sum("total_transactions").alias("n")).collect()}
    for name, n in per_set.items():
        if name != "grand_total":
            assert n == joined_total, name
    fact_total = star.measures.count()
    assert per_set["grand_total"] == fact_total >= joined_total


def test_cube_equals_separate_slices(star):
    cube = O.star_cube(star)
    one = cube.where(F.col("slice") == "rollup_month_size").drop("slice", "grouping_id")
    sep = O.cube_slice(_joined(star), star.measures, ["month_name", "package_size"])
    assert sorted(map(tuple, one.collect()), key=str) == sorted(map(tuple, sep.collect()), key=str)


def test_slice_is_subset_and_dice_is_slice_of_slice(star):
    j = O.denormalize(star)
    month = j.select("month_name").first().month_name
    product = j.select("product_name").first().product_name
    sl = O.slice_(j, "month_name", month)
    assert sl.count() <= j.count()
    assert sl.where(F.col("month_name") != month).count() == 0
    diced = O.dice(j, {"month_name": [month], "product_name": product})
    twice = O.slice_(O.slice_(j, "month_name", month), "product_name", product)
    assert sorted(map(tuple, diced.collect()), key=str) == sorted(map(tuple, twice.collect()), key=str)


def test_roll_up_of_drill_down_is_roll_up(star):
    j = star.measures.join(star.dim("dim_date").select("date_id", "full_date", "month_name"),
                           "date_id")
    ms = [money_sum("revenue", "rev", None)]
    fine = O.drill_down(j, ["month_name", "full_date"], "month_name", ms)
    again = fine.groupBy("month_name").agg(F.sum("rev").alias("rev"))
    coarse = O.roll_up(j, ["month_name"], ms)
    a = {r.month_name: round(r.rev, 2) for r in again.collect()}
    b = {r.month_name: round(r.rev, 2) for r in coarse.collect()}
    assert a == b


def test_pivot_matches_grouped_margin(star):
    j = (star.measures.join(star.dim("dim_date").select("date_id", "month_name"), "date_id")
         .join(star.dim("dim_product").select("product_id", "product_name"), "product_id"))
    m = mean_ratio("profit_margin", "m", 2, True)
    pv = O.pivot(j, ["product_name"], "month_name", CALENDAR_MONTHS, m,
                 [f"{x.lower()}_margin" for x in CALENDAR_MONTHS])
    grouped = O.roll_up(j, ["product_name", "month_name"], [m])
    want = {(r.product_name, r.month_name): r.m for r in grouped.collect()}
    for r in pv.collect():
        for month in CALENDAR_MONTHS:
            assert r[f"{month.lower()}_margin"] == want.get((r.product_name, month)), month


def test_second_level_rollups_match_first_level(star):
    cs = A.category_size(star).collect()
    totals = {r.category: r.revenue for r in A.category_totals(star).collect()}
    for cat in totals:
        assert totals[cat] == pytest.approx(sum(r.revenue for r in cs if (r.category or "Other") == cat))


def test_bundle_sql_equals_dataframe_operators(star):
    from starlattice.plans.bundle import query_bundle
    for via_sql, via_df in zip(query_bundle(star, True), query_bundle(star, False)):
        assert via_sql["df"].columns == via_df["df"].columns, via_sql["id"]
        assert [tuple(r) for r in via_sql["df"].collect()] == \
            [tuple(r) for r in via_df["df"].collect()], via_sql["id"]


def test_one_pass_summaries_equal_separate_ones(star):
    from starlattice.plans.star import both_summaries
    monthly, product = both_summaries(star)
    for one, sep in ((monthly, star.summary_monthly), (product, star.summary_product)):
        assert one.columns == sep.columns
        assert sorted(map(tuple, one.collect()), key=str) == \
            sorted(map(tuple, sep.collect()), key=str)


def test_a_third_of_rows_as_exact_copies_still_spread(spark):
    """One group of identical sales holds a third of all rows: the lineage
    tie-breaker (file, row position) splits it across numbering partitions."""
    from starlattice.session import scratch_path
    from starlattice.sources.readers import read_transactions
    copies = spark.range(0, 20000).select(F.lit(1).alias("date_id"), F.lit(7).alias("product_id"),
                                          F.lit(5).alias("revenue"))
    others = spark.range(0, 40000).select((F.col("id") % 900 + 2).alias("date_id"),
                                          (F.col("id") % 13).alias("product_id"),
                                          (F.col("id") % 101).alias("revenue"))
    path = scratch_path(spark, "hot-copies")
    copies.unionByName(others).repartition(6).write.parquet(path)
    df = read_transactions(spark, path)
    keep: dict = {}
    order = [F.col("date_id"), F.col("product_id"), F.col("revenue"), F.col("_src")]
    out = sequential_ids(df, order, "rid", partitions=8, keep=keep)
    ids = sorted(r.rid for r in out.select("rid").collect())
    assert ids == list(range(1, 60001))
    sizes = [r.rows for r in keep["partition_rows"].collect()]
    assert sum(sizes) == 60000 and max(sizes) < 60000 * 0.25, sizes
    first = out.where(F.col("rid") <= 20000).agg(F.max("date_id")).first()[0]
    assert first == 1  # the copies (date 1) are numbered first, in one block
