"""The stored lattice: sizes, choice, answers from the smallest ancestor, growth, refolding."""

from __future__ import annotations

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from starlattice.functions.measures import cube_measures
from starlattice.operators import olap as O
from starlattice.plans import lattice as L
from starlattice.plans.registry import LATTICE_DIMENSIONS, _lattice, star_for
from starlattice.session import scratch_path

from conftest import SMALL

DIMS = ["a", "b", "c"]
SCHEMA = ("a string, b string, c string, revenue decimal(18,2), profit decimal(18,2), quantity decimal(18,6), "
          "profit_margin decimal(10,4), ok boolean")


@pytest.fixture(scope="module")
def measures(spark):
    return cube_measures()


def facts(spark, n=200):
    from decimal import Decimal as D
    rows = [(f"a{i % 7}", None if i % 5 == 0 else f"b{i % 5}", f"c{i % 2}", D(i), D(i) / 4, D(1), D("0.25"), i % 11 > 0)
            for i in range(n)]
    return spark.createDataFrame(rows, SCHEMA)


def cells(df):
    return df.withColumn(O.MATCHED, F.col("ok")).groupBy(*DIMS, O.MATCHED).agg(*[p for m in cube_measures() for p in m.partials])


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def direct(df, keep, members=None):
    members = members or {}
    if keep or members:
        df = O.dice(df.where("ok"), members)
    out = df.groupBy(*keep).agg(*[p for m in cube_measures() for p in m.partials])
    return rows(out.select(*[F.col(d) if d in keep else F.lit("All").alias(d) for d in DIMS], *[m.final for m in cube_measures()]))


def plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("budget", [None, 0, 10**9])
def test_every_subset_equals_the_direct_roll_up(spark, budget, measures):
    df = facts(spark)
    lattice = L.write_lattice(spark, scratch_path(spark, "lattice-test"), cells(df), DIMS, measures, budget)
    if budget == 0:
        assert [c.dims for c in lattice.cuboids] == [tuple(DIMS)]
    if budget == 10**9:
        assert len(lattice.cuboids) > 4
    for keep in [("a", "c"), ("b",), ()]:
        assert rows(lattice.answer(keep)) == direct(df, keep)
    if budget is None:
        for keep, members in [(("a",), {"a": ["a1", "a3"]}), (("a",), {"b": "b2", "c": "c0"}), ((), {"a": "nobody"})]:
            assert rows(lattice.answer(keep, members)) == direct(df, keep, members)


def test_sizes_and_greedy_choice(spark):
    df = cells(facts(spark))
    sizes = L.cuboid_sizes(df, DIMS, 6)
    for dims in [("a", "b", "c"), ("b",), ()]:
        assert abs(sizes[dims][0] - df.select(*dims, O.MATCHED).distinct().count()) <= 1
    # by hand: () saves 99 rows for 10 bytes, then (a) 90 for 100, then (b) 10 for 900
    hand = {("a", "b"): (100, 1000), ("a",): (10, 100), ("b",): (90, 900), (): (1, 10)}
    assert L.choose_cuboids(hand, 0) == [("a", "b")]
    assert L.choose_cuboids(hand, 100) == [("a", "b"), ()]
    assert L.choose_cuboids(hand, 110) == [("a", "b"), ("a",), ()]
    assert L.choose_cuboids(hand, 2000) == [("a", "b"), ("a",), ("b",), ()]


def test_null_members_do_not_share_a_sketch_value(spark):
    df = spark.createDataFrame([("x", None, True), (None, "x", True), (None, None, True)], "a string, b string, __matched boolean")
    assert L.cuboid_sizes(df, ["a", "b"], 1)[("a", "b")][0] == 3


def test_growth_and_refolding(spark, measures):
    df = facts(spark)
    root = scratch_path(spark, "lattice-test")
    first = L.write_lattice(spark, root, cells(df.where("a < 'a3'")), DIMS, measures, 10**9)
    L.extend_lattice(first, cells(df.where("a >= 'a3'")))
    grown = L.open_lattice(spark, root, measures)
    assert all(len(c.folders) == 2 for c in grown.cuboids)
    for keep in [("b", "c"), ("a",), ()]:
        assert rows(grown.answer(keep)) == direct(df, keep)
    L.refold(grown, 0)
    folded = L.open_lattice(spark, root, measures)
    assert [len(c.folders) for c in folded.cuboids] == [1]
    for keep in [("b", "c"), ()]:
        assert rows(folded.answer(keep)) == direct(df, keep)
    assert L.stored_cuboids(folded).first().n_dims == 3


def test_empty_cells(spark, measures):
    lattice = L.write_lattice(spark, scratch_path(spark, "lattice-test"), cells(facts(spark).where("false")), DIMS, measures)
    assert lattice.answer(["a"]).count() == 0
    total = lattice.answer([]).first()
    assert total.total_transactions == 0 and total.total_revenue is None


def test_bad_dimensions_and_missing_lattice(spark, measures):
    with pytest.raises(ValueError):
        L.write_lattice(spark, scratch_path(spark, "lattice-test"), cells(facts(spark)), ["a", "a"], measures)
    with pytest.raises(FileNotFoundError):
        L.open_lattice(spark, scratch_path(spark, "no-lattice"), measures)
    with pytest.raises(ValueError):
        _lattice(spark, SMALL).answer(["quarter"])


def test_an_answer_scans_one_small_cuboid_and_not_the_fact(spark):
    star, lattice = star_for(spark, SMALL), _lattice(spark, SMALL)
    assert max(len(c.dims) for c in lattice.cuboids) == len(LATTICE_DIMENSIONS) and len(lattice.cuboids) > 1
    for keep in L.subsets(LATTICE_DIMENSIONS):
        source, text = lattice.source(keep), plan(lattice.answer(keep))
        assert text.count("Scan parquet") == 2  # in the tree and in the details: one scan
        assert all(f in text for f in source.folders) or "..." in text
        assert "fact_sales" not in text
        assert all(source.rows <= c.rows for c in lattice.cuboids if set(keep) <= set(c.dims))
    diced = plan(lattice.answer(["product_name"], {"package_size": "500g"}))
    assert "EqualTo(package_size,500g)" in diced
    assert star.rows["dim_month"] > 0
