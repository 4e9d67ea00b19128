"""The Z-ordered fact and the bucketed fact: results as without them, fewer files, no shuffle of the fact."""

from __future__ import annotations

import contextlib
import io
from decimal import Decimal as D
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from starlattice.operators import olap as O
from starlattice.plans import bucketed as B
from starlattice.plans import layout as L
from starlattice.plans.registry import DICE_MEMBERS, star_for
from starlattice.session import scratch_path

from conftest import SMALL


def rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=str)


def plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("simple")
    return buf.getvalue()


def test_interleaved_bits(spark):
    values = [(a, b, c) for a in (0, 1, 5, 1023) for b in (0, 2, 7, 512) for c in (0, 3, 1000)]
    got = spark.createDataFrame(values, "a int, b int, c int").select("a", "b", "c", L.interleaved([F.col(x) for x in "abc"], 20).alias("z")).collect()
    for r in got:
        want = sum(((v >> i) & 1) << (3 * i + j) for j, v in enumerate((r.a, r.b, r.c)) for i in range(20))
        assert r.z == want
    with pytest.raises(ValueError):
        L.interleaved([F.col("a")] * 4, 16)


def test_codes_keep_the_order_of_members(spark):
    members = spark.createDataFrame([(f"m{i:03}",) for i in range(100)] + [(None,), ("m001",)], "m string")
    for bits in (16, 4):
        codes, n = L.member_codes(members, "m", bits)
        got = [(r.member or "", r.code) for r in codes.collect()]
        ordered = [c for _, c in sorted(got)]
        assert n == 101 and ordered == sorted(ordered) and min(ordered) == 1 and max(ordered) < 1 << bits
        assert len(set(ordered)) == min(101, (1 << bits) - 1)


@pytest.fixture(scope="module")
def star(spark):
    return star_for(spark, SMALL)


@pytest.fixture(scope="module")
def layout(star):
    return L.write_layout(star, scratch_path(star.spark, "layout-test"), files=64)


def test_dices_equal_and_open_few_files(star, layout):
    names = [r.product_name for r in star.dim_product.select("product_name").distinct().orderBy("product_name").limit(3).collect()]
    dices = [DICE_MEMBERS, {"product_name": names}, {"package_size": "500g", "product_name": names[0]},
             {"package_size": ["1kg", "5kg"], "month_name": ["1995-03"]}, {"month_name": "1995-03"}, {"product_name": "nobody"}]
    opened = []
    for members in dices:
        assert rows(layout.dice(members)) == rows(O.dice(O.denormalize(star, star.fact), members))
        some, every = layout.files(members)
        assert every > 40
        opened.append(some / every)
    assert opened[-1] == 0
    # a dimension alone leaves out half of the files or more, two together more than that
    assert max(opened) <= 0.6 and opened[2] < min(opened[1], 0.25) and opened[3] < 0.25
    # files named by month alone would be opened whatever product is asked for
    assert layout.files({"product_name": names[0]})[0] < 0.5 * layout.files({})[0]


def test_layout_keeps_every_fact(star, layout):
    assert rows(layout.read({})) == rows(star.fact)
    with pytest.raises(ValueError, match="not columns"):
        layout.dice({"category": "x"})


def test_bucketed_join_moves_no_fact(star):
    tables = B.write_bucketed(star, buckets=6, name="bucket_test")
    assert B.bucket_spec(star.spark, "bucket_test_fact") == B.BucketSpec(6, ("product_id", B.SALT))
    joined = tables.join(["product_name", "package_size"])
    assert "Exchange" not in plan(joined) and "SortMergeJoin" in plan(joined)
    side = star.dim_product.select("product_id", "product_name", "package_size")
    assert rows(joined) == rows(star.fact.join(side, "product_id"))
    assert rows(tables.join(["product_name"], "left")) == rows(star.fact.join(side.drop("package_size"), "product_id", "left"))


def test_hot_and_missing_keys_are_spread(spark):
    """Half of the facts have one product, a quarter none; no bucket holds them together."""
    n = 4000
    key = lambda i: 7 if i % 4 < 2 else None if i % 4 == 2 else i % 50 + 100
    fact = spark.createDataFrame([(i, key(i), D(i)) for i in range(n)], "sales_id bigint, product_id bigint, revenue decimal(18,2)")
    dim = spark.createDataFrame([(7, "hot"), *[(i + 100, f"p{i}") for i in range(50)], (999, "unsold")], "product_id bigint, product_name string")
    star = SimpleNamespace(spark=spark, fact=fact, dim_product=dim)
    tables = B.write_bucketed(star, buckets=16, name="bucket_hot")
    sizes = [r["n"] for r in spark.table("bucket_hot_fact").groupBy(F.input_file_name().alias("f")).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert sum(sizes) == n and max(sizes) < n / 3
    assert spark.table("bucket_hot_dim_product").count() < 52 + 2 * 16
    assert rows(tables.join()) == rows(fact.join(dim, "product_id"))
    assert rows(tables.join(how="left")) == rows(fact.join(dim, "product_id", "left"))
    B._write(dim.withColumn(B.SALT, F.lit(0)), "bucket_hot_other", ["product_id", B.SALT], 4)
    tables.dimension = "bucket_hot_other"
    with pytest.raises(ValueError, match="not bucketed alike"):
        tables.join()
