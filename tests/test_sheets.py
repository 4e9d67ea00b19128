"""Headers below title lines: places of lines in files that are read in many blocks."""

from __future__ import annotations

import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from starlattice.sources.sheets import numbered_lines, read_sheets

NAMES = ["a", "b", "c"]


@pytest.fixture
def small_blocks(spark):
    """Blocks of 1,000 bytes."""
    keys = {"spark.sql.files.maxPartitionBytes": "1000", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def sheet(folder, name, lines, end="\n"):
    path = folder / f"sheet={name}"
    path.mkdir(parents=True, exist_ok=True)
    (path / "part-0.csv").write_bytes(end.join(lines).encode("utf-8"))
    return str(path)


def test_places_of_lines_in_many_blocks(spark, small_blocks, tmp_path):
    lines = {"x": [f"line {i} " + "é" * (i % 90) for i in range(500)], "y": ["", "only"], "z": ["w" * 5000, "end"]}
    paths = [sheet(tmp_path, n, ls) for n, ls in lines.items()]
    assert spark.read.text(paths).rdd.getNumPartitions() > 20
    got = numbered_lines(spark, paths).collect()
    assert len({(r.file, r.line_no) for r in got}) == len(got)
    for name, ls in lines.items():
        mine = sorted((r.line_no, r.line) for r in got if f"sheet={name}/" in r.file)
        assert mine == list(enumerate(ls))


@pytest.mark.parametrize("titles", [0, 1, 2, 40])
def test_titles_and_header_are_left_out(spark, small_blocks, tmp_path, titles):
    body = [f'{i},"with, comma {i}",' + "t" * (i % 50) for i in range(300)]
    one = ["Sales, of, many, fields " + "x" * 60] * titles + ["h1,h2,h3", *body]
    two = ["﻿Title" if titles else "﻿A,B,C", *["" for _ in range(max(0, titles - 1))], *(["A,B,C"] if titles else []), *body[:5], "  ", body[5]]
    paths = [sheet(tmp_path, "june_month_sales", one), sheet(tmp_path, "one+1", two, "\r\n")]
    got = read_sheets(spark, paths, NAMES, titles)
    rows = sorted(((r.sheet, r._row.line_no, int(r.a), r.b, r.c) for r in got.collect()))
    cell = lambda i: (i, f"with, comma {i}", "t" * (i % 50) or None)
    assert [r[2:] for r in rows if r[0] == "june_month_sales"] == [cell(i) for i in range(300)]
    assert [r[2:] for r in rows if r[0] == "one+1"] == [cell(i) for i in range(6)]
    assert [r[1] for r in rows if r[0] == "one+1"] == [titles + 1 + i for i in range(5)] + [titles + 7]


def test_wrong_numbers_of_fields(spark, tmp_path):
    bad_header = sheet(tmp_path, "h", ["title", "a,b", "1,2,3"])
    with pytest.raises(PySparkException, match="header does not have 3 fields: .*sheet=h.* line 2"):
        read_sheets(spark, bad_header, NAMES, 1).collect()
    bad_row = sheet(tmp_path, "r", ["title", "a,b,c", "1,2,3", "1,2,3,4", "5"])
    with pytest.raises(PySparkException, match="row does not have 3 fields"):
        read_sheets(spark, bad_row, NAMES, 1).collect()
    kept = read_sheets(spark, bad_row, NAMES, 1, keep_corrupt=True)
    assert sorted(r._corrupt_record for r in kept.where(F.col("_corrupt_record").isNotNull()).collect()) == ["1,2,3,4", "5"]


def test_short_and_empty_sheets(spark, tmp_path):
    paths = [sheet(tmp_path, "none", []), sheet(tmp_path, "titles", ["one", "two"]), sheet(tmp_path, "head", ["one", "two", "a,b,c"])]
    assert read_sheets(spark, paths, NAMES, 2).collect() == []
    assert os.path.getsize(f"{paths[0]}/part-0.csv") == 0


def test_header_of_each_sheet_without_a_sort_of_its_lines(spark):
    from starlattice.plans.registry import titled_headers
    found = titled_headers(spark, "/root/testdata/sf0.001")
    assert {r.files for r in found.collect()} == {2} and found.count() == 12
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" in plan and "SortAggregate(key=[file" not in plan


def sales(spark, folder, day):
    """Tables of 60 parts, 120 orders with the day given, and 600 lines."""
    spark.range(60).selectExpr("id AS p_partkey", "concat('part, ', id) AS p_name", "concat('type ', id % 7) AS p_type",
                               "int(id % 50 + 1) AS p_size", "double(900 + id) AS p_retailprice").write.parquet(f"{folder}/part.parquet")
    spark.range(120).selectExpr("id AS o_orderkey", f"{day} AS o_orderdate").write.parquet(f"{folder}/orders.parquet")
    spark.range(600).selectExpr(
        "id % 120 AS l_orderkey", "id % 61 AS l_partkey", "int(id div 120) AS l_linenumber", "double(id % 50 + 1) AS l_quantity",
        "double(1000 + id) AS l_extendedprice", "double(id % 10) / 100 AS l_discount").write.parquet(f"{folder}/lineitem.parquet")
    return str(folder)


def test_titled_sheets_from_shares_of_the_orders(spark, tmp_path):
    import gzip
    from collections import Counter

    from starlattice.operators.clean import MONTHLY_COLUMNS
    from starlattice.sources import fixtures
    small = sales(spark, tmp_path, "cast(add_months(date '2020-01-05', int(id)) AS timestamp)")
    before = {k: spark.conf.get(k) for k in ("spark.sql.maxConcurrentOutputFileWriters", "spark.sql.unionOutputPartitioning")}
    path = fixtures.stage_titled_sheets(spark, small, lines_at_once=150)
    assert before == {k: spark.conf.get(k) for k in before}
    columns = [f"`{c}` AS c{i}" for i, c in enumerate([*MONTHLY_COLUMNS, "sheet"])]
    got = read_sheets(spark, path, MONTHLY_COLUMNS, fixtures.MONTHLY_TITLES).drop("_row").selectExpr(*columns)
    own = fixtures.raw_monthly(spark, small).toDF(*MONTHLY_COLUMNS, "sheet").selectExpr(*columns)
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, own.collect()))
    files = [os.path.join(at, f) for at, _, fs in os.walk(path.removeprefix("file:")) for f in fs if f.endswith(".txt.gz")]
    assert len(files) == 24
    for f in files:
        title, blank, header, *rows = gzip.open(f, "rt").read().splitlines()
        assert (title, blank) == ("Monthly sales", "") and header.endswith(",Profit,Margin %") and rows
    assert not [d for d in os.listdir(os.path.dirname(path.removeprefix("file:"))) if d.startswith("titled-lines")]


def test_rows_without_a_day_are_on_a_sheet_of_their_own(spark, tmp_path):
    from starlattice.operators.clean import MONTHLY_COLUMNS
    from starlattice.sources import fixtures
    sales(spark, tmp_path, "CASE WHEN id % 5 > 0 THEN cast(add_months(date '2020-01-05', int(id)) AS timestamp) END")
    path = fixtures.stage_titled_sheets(spark, str(tmp_path))
    got = read_sheets(spark, path, MONTHLY_COLUMNS, fixtures.MONTHLY_TITLES).groupBy("sheet").count().collect()
    own = fixtures.raw_monthly(spark, str(tmp_path)).groupBy(F.coalesce("sheet", F.lit("__HIVE_DEFAULT_PARTITION__"))).count().collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, own)) and len(got) == 13
