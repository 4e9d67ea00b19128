"""The star that grows by batches: stable keys, mergeable summaries, observed counts, rejected rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from starlattice.operators.clean import (clean_transactions, flag_transactions, kept_transactions,
                                         quarantine_transactions)
from starlattice.plans import growing as G
from starlattice.plans.star import build_star
from starlattice.session import materialize, scratch_path

from conftest import raw_catalogue, raw_master

FIRST = [("2024-02-01", "2024-02", "Rose", "100g", "1", "10.00", "2.50", "0.2500"),
         ("2024-02-03", "2024-02", "Mint", None, "2", "7.00", "1.00", "0.1429"),
         ("2024-02-03", "2024-03", "Mint", "1kg", "2", "7.00", "1.00", None)]
SECOND = [("2024-01-05", "2024-01", "Anis", "100g", "4", "3.33", "1.11", "0.3333"),
          ("2024-02-03", "2024-02", "rose ", "100g", "1", "0.00", "0.00", None),
          ("2024-03-09", "2024-03", "Mint", None, "1", "1.00", "-1.00", "-1.0000"),
          (None, "2024-03", "Mint", None, "1", "1.00", "1.00", "1.0000"),
          ("2024-03-09", "2024-03", None, None, "1", "1.00", "1.00", "1.0000"),
          ("2024-03-09", "2024-03", "Mint", None, "x", "y", "1.00", "1.0000")]


@pytest.fixture(scope="module")
def grown(spark):
    root = scratch_path(spark, "test-growing")
    catalogue = raw_catalogue(spark, [("Rose", "jam", 1), ("Anis", "tea", 2)])
    stars = []
    for name, rows in (("one", FIRST), ("two", SECOND)):
        G.append_batch(spark, root, raw_master(spark, rows), catalogue, name)
        stars.append({t: G.open_growing(spark, root).table(t).collect() for t in
                      ("dim_date", "dim_product", "dim_month", "fact_sales", "summary_monthly", "summary_product")})
    return root, catalogue, stars


def test_old_keys_stay_and_new_ones_follow(spark, grown):
    _, _, (before, after) = grown
    for table, key in G.IDS.items():
        old, new = {tuple(r) for r in before[table]}, {tuple(r) for r in after[table]}
        assert old <= new
        ids = sorted(r[key] for r in after[table])
        assert ids == list(range(1, len(ids) + 1))
        assert min((r[0] for r in new - old), default=len(old) + 1) == len(old) + 1
    assert [(r.product_name, r.package_size) for r in sorted(after["dim_product"])] == [
        ("mint", "1kg"), ("mint", None), ("rose", "100g"), ("anis", "100g")]
    assert [r.month_name for r in sorted(after["dim_month"])] == ["2024-02", "2024-01", "2024-03"]
    # the sale that named a month nobody had brought keeps no month
    assert sum(r.month_id is None for r in after["fact_sales"]) == 1


def test_summaries_equal_a_full_build(spark, grown):
    root, catalogue, (_, after) = grown
    full = build_star(raw_master(spark, FIRST[:2] + SECOND), catalogue)
    month = lambda rows: sorted(tuple(r)[1:] for r in rows)
    assert month(after["summary_monthly"]) == month(full.summary_monthly.collect())
    both = build_star(raw_master(spark, FIRST + SECOND), catalogue)
    assert month(after["summary_product"]) == month(both.summary_product.collect())
    star = G.open_growing(spark, root)
    rolled = G.roll_up_cells(star, G.stored_cells(spark, root), ["category"]).collect()
    assert {r.category: (r.total_revenue, r.num_transactions, r.avg_margin) for r in rolled} == {
        "jam": (10.0, 2, 0.25), "tea": (3.33, 1, 0.3333), "pickle": (15.0, 3, pytest.approx(-0.4286))}
    with pytest.raises(ValueError):
        G.roll_up_cells(star, G.stored_cells(spark, root), ["colour"])


def test_compaction_repeats_and_empty_batches(spark, grown):
    root, catalogue, (_, after) = grown
    expected = sorted(map(tuple, after["summary_monthly"]))
    assert len(G.current_commit(spark, root).cells) == 2
    assert len(G.compact(spark, root).cells) == 1
    again = G.append_batch(spark, root, raw_master(spark, SECOND), catalogue, "two")
    assert again.batches == ["one", "two"]
    G.append_batch(spark, root, raw_master(spark, SECOND[3:]), catalogue, "rejects only")
    G.append_batch(spark, root, raw_master(spark, []), catalogue, "nothing")
    star = G.open_growing(spark, root)
    assert sorted(map(tuple, star.summary_monthly.collect())) == expected
    counts = {r.batch: r for r in G.load_counts(spark, root).collect()}
    two = counts["two"]
    assert (two.raw_rows, two.clean_rows, two.facts, two.no_date, two.no_month) == (6, 3, 3, 0, 0)
    assert (two.rejected_no_date, two.rejected_no_product, two.rejected_bad_quantity, two.rejected_bad_revenue) == (1, 1, 1, 1)
    assert (counts["rejects only"].raw_rows, counts["rejects only"].facts) == (3, 0)
    assert counts["nothing"].raw_rows == 0
    assert all(r.dangling == 0 for r in G.dangling_keys(star).collect())
    with pytest.raises(FileNotFoundError):
        G.open_growing(spark, scratch_path(spark, "no-star"))


def test_summaries_of_a_grown_star_never_read_facts(spark, grown):
    root, _, _ = grown
    star = G.open_growing(spark, root)
    plan = star.summary_monthly._jdf.queryExecution().optimizedPlan().toString()
    assert "sales_id" not in plan and "total_revenue__s" in plan
    files = [f for df in (star.summary_monthly, star.summary_product) for f in df.inputFiles()]
    assert files and not [f for f in files if "/fact_sales/" in f]


def test_flags_keep_what_cleaning_keeps(spark):
    raw = raw_master(spark, FIRST + SECOND)
    kept = kept_transactions(flag_transactions(raw))
    assert sorted(map(str, kept.collect())) == sorted(map(str, clean_transactions(raw).collect()))
    out = quarantine_transactions(raw).collect()
    assert sorted((r.product_type or "", ",".join(r.reasons)) for r in out) == [
        ("", "no_product"), ("Mint", "bad_quantity,bad_revenue"), ("Mint", "no_date")]
    assert kept.count() + len(out) == raw.count()


def test_records_that_do_not_parse_are_kept_apart(spark, tmp_path):
    good = '{"Date": "2024-02-01", "Product Type": "Rose", "Quantity": "1", "Revenue": "2", "Profit": "1"}'
    (tmp_path / "sales.json").write_text(good + "\n{broken\n" + good + "\n")
    schema = ("`Date` string, `Month` string, `Product Type` string, `Unit Size` string, `Quantity` string, "
              "`Revenue` string, `Profit` string, `Profit Margin` string, `_corrupt_record` string")
    raw = spark.read.schema(schema).option("columnNameOfCorruptRecord", "_corrupt_record").json(str(tmp_path))
    assert kept_transactions(flag_transactions(raw)).count() == 2
    lost = quarantine_transactions(raw).collect()
    assert [(r["_corrupt_record"], r.reasons) for r in lost] == [("{broken", ["corrupt_record"])]


def test_new_members_are_null_safe(spark):
    known = spark.createDataFrame([("a", None), ("b", "x")], "n string, s string")
    found = spark.createDataFrame([("a", None), ("a", "x"), ("b", "x"), (None, None)], "name string, size string")
    new = G.new_members(found, known, {"n": "name", "s": F.col("size")})
    assert sorted(map(str, new.collect())) == sorted(map(str, found.where("name is null or (name = 'a' and size = 'x')").collect()))


def test_a_batch_is_parsed_once(spark, monkeypatch):
    """Members and facts read the batch's typed rows, not its text again."""
    seen = []
    monkeypatch.setattr(G, "materialize", lambda df, name: seen.append((name, df)) or materialize(df, name))
    root = scratch_path(spark, "test-parsed-once")
    G.append_batch(spark, root, raw_master(spark, FIRST), raw_catalogue(spark, [("Rose", "jam", 1)]), "one")
    assert [name for name, _ in seen] == ["batch-rows", "batch-members"]
    assert "batch-rows" in seen[1][1].inputFiles()[0]
    assert G.load_counts(spark, root).select("raw_rows", "clean_rows", "facts").first() == (3, 3, 3)


def test_a_stored_master_gives_the_same_star(spark):
    catalogue = raw_catalogue(spark, [("Rose", "jam", 1), ("Anis", "tea", 2)])
    lazy = build_star(raw_master(spark, FIRST + SECOND), catalogue)
    stored = build_star(raw_master(spark, FIRST + SECOND), catalogue, store_master=True)
    assert stored.master.schema == lazy.master.schema and "/master-" in stored.master.inputFiles()[0]
    for t in ("dim_date", "dim_product", "dim_month", "fact_sales"):
        assert sorted(map(str, stored.table(t).collect())) == sorted(map(str, lazy.table(t).collect()))
