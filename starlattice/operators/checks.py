"""Integrity checks and audit counts (Q1-Q5, K5).

Parquet enforces no keys, so the warehouse constraints of the reference
(primary keys, foreign keys, NOT NULL) become checks that return small
result tables instead of raising. All are aggregates; the foreign-key
check is an anti join against the (checked-size) parent.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def check_primary_key(df: DataFrame, key: str, table: str) -> DataFrame:
    """rows, NULL keys and keys used more than once; valid when both are 0."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    return per_key.agg(
        F.lit(table).alias("table_name"), F.lit(key).alias("key_column"),
        F.coalesce(F.sum("__n"), F.lit(0)).cast("bigint").alias("rows"),
        F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("__n"))), F.lit(0))
         .cast("bigint").alias("null_keys"),
        F.count(F.when(F.col(key).isNotNull() & (F.col("__n") > 1), F.lit(1)))
         .cast("bigint").alias("duplicate_keys"))


def check_foreign_key(child: DataFrame, column: str, parent: DataFrame, parent_key: str,
                      child_name: str, parent_name: str) -> DataFrame:
    """Non-NULL child keys without a parent row (left anti join)."""
    keys = child.select(F.col(column).alias("__k")).where(F.col("__k").isNotNull())
    orphans = keys.join(parent.select(F.col(parent_key).alias("__k")), "__k", "left_anti")
    return orphans.agg(F.lit(child_name).alias("child_table"), F.lit(column).alias("column_name"),
                       F.lit(parent_name).alias("parent_table"),
                       F.count(F.lit(1)).cast("bigint").alias("orphan_rows"))


def check_not_null(df: DataFrame, columns: Sequence[str], table: str) -> DataFrame:
    """NULL count per named column; one row per column from one scan."""
    counts = df.agg(*[F.count(F.when(F.col(c).isNull(), F.lit(1))).alias(c) for c in columns])
    stacked = counts.select(F.explode(F.array(*[
        F.struct(F.lit(table).alias("table_name"), F.lit(c).alias("column_name"),
                 F.col(c).cast("bigint").alias("null_rows")) for c in columns])).alias("r"))
    return stacked.select("r.*")


def check_foreign_keys(child: DataFrame, links: Sequence[tuple[str, DataFrame, str, str]],
                       child_name: str) -> DataFrame:
    """Orphans of several foreign keys from ONE pass over ``child``.

    ``links``: (column, parent, parent key, parent name). Parent keys are
    unique, so each left join keeps the child's rows as they are.
    """
    j = child.select(*[column for column, _, _, _ in links])
    for i, (column, parent, key, _) in enumerate(links):
        known = parent.select(F.col(key).alias(f"__k{i}"))
        j = j.join(known, F.col(column) == F.col(f"__k{i}"), "left")
    counts = j.agg(*[F.count(F.when(F.col(column).isNotNull() & F.col(f"__k{i}").isNull(), F.lit(1)))
                     .cast("bigint").alias(f"__n{i}") for i, (column, _, _, _) in enumerate(links)])
    return counts.select(F.explode(F.array(*[
        F.struct(F.lit(child_name).alias("child_table"), F.lit(column).alias("column_name"),
                 F.lit(name).alias("parent_table"), F.col(f"__n{i}").alias("orphan_rows"))
        for i, (column, _, _, name) in enumerate(links)])).alias("r")).select("r.*")


def month_number(name) -> Column:
    """1-12 of a month written 'yyyy-MM' or by its English name; NULL otherwise."""
    name = F.col(name) if isinstance(name, str) else name
    return F.month(F.coalesce(F.try_to_date(name, "yyyy-MM"),
                              F.try_to_date(F.concat(F.lit("1 "), F.initcap(name), F.lit(" 2000")),
                                            "d MMMM yyyy")))


def check_month_agreement(star) -> DataFrame:
    """Facts whose month key (from the month text) disagrees with their date.

    One row: facts with an unmapped month, facts whose month agrees with
    the date's (year, month), facts where it does not, and facts of a month
    whose name tells no number.
    """
    dates = star.dim("dim_date").select("date_id", F.col("year").alias("__dy"),
                                        F.col("month_num").alias("__dm"))
    months = star.dim("dim_month").select("month_id", F.col("year").alias("__my"),
                                          month_number("month_name").alias("__mm"))
    j = star.measures.join(dates, "date_id").join(months, "month_id", "left")
    same = (F.col("__dy") == F.col("__my")) & (F.col("__dm") == F.col("__mm"))
    count = lambda c, name: F.count(F.when(c, F.lit(1))).cast("bigint").alias(name)
    mapped = F.col("month_id").isNotNull()
    return j.agg(count(~mapped, "unmapped_month"), count(mapped & same, "agree"),
                 count(mapped & F.col("__mm").isNotNull() & ~same, "disagree"),
                 count(mapped & F.col("__mm").isNull(), "unnumbered_month"))


def reconcile(star) -> DataFrame:
    """Totals from the fact, the two summaries and the joined fact, side by side.

    Facts with an unmapped month are absent from the monthly summary and
    facts with a NULL size from the product summary, so those rows show
    exactly how much each stored pre-aggregate leaves out. The fact is read
    once, for both of its rows.
    """
    types = {"r": "decimal(38,2)", "p": "decimal(38,2)", "q": "decimal(38,6)"}

    def row(source: str, r, p, q, n):
        return F.struct(F.lit(source).alias("source"),
                        F.round(r, star.spec.money_places).cast("double").alias("revenue"),
                        F.round(p, star.spec.money_places).cast("double").alias("profit"),
                        q.cast("double").alias("quantity"), n.cast("bigint").alias("transactions"))

    def rows(df: DataFrame, *structs) -> DataFrame:
        return df.select(F.explode(F.array(*structs)).alias("x")).select("x.*")

    months = star.dim("dim_month").select("month_id", F.lit(True).alias("__known"))
    known = F.coalesce(F.col("__known"), F.lit(False))
    names = {"r": "revenue", "p": "profit", "q": "quantity"}
    fact = star.measures.join(months, "month_id", "left").agg(
        *[F.sum(F.col(c)).alias(k) for k, c in names.items()], F.count(F.lit(1)).alias("n"),
        *[F.sum(F.when(known, F.col(c))).alias(f"m{k}") for k, c in names.items()],
        F.count(F.when(known, F.lit(1))).alias("mn"))
    out = rows(fact, row("fact", F.col("r"), F.col("p"), F.col("q"), F.col("n")),
               row("fact_with_month", F.col("mr"), F.col("mp"), F.col("mq"), F.col("mn")))
    for source in ("summary_monthly", "summary_product"):
        # stored summaries hold doubles; sum them as decimals so totals stay exact
        total = getattr(star, source).agg(
            *[F.sum(F.col(f"total_{names[k]}").cast(t)).alias(k) for k, t in types.items()],
            F.sum("num_transactions").alias("n"))
        out = out.unionByName(rows(total, row(source, F.col("r"), F.col("p"), F.col("q"), F.col("n"))))
    return out


def audit_counts(stages: dict[str, DataFrame]) -> DataFrame:
    """(stage, rows) for each named DataFrame, in the given order."""
    parts = [df.agg(F.count(F.lit(1)).cast("bigint").alias("rows"))
               .select(F.lit(i).cast("int").alias("step"), F.lit(name).alias("stage"), "rows")
             for i, (name, df) in enumerate(stages.items(), start=1)]
    return reduce(DataFrame.unionByName, parts)
