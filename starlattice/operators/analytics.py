"""Analytical queries over the star.

Each is one aggregate over the fact joined to at most three broadcast
dimensions: a partial aggregate per task, one small shuffle, a final
aggregate. Sorts follow the reference's ORDER BY and add a tie-breaker,
so top-N answers are the same on every run; ``orderBy(..).limit(n)``
plans as ``TakeOrderedAndProject`` (a per-task top-n, no full sort).
Shares divide by a scalar subquery over the whole fact - the fact alone,
as in the reference, not the joined rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.measures import (aggregate, int_sum, mean_ratio, money_sum, row_count,
                                  share_pct)


def _date(star):
    return star.dim("dim_date").select("date_id", "full_date",
                                       F.col("month_name").alias("date_month_name"))


def _month(star):
    return star.dim("dim_month").select("month_id", "month_name")


def _product(star):
    return star.dim("dim_product").select("product_id", "product_name", "package_size", "category")


def _places(star) -> int:
    return star.spec.money_places


# --- the eight analytical queries -------------------------------------

def revenue_by_month(star) -> DataFrame:
    """Revenue and profit per month (grouped by month id), rounded."""
    j = star.measures.join(_month(star), "month_id")
    out = aggregate(j.groupBy("month_id", "month_name"), [F.col("month_id"), F.col("month_name")],
                    [money_sum("revenue", "revenue", _places(star)),
                     money_sum("profit", "profit", _places(star))])
    return out.orderBy("month_id").select("month_name", "revenue", "profit")


def products_by_revenue(star) -> DataFrame:
    """Products ranked by total revenue."""
    j = star.measures.join(_product(star), "product_id")
    out = aggregate(j.groupBy("product_name"), [F.col("product_name")],
                    [money_sum("revenue", "total_rev", _places(star))])
    return out.orderBy(F.desc("total_rev"), F.asc("product_name"))


def daily_sales(star, limit: int = 20) -> DataFrame:
    """Revenue and integer units per day, first ``limit`` days."""
    j = star.measures.join(_date(star), "date_id")
    out = aggregate(j.groupBy("full_date"), [F.col("full_date")],
                    [money_sum("revenue", "rev", _places(star)), int_sum("quantity", "units")])
    return out.orderBy("full_date").limit(limit)


def margin_by_size(star) -> DataFrame:
    """Mean margin percent per package size (NULL size is its own group)."""
    j = star.measures.join(_product(star), "product_id")
    out = aggregate(j.groupBy("package_size"), [F.col("package_size")],
                    [mean_ratio("profit_margin", "avg_margin_pct", 2, True, star.spec.ratio_places)])
    return out.orderBy(F.desc_nulls_last("avg_margin_pct"), F.asc_nulls_last("package_size"))


def margin_by_month(star) -> DataFrame:
    """Mean margin percent and transactions per month, in calendar order."""
    j = star.measures.join(_month(star), "month_id")
    m = mean_ratio("profit_margin", "avg_margin_pct", 2, True, star.spec.ratio_places)
    c = row_count("transactions")
    grouped = j.groupBy("month_name").agg(F.min("month_id").alias("__first_month"),
                                          *m.partials, *c.partials)
    return grouped.orderBy("__first_month").select("month_name", m.final, c.final)


def category_size(star) -> DataFrame:
    """Revenue and integer units per (category, size)."""
    j = star.measures.join(_product(star), "product_id")
    out = aggregate(j.groupBy("category", "package_size"),
                    [F.col("category"), F.col("package_size")],
                    [money_sum("revenue", "revenue", _places(star)), int_sum("quantity", "units")])
    return out.orderBy(F.desc("revenue"), F.asc_nulls_last("category"),
                       F.asc_nulls_last("package_size"))


def best_days(star, limit: int = 10) -> DataFrame:
    """Top days by revenue, with their month (ties: earlier date first)."""
    j = star.measures.join(_date(star), "date_id").join(_month(star), "month_id")
    out = aggregate(j.groupBy("month_name", "full_date"),
                    [F.col("month_name"), F.col("full_date")],
                    [money_sum("revenue", "daily_rev", _places(star))])
    return out.orderBy(F.desc("daily_rev"), F.asc("full_date"), F.asc("month_name")).limit(limit)


def _with_total(star, column: str, name: str) -> DataFrame:
    """Per product_name the sum of ``column`` as ``name``, with the total over all facts as ``__t``.

    The fact is grouped by its product key first, unresolved keys included;
    names and total both come from those few rows. The scalar subquery groups
    the same way, so its exchange is the same one and the fact is read once.
    """
    keyed = star.measures.groupBy("product_id").agg(F.sum(column).alias("__s"))
    # bound to a column once: the exact share refers to the total several times
    total = keyed.agg(F.sum("__s")).scalar()
    return (keyed.join(_product(star), "product_id").groupBy("product_name")
            .agg(F.sum("__s").alias(name)).withColumn("__t", total))


def profit_share(star) -> DataFrame:
    """Profit per product and its percent of all profit (fact alone)."""
    grouped = _with_total(star, "profit", "__p")
    out = grouped.select(
        "product_name",
        F.round("__p", _places(star)).cast("double").alias("total_profit"),
        share_pct(F.col("__p"), F.col("__t"), 2, _places(star)).alias("profit_share_pct"))
    return out.orderBy(F.desc("total_profit"), F.asc("product_name"))


# --- dashboard datasets --------------------------------------------------

def kpis(star) -> DataFrame:
    """A3: totals and the mean margin percent, unrounded; one row."""
    ms = [money_sum("revenue", "total_revenue", None),
          money_sum("profit", "total_profit", None),
          money_sum("quantity", "total_quantity", None),
          mean_ratio("profit_margin", "avg_margin_pct", None, True, star.spec.ratio_places),
          row_count("total_transactions")]
    partials = [p for m in ms for p in m.partials]
    return star.measures.agg(*partials).select(*[m.final for m in ms])


def revenue_by_product(star) -> DataFrame:
    """Unrounded revenue and profit per product."""
    j = star.measures.join(_product(star), "product_id")
    out = aggregate(j.groupBy("product_name"), [F.col("product_name")],
                    [money_sum("revenue", "revenue", None), money_sum("profit", "profit", None)])
    return out.orderBy(F.desc("revenue"), F.asc("product_name"))


def revenue_by_size(star) -> DataFrame:
    """Unrounded revenue per package size."""
    j = star.measures.join(_product(star), "product_id")
    out = aggregate(j.groupBy("package_size"), [F.col("package_size")],
                    [money_sum("revenue", "revenue", None)])
    return out.orderBy(F.desc("revenue"), F.asc_nulls_last("package_size"))


def daily_trend(star) -> DataFrame:
    """Unrounded revenue, profit and quantity per day, with the month name."""
    j = star.measures.join(_date(star), "date_id")
    out = aggregate(j.groupBy("full_date", "date_month_name"),
                    [F.col("full_date").alias("date"), F.col("date_month_name").alias("month_name")],
                    [money_sum("revenue", "revenue", None), money_sum("profit", "profit", None),
                     money_sum("quantity", "quantity", None)])
    return out.orderBy("date")


def top_records(star, limit: int = 50) -> DataFrame:
    """The largest sales with every dimension attribute (ties: lower id)."""
    f = star.fact
    j = (f.join(_date(star), "date_id").join(_product(star), "product_id")
          .join(_month(star), "month_id"))
    out = j.select(
        "sales_id", F.col("full_date").alias("date"), F.col("month_name").alias("month"),
        "product_name", "package_size",
        F.col("quantity").cast("double").alias("quantity"),
        F.col("revenue").cast("double").alias("revenue"),
        F.col("profit").cast("double").alias("profit"),
        F.round(F.col("profit_margin") * F.lit(100), 2).cast("double").alias("margin_pct"),
        F.col("revenue").alias("__rev"))
    return out.orderBy(F.desc("__rev"), F.asc("sales_id")).limit(limit).drop("__rev")


def _category_size_exact(star) -> DataFrame:
    """A18 with revenue kept as the rounded decimal, for exact second-level sums."""
    j = star.measures.join(_product(star), "product_id")
    return (j.groupBy("category", "package_size")
             .agg(F.round(F.sum("revenue"), _places(star)).alias("__rev")))


def category_totals(star) -> DataFrame:
    """The (category, size) revenues summed by category, NULL or '' -> 'Other'."""
    cs = _category_size_exact(star)
    key = F.coalesce(F.nullif(F.col("category"), F.lit("")), F.lit(star.spec.other_label)).alias("category")
    out = cs.groupBy(key).agg(F.sum("__rev").cast("double").alias("revenue"))
    return out.orderBy(F.desc("revenue"), F.asc("category"))


def size_totals(star) -> DataFrame:
    """The (category, size) revenues summed by size, NULL or '' -> 'Other'."""
    cs = _category_size_exact(star)
    key = F.coalesce(F.nullif(F.col("package_size"), F.lit("")), F.lit(star.spec.other_label)).alias("package_size")
    out = cs.groupBy(key).agg(F.sum("__rev").cast("double").alias("revenue"))
    return out.orderBy(F.desc("revenue"), F.asc("package_size"))


def revenue_share(star, places: int = 2) -> DataFrame:
    """Revenue per product and its percent of all revenue (fact alone)."""
    grouped = _with_total(star, "revenue", "__r")
    out = grouped.select(
        "product_name", F.round("__r", _places(star)).cast("double").alias("revenue"),
        share_pct(F.col("__r"), F.col("__t"), places, _places(star)).alias("revenue_share_pct"))
    return out.orderBy(F.desc("revenue"), F.asc("product_name"))


def best_members(star) -> DataFrame:
    """Best month by revenue and by margin, best product by revenue and profit.

    One aggregate per dimension carries both of its metrics, and a second one
    over its members takes both best ones (ties: the smaller member name), so
    the fact is read once per dimension.
    """
    def best(df: DataFrame, member: str, metrics: dict[str, str]) -> DataFrame:
        firsts = [F.min(F.struct(F.coalesce(-F.col(v).cast("double"), F.lit(float("inf"))).alias("low"),
                                 F.col(member).alias("member"), F.col(v).cast("double").alias("value")))
                  .alias(m) for m, v in metrics.items()]
        rows = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(f"{m}.member").alias("member"),
                                  F.col(f"{m}.value").alias("value")) for m in metrics])
        return df.agg(*firsts).select(F.explode(rows).alias("x")).select("x.*")
    places = _places(star)
    months = aggregate(star.measures.join(_month(star), "month_id").groupBy("month_name"),
                       [F.col("month_name")],
                       [money_sum("revenue", "revenue", places),
                        mean_ratio("profit_margin", "avg_margin_pct", 2, True,
                                   star.spec.ratio_places)])
    products = aggregate(star.measures.join(_product(star), "product_id").groupBy("product_name"),
                         [F.col("product_name")],
                         [money_sum("revenue", "total_rev", places),
                          money_sum("profit", "total_profit", places)])
    return best(months, "month_name", {"best_month_by_revenue": "revenue",
                                       "best_month_by_margin": "avg_margin_pct"}).unionByName(
        best(products, "product_name", {"top_product_by_revenue": "total_rev",
                                        "top_product_by_profit": "total_profit"})).where("member is not null")


def preview(df: DataFrame, n: int = 4) -> DataFrame:
    """The first ``n`` rows of an ordered result."""
    return df.limit(n)


def top_products(star, n: int = 6) -> DataFrame:
    """The ``n`` products with most revenue."""
    return products_by_revenue(star).limit(n)
