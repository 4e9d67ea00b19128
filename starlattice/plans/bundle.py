"""The query bundle (K3) and the cube metadata (K4).

The bundle pairs each of the eight analytical queries with its title,
description and the SQL text it stands for; its results are the lazy
DataFrames of ``operators.analytics``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import analytics as A
from ..sinks.writers import STAR_TABLES

# Titles and descriptions of the eight analytical queries.
QUERY_TEXTS = [
    ("revenue_by_month", "Revenue by Month",
     "Total revenue and profit grouped by each month."),
    ("products_by_revenue", "Top Products by Revenue",
     "Products ranked by total revenue across all months."),
    ("daily_sales_20", "Daily Sales Trend",
     "Revenue and units sold per day across all months."),
    ("margin_by_size", "Avg Margin by Package Size",
     "Average profit margin percentage for each package size."),
    ("margin_by_month", "Monthly Profit Margin Trend",
     "Average profit margin and transaction count per month."),
    ("category_size", "Revenue by Category and Size",
     "Revenue and units sold broken down by product category and package size."),
    ("best_days", "Best Selling Days (Top 10)",
     "Top 10 days by revenue across the entire period."),
    ("profit_share", "Profit Contribution by Product",
     "Each product's share of total profit across all sales."),
]

def _round_half_away(num: str, den: str) -> str:
    """SQL text: round_half_away(num / den) for integral num, den (NULL when den = 0)."""
    return (f"CASE WHEN {den} = 0 THEN NULL ELSE "
            f"(CASE WHEN ({num} < 0) <> ({den} < 0) THEN -1 ELSE 1 END) * "
            f"((2 * abs({num}) + abs({den})) div (2 * abs({den}))) END")


# AVG(profit_margin) * 100 rounded half away to 2 places, exactly: the margin
# has 4 decimals, so it is an integer of basis points.
_BP = "CAST(fs.profit_margin * 10000 AS DECIMAL(18,0))"
MARGIN_PCT = (f"CAST({_round_half_away(f'SUM({_BP})', f'COUNT({_BP})')} AS DOUBLE) / 100")
PROFIT_SHARE = ("CAST(" + _round_half_away(
    "CAST(SUM(fs.profit) * 1000000 AS DECIMAL(38,0))",
    "CAST((SELECT SUM(profit) FROM fact_sales) * 100 AS DECIMAL(38,0))") + " AS DOUBLE) / 100")

# The SQL each query of the bundle runs (Spark SQL over the star's views).
SQL_TEXTS = {
    "revenue_by_month": (
        "SELECT dm.month_name, CAST(ROUND(SUM(fs.revenue), 2) AS DOUBLE) AS revenue,\n"
        "       CAST(ROUND(SUM(fs.profit), 2) AS DOUBLE) AS profit\n"
        "FROM fact_sales fs JOIN dim_month dm ON fs.month_id = dm.month_id\n"
        "GROUP BY dm.month_id, dm.month_name ORDER BY dm.month_id"),
    "products_by_revenue": (
        "SELECT dp.product_name, CAST(ROUND(SUM(fs.revenue), 2) AS DOUBLE) AS total_rev\n"
        "FROM fact_sales fs JOIN dim_product dp ON fs.product_id = dp.product_id\n"
        "GROUP BY dp.product_name ORDER BY total_rev DESC, dp.product_name"),
    "daily_sales_20": (
        "SELECT dd.full_date, CAST(ROUND(SUM(fs.revenue), 2) AS DOUBLE) AS rev,\n"
        "       CAST(SUM(fs.quantity) AS BIGINT) AS units\n"
        "FROM fact_sales fs JOIN dim_date dd ON fs.date_id = dd.date_id\n"
        "GROUP BY dd.full_date ORDER BY dd.full_date LIMIT 20"),
    "margin_by_size": (
        f"SELECT dp.package_size, {MARGIN_PCT} AS avg_margin_pct\n"
        "FROM fact_sales fs JOIN dim_product dp ON fs.product_id = dp.product_id\n"
        "GROUP BY dp.package_size ORDER BY avg_margin_pct DESC NULLS LAST, dp.package_size"),
    "margin_by_month": (
        f"SELECT dm.month_name, {MARGIN_PCT} AS avg_margin_pct, COUNT(*) AS transactions\n"
        "FROM fact_sales fs JOIN dim_month dm ON fs.month_id = dm.month_id\n"
        "GROUP BY dm.month_name ORDER BY MIN(dm.month_id)"),
    "category_size": (
        "SELECT dp.category, dp.package_size, CAST(ROUND(SUM(fs.revenue), 2) AS DOUBLE) AS revenue,\n"
        "       CAST(SUM(fs.quantity) AS BIGINT) AS units\n"
        "FROM fact_sales fs JOIN dim_product dp ON fs.product_id = dp.product_id\n"
        "GROUP BY dp.category, dp.package_size\n"
        "ORDER BY revenue DESC, dp.category NULLS LAST, dp.package_size NULLS LAST"),
    "best_days": (
        "SELECT dm.month_name, dd.full_date, CAST(ROUND(SUM(fs.revenue), 2) AS DOUBLE) AS daily_rev\n"
        "FROM fact_sales fs JOIN dim_date dd ON fs.date_id = dd.date_id\n"
        "JOIN dim_month dm ON fs.month_id = dm.month_id\n"
        "GROUP BY dm.month_name, dd.full_date\n"
        "ORDER BY daily_rev DESC, dd.full_date, dm.month_name LIMIT 10"),
    "profit_share": (
        "SELECT dp.product_name, CAST(ROUND(SUM(fs.profit), 2) AS DOUBLE) AS total_profit,\n"
        f"       {PROFIT_SHARE} AS profit_share_pct\n"
        "FROM fact_sales fs JOIN dim_product dp ON fs.product_id = dp.product_id\n"
        "GROUP BY dp.product_name ORDER BY total_profit DESC, dp.product_name"),
}

RUNNERS = {
    "revenue_by_month": A.revenue_by_month,
    "products_by_revenue": A.products_by_revenue,
    "daily_sales_20": A.daily_sales,
    "margin_by_size": A.margin_by_size,
    "margin_by_month": A.margin_by_month,
    "category_size": A.category_size,
    "best_days": A.best_days,
    "profit_share": A.profit_share,
}

# The cube's dimension labels and measure names.
CUBE_DIMENSION_LABELS = ["Month", "Product", "Package Size"]
CUBE_MEASURE_NAMES = ["total_revenue", "total_profit", "total_units", "total_transactions",
                      "avg_margin_pct"]


def register_views(star, prefix: str = "") -> None:
    """The star's tables as temporary views for Spark SQL.

    ``fact_sales`` is the fact without ``sales_id`` (none of the bundle's
    queries reads the key), so numbering never runs for them.
    """
    star.measures.createOrReplaceTempView(f"{prefix}fact_sales")
    for name in ("dim_date", "dim_product", "dim_month"):
        star.dim(name).createOrReplaceTempView(f"{prefix}{name}")


def query_bundle(star, use_sql: bool = True) -> list[dict]:
    """[{id, title, description, sql, df}] for the eight analytical queries.

    With ``use_sql`` each result is ``spark.sql`` of the text it shows,
    over the star's views; otherwise the equivalent DataFrame operator.
    """
    if use_sql:
        register_views(star)
    run = (lambda qid: star.spark.sql(SQL_TEXTS[qid])) if use_sql else \
        (lambda qid: RUNNERS[qid](star))
    return [{"id": qid, "title": title, "description": desc, "sql": SQL_TEXTS[qid],
             "df": run(qid)} for qid, title, desc in QUERY_TEXTS]


def cube_metadata(cube: DataFrame, star, name: str = "sales cube") -> DataFrame:
    """One row: name, dimensions, measures, period (first - last month), cells.

    The first and last months are those of the smallest and largest month_id,
    whatever their names. ``cube`` may be the written cube, read back.
    """
    period = star.dim_month.agg(F.concat_ws(" - ", F.min_by("month_name", "month_id"),
                                            F.max_by("month_name", "month_id"))).scalar()
    cells = cube.agg(F.count(F.when(F.col("grouping_id") == 0, F.lit(1))).alias("total_cells"))
    return cells.select(F.lit(name).alias("cube_name"),
                        F.array(*[F.lit(x) for x in CUBE_DIMENSION_LABELS]).alias("dimensions"),
                        F.array(*[F.lit(x) for x in CUBE_MEASURE_NAMES]).alias("measures"),
                        period.alias("period"),
                        F.col("total_cells").cast("bigint").alias("total_cells"))


def dashboard_datasets(star) -> dict[str, DataFrame]:
    """The eleven datasets of the dashboard: six tables, five queries."""
    return {**{t: star.table(t) for t in STAR_TABLES}, "kpis": A.kpis(star),
            "product_revenue": A.revenue_by_product(star), "size_revenue": A.revenue_by_size(star),
            "daily_trend": A.daily_trend(star), "top_records": A.top_records(star)}
