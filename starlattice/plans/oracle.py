"""Independent DuckDB SQL for every registered query.

A common prefix of CTEs rebuilds, in plain SQL over the raw tables, the
fixture sheets, their cleaning, the dimensions (numbered with
``row_number()``) and the fact; each query appends its own SELECT. The
exact-rounding rules are written with HUGEINT integer division.
"""

from __future__ import annotations

from ..functions.text import WHITESPACE
from ..operators.clean import REJECTIONS

WS = " || ".join(f"chr({ord(c)})" for c in WHITESPACE)


def hq(a: str, b: str, places: int) -> str:
    """round_half_away(a * 10^places / b) on integral values, NULL when b = 0."""
    A, B = f"CAST({a} AS HUGEINT)", f"CAST({b} AS HUGEINT)"
    return (f"(CASE WHEN {B} = 0 THEN NULL ELSE "
            f"(CASE WHEN ({A} < 0) <> ({B} < 0) THEN -1 ELSE 1 END) * "
            f"((2 * abs({A}) * {10 ** places} + abs({B})) // (2 * abs({B}))) END)")


def ratio(a: str, b: str, places: int) -> str:
    return f"(CAST({hq(a, b, places)} AS DOUBLE) / {10 ** places})"


def bp(col: str) -> str:
    return f"CAST({col} * 10000 AS HUGEINT)"


def margin_pct(col: str = "profit_margin", places: int | None = 2) -> str:
    """AVG(col) * 100 from basis points; ``places=None`` leaves it unrounded."""
    s, n = f"SUM({bp(col)})", f"COUNT({bp(col)})"
    if places is None:
        return f"(CASE WHEN {n} > 0 THEN CAST({s} AS DOUBLE) / (CAST({n} AS DOUBLE) * 100) END)"
    return ratio(s, f"{n} * 100", places)


def mean_frac(col: str = "profit_margin", places: int = 4) -> str:
    s, n = f"SUM({bp(col)})", f"COUNT({bp(col)})"
    return ratio(s, f"{n} * 10000", places)


def money(expr: str, places: int | None = 2) -> str:
    inner = f"ROUND(SUM({expr}), {places})" if places is not None else f"SUM({expr})"
    return f"CAST({inner} AS DOUBLE)"


def units(expr: str) -> str:
    return f"CAST(trunc(SUM({expr})) AS BIGINT)"


def share(part: str, whole: str, places: int = 2) -> str:
    return ratio(f"({part}) * 100 * 100", f"({whole}) * 100", places)


def clean(c: str) -> str:
    return f"lower(trim({c}, {WS}))"


SIZE = ("CASE WHEN p_size IS NULL THEN NULL WHEN p_size <= 10 THEN '100g' "
        "WHEN p_size <= 20 THEN '200g' WHEN p_size <= 30 THEN '500g' "
        "WHEN p_size <= 40 THEN '1kg' ELSE '5kg' END")

PREFIX = f"""
WITH lines AS (
  SELECT l.l_orderkey, l.l_linenumber, o.o_orderdate, p.p_name, p.p_type, p.p_size,
         CAST(l.l_quantity AS DECIMAL(12,0)) AS qty,
         CAST(p.p_retailprice AS DECIMAL(12,2)) AS price,
         CAST(l.l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l.l_discount AS DECIMAL(4,2))) AS rev_u
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN part p ON l.l_partkey = p.p_partkey
),
sales AS (
  SELECT *,
    CAST(ROUND(rev_u, 2) AS DECIMAL(18,2)) AS revenue,
    CAST(ROUND(rev_u - qty * price, 2) AS DECIMAL(18,2)) AS profit,
    CAST(qty * price AS DECIMAL(18,2)) AS cost,
    {hq("(rev_u - qty * price) * 10000", "rev_u * 10000", 4)} AS margin_bp,
    {SIZE} AS size
  FROM lines
),
raw_master AS (
  SELECT
    CASE WHEN l_orderkey % 13 = 0 THEN NULL WHEN l_orderkey % 37 = 0 THEN '   '
         ELSE strftime(o_orderdate, '%Y-%m-%d') END AS " Date",
    CASE WHEN l_orderkey % 19 = 0 THEN ' Unknown '
         ELSE ' ' || strftime(o_orderdate, '%Y-%m') || '  ' END AS "Month ",
    '  ' || upper(p_name) || chr(9) AS "Product Type",
    CASE WHEN l_orderkey % 17 = 0 THEN NULL WHEN l_orderkey % 41 = 0 THEN '   '
         ELSE ' ' || upper(size) || ' ' END AS "Unit Size",
    CASE WHEN l_orderkey % 7 = 0 THEN 'x'
         WHEN l_orderkey % 29 = 0 THEN CAST(qty AS VARCHAR) || '.000004'
         ELSE CAST(qty AS VARCHAR) END AS "Quantity",
    CAST(revenue AS VARCHAR) AS "Revenue_",
    CAST(profit AS VARCHAR) AS "Profit_",
    CASE WHEN l_orderkey % 23 = 0 THEN ''
         ELSE CAST(CAST(CAST(margin_bp AS DECIMAL(18,0)) * CAST('0.0001' AS DECIMAL(5,4))
                        AS DECIMAL(12,4)) AS VARCHAR) END AS "Profit Margin"
  FROM sales
),
normalized AS (
  SELECT " Date" AS date, "Month " AS month, "Product Type" AS product_type,
         "Unit Size" AS unit_size, "Quantity" AS quantity, "Revenue_" AS revenue,
         "Profit_" AS profit, "Profit Margin" AS profit_margin
  FROM raw_master
),
master_typed AS (
  SELECT CAST(nullif(trim(date, {WS}), '') AS DATE) AS date,
         {clean("month")} AS month, {clean("product_type")} AS product_type,
         {clean("unit_size")} AS unit_size,
         TRY_CAST(quantity AS DECIMAL(38,10)) AS quantity,
         TRY_CAST(revenue AS DECIMAL(38,10)) AS revenue,
         TRY_CAST(profit AS DECIMAL(38,10)) AS profit,
         TRY_CAST(profit_margin AS DECIMAL(38,10)) AS profit_margin
  FROM normalized WHERE date IS NOT NULL AND product_type IS NOT NULL
),
master AS (
  SELECT * FROM master_typed
  WHERE quantity IS NOT NULL AND revenue IS NOT NULL AND profit IS NOT NULL
),
raw_catalogue AS (
  SELECT
    CASE WHEN p_partkey % 29 = 0 THEN NULL ELSE ' ' || upper(p_name) || ' ' END AS "Product",
    upper({SIZE}) AS "Size",
    CAST(p_size AS VARCHAR) AS "Pieces",
    CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR) AS "Price per Piece",
    CAST(CAST(CAST(p_retailprice AS DECIMAL(12,2)) * p_size AS DECIMAL(18,2)) AS VARCHAR)
      AS "Price per Box",
    p_brand AS "Shelf Life",
    CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE ' ' || p_type || ' ' END AS "Category",
    p_partkey AS _row
  FROM part
),
catalogue AS (
  SELECT {clean('"Product"')} AS product_type, "Size" AS size, "Pieces" AS pieces_per_box,
         "Price per Piece" AS sell_price_per_piece, "Price per Box" AS sell_price_per_box,
         "Shelf Life" AS shelf_life, {clean('"Category"')} AS category, _row
  FROM raw_catalogue WHERE "Product" IS NOT NULL
),
category_map AS (
  SELECT product_type, arg_min(category, _row) AS category
  FROM catalogue WHERE category IS NOT NULL GROUP BY product_type
),
dim_date AS (
  SELECT row_number() OVER (ORDER BY full_date) AS date_id, full_date,
         CAST(dayofmonth(full_date) AS BIGINT) AS day,
         CAST(month(full_date) AS BIGINT) AS month_num,
         strftime(full_date, '%B') AS month_name,
         CAST(quarter(full_date) AS BIGINT) AS quarter,
         CAST(year(full_date) AS BIGINT) AS year,
         CAST(weekofyear(full_date) AS BIGINT) AS week_of_year
  FROM (SELECT DISTINCT date AS full_date FROM master WHERE date IS NOT NULL) d
),
pairs AS (SELECT DISTINCT product_type AS product_name, unit_size AS package_size FROM master),
dim_product AS (
  SELECT row_number() OVER (ORDER BY p.product_name ASC NULLS LAST,
                                     p.package_size ASC NULLS LAST) AS product_id,
         p.product_name, p.package_size, coalesce(c.category, 'pickle') AS category
  FROM pairs p LEFT JOIN category_map c ON p.product_name = c.product_type
),
dim_month AS (
  SELECT row_number() OVER (ORDER BY year, month_num) AS month_id,
         strftime(make_date(year, month_num, 1), '%Y-%m') AS month_name,
         lower(strftime(make_date(year, month_num, 1), '%Y-%m')) AS month_key,
         CAST(quarter(make_date(year, month_num, 1)) AS BIGINT) AS quarter,
         CAST(year AS BIGINT) AS year
  FROM (SELECT DISTINCT year, month_num FROM dim_date) m
),
keyed AS (
  SELECT m.*, d.date_id, p.product_id, mo.month_id
  FROM master m
  LEFT JOIN dim_date d ON m.date = d.full_date
  LEFT JOIN dim_product p ON m.product_type = p.product_name
                         AND m.unit_size IS NOT DISTINCT FROM p.package_size
  LEFT JOIN dim_month mo ON m.month = mo.month_key
),
facts AS (
  SELECT date_id, product_id, month_id,
         CAST(quantity AS DECIMAL(18,6)) AS quantity,
         CAST(ROUND(revenue, 2) AS DECIMAL(18,2)) AS revenue,
         CAST(ROUND(profit, 2) AS DECIMAL(18,2)) AS profit,
         CAST(ROUND(profit_margin, 4) AS DECIMAL(18,4)) AS profit_margin
  FROM keyed
),
fact_sales AS (
  SELECT row_number() OVER (ORDER BY date_id NULLS FIRST, product_id NULLS FIRST,
           month_id NULLS FIRST, quantity NULLS FIRST, revenue NULLS FIRST,
           profit NULLS FIRST, profit_margin NULLS FIRST) AS sales_id, *
  FROM facts
),
summary_monthly AS (
  SELECT dm.month_id, dm.month_name, dm.year,
         {money("f.revenue")} AS total_revenue, {money("f.profit")} AS total_profit,
         {money("f.quantity", None)} AS total_quantity,
         {mean_frac("f.profit_margin")} AS avg_margin,
         COUNT(*) AS num_transactions
  FROM facts f JOIN dim_month dm ON f.month_id = dm.month_id
  GROUP BY dm.month_id, dm.month_name, dm.year
),
summary_product AS (
  SELECT dp.product_id, dp.product_name, dp.package_size, dp.category,
         {money("f.revenue")} AS total_revenue, {money("f.profit")} AS total_profit,
         {money("f.quantity", None)} AS total_quantity,
         {mean_frac("f.profit_margin")} AS avg_margin,
         COUNT(*) AS num_transactions
  FROM facts f JOIN dim_product dp ON f.product_id = dp.product_id
  WHERE dp.package_size IS NOT NULL AND dp.category IS NOT NULL
  GROUP BY dp.product_id, dp.product_name, dp.package_size, dp.category
),
cube_joined AS (
  SELECT f.*, dm.month_name, dp.product_name, dp.package_size
  FROM facts f JOIN dim_month dm ON f.month_id = dm.month_id
  JOIN dim_product dp ON f.product_id = dp.product_id
),
raw_monthly AS (
  SELECT
    CASE WHEN l_orderkey % 11 = 0 THEN
           CASE l_linenumber % 3 WHEN 0 THEN 'date' WHEN 1 THEN 'date ' ELSE 'Date' END
         WHEN l_orderkey % 13 = 0 THEN NULL
         ELSE strftime(o_orderdate, '%Y-%m-%d') END AS "Date",
    ' ' || upper(p_name) AS "Product",
    size AS "Size (g)",
    CAST(qty AS VARCHAR) AS "Boxes Sold",
    CAST(p_size AS VARCHAR) AS "Pieces per Box",
    CAST(price AS VARCHAR) AS "Price per Piece",
    CASE WHEN l_orderkey % 31 = 0 THEN NULL ELSE CAST(revenue AS VARCHAR) END AS "Revenue",
    CAST(price AS VARCHAR) AS "Cost per Piece",
    CAST(cost AS VARCHAR) AS "Total Cost",
    CAST(profit AS VARCHAR) AS "Profit",
    CAST(CAST(CAST(margin_bp AS DECIMAL(18,0)) * CAST('0.01' AS DECIMAL(3,2)) AS DECIMAL(14,2))
         AS VARCHAR) AS "Margin %",
    lower(strftime(o_orderdate, '%B')) || '_month_sales' AS sheet
  FROM sales
),
monthly_named AS (
  SELECT "Date" AS date, "Product" AS product_type, "Size (g)" AS size_g,
         "Boxes Sold" AS quantity_sold_box, "Pieces per Box" AS pieces_per_box,
         "Price per Piece" AS selling_price_per_piece, "Revenue" AS revenue,
         "Cost per Piece" AS cost_per_piece, "Total Cost" AS total_cost, "Profit" AS profit,
         "Margin %" AS margin_pct, sheet
  FROM raw_monthly
),
monthly_dated AS (
  SELECT * REPLACE (TRY_CAST(trim(date, {WS}) AS DATE) AS date)
  FROM monthly_named
  WHERE date IS NOT NULL AND date NOT IN ('date', 'date ', 'Date')
)
"""

# the same prefix with the fixed list of named months as its month dimension
_HEAD, _, _TAIL = PREFIX.partition("dim_month AS (")
NAMED_PREFIX = (_HEAD + """dim_month AS (
  SELECT * FROM (VALUES (1, 'June', '1998-06', 2, 1998), (2, 'July', '1998-07', 3, 1998),
    (3, 'August', '1998-08', 3, 1998)) t(month_id, month_name, month_key, quarter, year)
),
""" + _TAIL[_TAIL.index("keyed AS ("):])

MONTHS = ["January", "February", "March", "April", "May", "June", "July", "August",
          "September", "October", "November", "December"]

CUBE_MEASURES = f"""{money("revenue")} AS total_revenue, {money("profit")} AS total_profit,
  {money("quantity", 0)} AS total_units, COUNT(*) AS total_transactions,
  {margin_pct()} AS avg_margin_pct"""


def _cube_slice(keep: list[str]) -> str:
    dims = ["month_name", "product_name", "package_size"]
    cols = ", ".join(d if d in keep else f"'All' AS {d}" for d in dims)
    if not keep:
        return f"SELECT {cols}, {CUBE_MEASURES} FROM facts"
    return f"SELECT {cols}, {CUBE_MEASURES} FROM cube_joined GROUP BY {', '.join(keep)}"


CUBE_SETS = [
    ("full_cube", 0, ["month_name", "product_name", "package_size"]),
    ("rollup_month_product", 1, ["month_name", "product_name"]),
    ("rollup_month_size", 2, ["month_name", "package_size"]),
    ("rollup_month", 3, ["month_name"]),
    ("rollup_product_size", 4, ["product_name", "package_size"]),
    ("rollup_product", 5, ["product_name"]),
    ("rollup_size", 6, ["package_size"]),
    ("grand_total", 7, []),
]

CUBE_ALL = " UNION ALL ".join(
    f"SELECT '{name}' AS slice, CAST({gid} AS BIGINT) AS grouping_id, * FROM ({_cube_slice(keep)})"
    for name, gid, keep in CUBE_SETS)

FACT_JOIN_ALL = """facts f JOIN dim_date dd ON f.date_id = dd.date_id
  JOIN dim_product dp ON f.product_id = dp.product_id
  JOIN dim_month dm ON f.month_id = dm.month_id"""

STAR_JOIN = """SELECT f.date_id, f.product_id, f.month_id, f.quantity, f.revenue, f.profit,
  f.profit_margin, dd.full_date, dd.month_name AS date_month_name, dd.day, dd.month_num,
  dd.quarter AS date_quarter, dd.year AS date_year, dd.week_of_year,
  dp.product_name, dp.package_size, dp.category,
  dm.month_name, dm.quarter AS month_quarter, dm.year AS month_year"""


def _q(body: str) -> str:
    return PREFIX + body


def _by_product(measures: str) -> str:
    return (f"SELECT dp.product_name, {measures} FROM facts f "
            f"JOIN dim_product dp ON f.product_id = dp.product_id GROUP BY dp.product_name")


QUERIES = {
    "scan_transactions": "SELECT * FROM raw_master",
    "scan_catalogue": "SELECT * EXCLUDE (_row) FROM raw_catalogue",
    "scan_monthly": "SELECT * FROM monthly_named",
    "star_roundtrip": """SELECT * FROM (VALUES ('dim_date', (SELECT COUNT(*) FROM dim_date)),
      ('dim_product', (SELECT COUNT(*) FROM dim_product)),
      ('dim_month', (SELECT COUNT(*) FROM dim_month)),
      ('fact_sales', (SELECT COUNT(*) FROM fact_sales)),
      ('summary_monthly', (SELECT COUNT(*) FROM summary_monthly)),
      ('summary_product', (SELECT COUNT(*) FROM summary_product))) t(table_name, rows)""",
    "export_summary_product": "SELECT * FROM summary_product",
    "export_dim_date": "SELECT * FROM dim_date",
    "normalize_columns": "SELECT * FROM normalized",
    "rename_positional": """SELECT "Product" AS product_type, "Size" AS size,
      "Pieces" AS pieces_per_box, "Price per Piece" AS sell_price_per_piece,
      "Price per Box" AS sell_price_per_box, "Shelf Life" AS shelf_life,
      "Category" AS category FROM raw_catalogue""",
    "drop_missing": "SELECT * FROM normalized WHERE date IS NOT NULL AND product_type IS NOT NULL",
    "keep_date_like": "SELECT * FROM monthly_dated WHERE date IS NOT NULL",
    "olap_slice": """SELECT fs.sales_id, dp.product_name, dp.package_size,
      CAST(fs.quantity AS DOUBLE) AS quantity, CAST(fs.revenue AS DOUBLE) AS revenue,
      CAST(fs.profit AS DOUBLE) AS profit
      FROM fact_sales fs JOIN dim_month dm ON fs.month_id = dm.month_id
      JOIN dim_product dp ON fs.product_id = dp.product_id
      WHERE dm.month_name = '1998-07'""",
    "olap_dice": f"""SELECT dd.full_date, dm.month_name, CAST(f.quantity AS DOUBLE) AS quantity,
      CAST(f.revenue AS DOUBLE) AS revenue FROM {FACT_JOIN_ALL}
      WHERE dp.product_name = 'red plate' AND dp.package_size = '500g'
        AND dm.month_name IN ({", ".join(f"'1998-{m:02d}'" for m in range(1, 13))})""",
    "top_records": """SELECT fs.sales_id, dd.full_date AS date, dm.month_name AS month,
      dp.product_name, dp.package_size, CAST(fs.quantity AS DOUBLE) AS quantity,
      CAST(fs.revenue AS DOUBLE) AS revenue, CAST(fs.profit AS DOUBLE) AS profit,
      CAST(ROUND(fs.profit_margin * 100, 2) AS DOUBLE) AS margin_pct
      FROM fact_sales fs JOIN dim_date dd ON fs.date_id = dd.date_id
      JOIN dim_product dp ON fs.product_id = dp.product_id
      JOIN dim_month dm ON fs.month_id = dm.month_id
      ORDER BY fs.revenue DESC, fs.sales_id LIMIT 50""",
    "lookup_date": "SELECT date, date_id FROM keyed",
    "lookup_product": "SELECT product_type, unit_size, product_id FROM keyed",
    "lookup_month": "SELECT month, month_id FROM keyed",
    "enrich_category": "SELECT DISTINCT product_name, category FROM dim_product",
    "rollup_month": f"""SELECT dm.month_name, {money("f.revenue", None)} AS total_revenue,
      {money("f.profit", None)} AS total_profit FROM facts f
      JOIN dim_month dm ON f.month_id = dm.month_id GROUP BY dm.month_name""",
    "rollup_product": f"""SELECT dp.product_name, {money("f.revenue", None)} AS total_revenue,
      {money("f.profit", None)} AS total_profit FROM facts f
      JOIN dim_product dp ON f.product_id = dp.product_id GROUP BY dp.product_name""",
    "daily_trend": f"""SELECT dd.full_date AS date, dd.month_name,
      {money("f.revenue", None)} AS revenue, {money("f.profit", None)} AS profit,
      {money("f.quantity", None)} AS quantity FROM facts f
      JOIN dim_date dd ON f.date_id = dd.date_id GROUP BY dd.full_date, dd.month_name""",
    "star_join": f"{STAR_JOIN} FROM {FACT_JOIN_ALL}",
    "summary_monthly": "SELECT * FROM summary_monthly",
    "summary_product": "SELECT * FROM summary_product",
    "stream_summary_monthly": "SELECT * FROM summary_monthly",
    "kpis": f"""SELECT {money("revenue", None)} AS total_revenue,
      {money("profit", None)} AS total_profit, {money("quantity", None)} AS total_quantity,
      {margin_pct("profit_margin", None)} AS avg_margin_pct, COUNT(*) AS total_transactions
      FROM facts""",
    "cube_full": _cube_slice(["month_name", "product_name", "package_size"]),
    "cube_month_product": _cube_slice(["month_name", "product_name"]),
    "cube_month_size": _cube_slice(["month_name", "package_size"]),
    "cube_product_size": _cube_slice(["product_name", "package_size"]),
    "cube_month": _cube_slice(["month_name"]),
    "cube_product": _cube_slice(["product_name"]),
    "cube_size": _cube_slice(["package_size"]),
    "cube_grand_total": _cube_slice([]),
    "cube": CUBE_ALL,
    "revenue_by_month": f"""SELECT dm.month_name, {money("f.revenue")} AS revenue,
      {money("f.profit")} AS profit FROM facts f JOIN dim_month dm ON f.month_id = dm.month_id
      GROUP BY dm.month_id, dm.month_name""",
    "products_by_revenue": _by_product(f'{money("f.revenue")} AS total_rev'),
    "daily_sales_20": f"""SELECT dd.full_date, {money("f.revenue")} AS rev,
      {units("f.quantity")} AS units FROM facts f JOIN dim_date dd ON f.date_id = dd.date_id
      GROUP BY dd.full_date ORDER BY dd.full_date LIMIT 20""",
    "margin_by_size": f"""SELECT dp.package_size, {margin_pct("f.profit_margin")} AS avg_margin_pct
      FROM facts f JOIN dim_product dp ON f.product_id = dp.product_id GROUP BY dp.package_size""",
    "margin_by_month": f"""SELECT dm.month_name, {margin_pct("f.profit_margin")} AS avg_margin_pct,
      COUNT(*) AS transactions FROM facts f JOIN dim_month dm ON f.month_id = dm.month_id
      GROUP BY dm.month_name""",
    "category_size": f"""SELECT dp.category, dp.package_size, {money("f.revenue")} AS revenue,
      {units("f.quantity")} AS units FROM facts f
      JOIN dim_product dp ON f.product_id = dp.product_id
      GROUP BY dp.category, dp.package_size""",
    "best_days": f"""SELECT dm.month_name, dd.full_date, {money("f.revenue")} AS daily_rev
      FROM facts f JOIN dim_date dd ON f.date_id = dd.date_id
      JOIN dim_month dm ON f.month_id = dm.month_id
      GROUP BY dm.month_name, dd.full_date
      ORDER BY daily_rev DESC, dd.full_date, dm.month_name LIMIT 10""",
    "profit_share": f"""SELECT dp.product_name, {money("f.profit")} AS total_profit,
      {share("SUM(f.profit)", "(SELECT SUM(profit) FROM facts)")} AS profit_share_pct
      FROM facts f JOIN dim_product dp ON f.product_id = dp.product_id
      GROUP BY dp.product_name""",
    "revenue_by_product": _by_product(
        f'{money("f.revenue", None)} AS revenue, {money("f.profit", None)} AS profit'),
    "revenue_by_size": f"""SELECT dp.package_size, {money("f.revenue", None)} AS revenue
      FROM facts f JOIN dim_product dp ON f.product_id = dp.product_id GROUP BY dp.package_size""",
    "category_totals": """SELECT coalesce(nullif(category, ''), 'Other') AS category,
      CAST(SUM(r) AS DOUBLE) AS revenue FROM (SELECT dp.category, dp.package_size,
      ROUND(SUM(f.revenue), 2) AS r FROM facts f JOIN dim_product dp
      ON f.product_id = dp.product_id GROUP BY dp.category, dp.package_size)
      GROUP BY coalesce(nullif(category, ''), 'Other')""",
    "size_totals": """SELECT coalesce(nullif(package_size, ''), 'Other') AS package_size,
      CAST(SUM(r) AS DOUBLE) AS revenue FROM (SELECT dp.category, dp.package_size,
      ROUND(SUM(f.revenue), 2) AS r FROM facts f JOIN dim_product dp
      ON f.product_id = dp.product_id GROUP BY dp.category, dp.package_size)
      GROUP BY coalesce(nullif(package_size, ''), 'Other')""",
    "olap_drill_down": f"""SELECT dd.month_name, dd.full_date,
      {money("f.revenue", None)} AS daily_revenue, {money("f.quantity", None)} AS units
      FROM facts f JOIN dim_date dd ON f.date_id = dd.date_id
      GROUP BY dd.month_name, dd.full_date""",
    "olap_pivot": "SELECT dp.product_name, " + ", ".join(
        f"""{ratio(f"SUM(CASE WHEN dd.month_name = '{m}' THEN {bp('f.profit_margin')} END)",
                   f"COUNT(CASE WHEN dd.month_name = '{m}' THEN {bp('f.profit_margin')} END) * 100",
                   2)} AS {m.lower()}_margin""" for m in MONTHS)
        + """ FROM facts f JOIN dim_date dd ON f.date_id = dd.date_id
      JOIN dim_product dp ON f.product_id = dp.product_id GROUP BY dp.product_name""",
    "revenue_share": f"""SELECT dp.product_name, {money("f.revenue")} AS revenue,
      {share("SUM(f.revenue)", "(SELECT SUM(revenue) FROM facts)")} AS revenue_share_pct
      FROM facts f JOIN dim_product dp ON f.product_id = dp.product_id
      GROUP BY dp.product_name""",
    "dim_date": "SELECT * FROM dim_date",
    "dim_product": "SELECT * FROM dim_product",
    "dim_month": "SELECT * FROM dim_month",
    "fact_sales": "SELECT * FROM fact_sales",
    "star_build": "SELECT * FROM fact_sales",
    "preview": _by_product(f'{money("f.revenue")} AS total_rev')
               + " ORDER BY total_rev DESC, dp.product_name LIMIT 4",
    "top_products_6": _by_product(f'{money("f.revenue")} AS total_rev')
                      + " ORDER BY total_rev DESC, dp.product_name LIMIT 6",
    "union_monthly": "SELECT * FROM monthly_named",
    "f_clean_text": f"""SELECT "Product Type" AS product_raw, {clean('"Product Type"')} AS product_clean,
      "Month " AS month_raw, trim("Month ", {WS}) AS month_stripped,
      {clean('"Month "')} AS month_clean, "Unit Size" AS size_raw,
      {clean('"Unit Size"')} AS size_clean FROM raw_master""",
    "f_calendar": """SELECT full_date, day, month_num, month_name, quarter, year, week_of_year,
      strftime(full_date, '%Y-%m-%d') AS date_text FROM dim_date""",
    "f_lenient_parse": """SELECT quantity AS quantity_text,
      CAST(TRY_CAST(quantity AS DECIMAL(38,10)) AS DOUBLE) AS quantity_value,
      profit_margin AS margin_text,
      CAST(TRY_CAST(profit_margin AS DECIMAL(38,10)) AS DOUBLE) AS margin_value
      FROM normalized""",
    "clean_transactions": "SELECT * FROM master",
    "clean_catalogue": "SELECT * EXCLUDE (_row) FROM catalogue",
    "check_not_null": """SELECT * FROM (VALUES
      ('dim_date', 'full_date', (SELECT COUNT(*) FROM dim_date WHERE full_date IS NULL)),
      ('dim_product', 'product_name', (SELECT COUNT(*) FROM dim_product WHERE product_name IS NULL)),
      ('dim_month', 'month_name', (SELECT COUNT(*) FROM dim_month WHERE month_name IS NULL)))
      t(table_name, column_name, null_rows)""",
    "check_month": """SELECT COUNT(*) FILTER (WHERE f.month_id IS NULL) AS unmapped_month,
      COUNT(*) FILTER (WHERE f.month_id IS NOT NULL AND dd.year = dm.year
                       AND dd.month_num = month(CAST(dm.month_name || '-01' AS DATE))) AS agree,
      COUNT(*) FILTER (WHERE f.month_id IS NOT NULL AND NOT (dd.year = dm.year
                       AND dd.month_num = month(CAST(dm.month_name || '-01' AS DATE)))) AS disagree,
      CAST(0 AS BIGINT) AS unnumbered_month
      FROM facts f JOIN dim_date dd ON f.date_id = dd.date_id
      LEFT JOIN dim_month dm ON f.month_id = dm.month_id""",
    "reconcile": f"""SELECT 'fact' AS source, {money("revenue")} AS revenue, {money("profit")} AS profit,
        {money("quantity", None)} AS quantity, COUNT(*) AS transactions FROM facts
      UNION ALL SELECT 'fact_with_month', {money("f.revenue")}, {money("f.profit")},
        {money("f.quantity", None)}, COUNT(*) FROM facts f JOIN dim_month dm ON f.month_id = dm.month_id
      UNION ALL SELECT 'summary_monthly', {money("CAST(total_revenue AS DECIMAL(38,2))")},
        {money("CAST(total_profit AS DECIMAL(38,2))")},
        {money("CAST(total_quantity AS DECIMAL(38,6))", None)},
        CAST(SUM(num_transactions) AS BIGINT) FROM summary_monthly
      UNION ALL SELECT 'summary_product', {money("CAST(total_revenue AS DECIMAL(38,2))")},
        {money("CAST(total_profit AS DECIMAL(38,2))")},
        {money("CAST(total_quantity AS DECIMAL(38,6))", None)},
        CAST(SUM(num_transactions) AS BIGINT) FROM summary_product""",
}


def _grouping(d: str) -> str:
    head = f"substr({d}, 1, length({d}) - 3)"
    paired = f"ltrim(reverse(regexp_replace(reverse({head}), '([0-9]{{2}})', '\\1,', 'g')), ',')"
    return (f"(CASE WHEN length({d}) > 3 THEN {paired} || ',' || substr({d}, length({d}) - 2, 3) "
            f"ELSE {d} END)")


def currency(x: str) -> str:
    v = f"ROUND(CAST({x} AS DECIMAL(38,10)), 2)"
    cents = f"CAST(abs({v}) * 100 AS HUGEINT)"
    whole = f"CAST({cents} // 100 AS VARCHAR)"
    frac = f"regexp_replace(lpad(CAST({cents} % 100 AS VARCHAR), 2, '0'), '0+$', '')"
    body = f"{_grouping(whole)} || CASE WHEN {frac} <> '' THEN '.' || {frac} ELSE '' END"
    return (f"(CASE WHEN {v} IS NOT NULL THEN (CASE WHEN {v} < 0 THEN '-' ELSE '' END) "
            f"|| '\u20b9' || {body} END)")


def _tag(col: str) -> str:
    t = f"replace(replace({col}, '_month_sales', ''), '_', ' ')"
    return f"(upper(substr({t}, 1, 1)) || lower(substr({t}, 2)))"


def _count(body: str) -> str:
    return f"(SELECT COUNT(*) FROM ({body}))"


def _esc(text: str) -> str:
    return text.replace("'", "''")


def _top(metric: str, body: str, member: str, value: str) -> str:
    return (f"(SELECT '{metric}' AS metric, {member} AS member, CAST({value} AS DOUBLE) AS value "
            f"FROM ({body}) ORDER BY {value} DESC NULLS LAST, {member} LIMIT 1)")


def _pk(table: str, key: str) -> str:
    return (f"('{table}', '{key}', (SELECT COUNT(*) FROM {table}), "
            f"(SELECT COUNT(*) FROM {table} WHERE {key} IS NULL), "
            f"(SELECT COUNT(*) FROM (SELECT {key} FROM {table} WHERE {key} IS NOT NULL "
            f"GROUP BY {key} HAVING COUNT(*) > 1)))")


def _fk(child: str, col: str, parent: str, key: str) -> str:
    return (f"('{child}', '{col}', '{parent}', (SELECT COUNT(*) FROM {child} c "
            f"WHERE c.{col} IS NOT NULL AND NOT EXISTS "
            f"(SELECT 1 FROM {parent} p WHERE p.{key} = c.{col})))")


MONEY_COLUMNS = ["quantity", "revenue", "profit", "profit_margin"]


def _edge(body: str) -> str:
    """Decimal money columns as doubles, as the Spark queries return them."""
    casts = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in MONEY_COLUMNS)
    return f"SELECT * REPLACE ({casts}) FROM ({body})"



# A star grown from three batches: members are numbered by the batch that brought them.
_BATCH = ("CASE WHEN regexp_matches({0}, '^[0-9]{{4}}-') AND {0} < '1997' THEN 1 "
          "WHEN regexp_matches({0}, '^[0-9]{{4}}-') AND {0} < '1999' THEN 2 ELSE 3 END")
GROWN = f""",
g_master AS (
  SELECT *, CASE WHEN date < DATE '1997-01-01' THEN 1 WHEN date < DATE '1999-01-01' THEN 2 ELSE 3 END AS b FROM master
),
g_date AS (
  SELECT row_number() OVER (ORDER BY n.b, d.full_date) AS date_id, d.* EXCLUDE (date_id), n.b
  FROM dim_date d JOIN (SELECT date, min(b) AS b FROM g_master GROUP BY date) n ON n.date = d.full_date
),
g_product AS (
  SELECT row_number() OVER (ORDER BY n.b, d.product_name NULLS LAST, d.package_size NULLS LAST) AS product_id,
         d.* EXCLUDE (product_id), n.b
  FROM dim_product d JOIN (SELECT product_type, unit_size, min(b) AS b FROM g_master GROUP BY ALL) n
    ON n.product_type = d.product_name AND n.unit_size IS NOT DISTINCT FROM d.package_size
),
g_month AS (
  SELECT row_number() OVER (ORDER BY n.b, d.month_name) AS month_id, d.* EXCLUDE (month_id), n.b
  FROM dim_month d JOIN (SELECT strftime(date, '%Y-%m') AS name, min(b) AS b FROM g_master
                         WHERE date IS NOT NULL GROUP BY ALL) n ON n.name = d.month_name
),
g_rows AS (
  SELECT m.b, d.date_id, p.product_id, mo.month_id,
         CAST(m.quantity AS DECIMAL(18,6)) AS quantity, CAST(ROUND(m.revenue, 2) AS DECIMAL(18,2)) AS revenue,
         CAST(ROUND(m.profit, 2) AS DECIMAL(18,2)) AS profit,
         CAST(ROUND(m.profit_margin, 4) AS DECIMAL(18,4)) AS profit_margin
  FROM g_master m
  LEFT JOIN g_date d ON m.date = d.full_date
  LEFT JOIN g_product p ON m.product_type = p.product_name AND m.unit_size IS NOT DISTINCT FROM p.package_size
  LEFT JOIN g_month mo ON m.month = mo.month_key AND mo.b <= m.b
),
g_fact AS (
  SELECT row_number() OVER (ORDER BY b, date_id NULLS FIRST, product_id NULLS FIRST, month_id NULLS FIRST,
           quantity NULLS FIRST, revenue NULLS FIRST, profit NULLS FIRST, profit_margin NULLS FIRST) AS sales_id,
         * EXCLUDE (b)
  FROM g_rows
)
"""
_SUMMARY = f"""{money("f.revenue")} AS total_revenue, {money("f.profit")} AS total_profit,
  {money("f.quantity", None)} AS total_quantity, {mean_frac("f.profit_margin")} AS avg_margin,
  COUNT(*) AS num_transactions"""


def _reason(reason: str) -> str:
    """Why a normalised raw row is dropped, as a condition."""
    present = "date IS NOT NULL AND product_type IS NOT NULL"
    if reason == "corrupt_record":
        return "false"
    if reason.startswith("no_"):
        return f"{'date' if reason == 'no_date' else 'product_type'} IS NULL"
    return f"({present} AND TRY_CAST({reason[4:]} AS DECIMAL(38,10)) IS NULL)"


def _grown() -> dict[str, str]:
    """Queries of the growing star and of the rejected rows."""
    any_reason = " OR ".join(_reason(r) for r in REJECTIONS)
    named = ", ".join(f"CASE WHEN {_reason(r)} THEN '{r}' END" for r in REJECTIONS)
    counts = ", ".join(f"CAST(count(*) FILTER (WHERE {_reason(r)}) AS BIGINT) AS {{0}}{r}" for r in REJECTIONS)
    month = "g_rows f JOIN g_month dm ON f.month_id = dm.month_id"
    product = "g_product dp ON f.product_id = dp.product_id"
    quarter = f"SELECT dm.year, dm.quarter, {_SUMMARY} FROM {month} GROUP BY dm.year, dm.quarter"
    dims = " UNION ALL ".join(
        f"SELECT 'dim_{d}' AS dimension, CAST(count(*) AS BIGINT) AS members, CAST(min({d}_id) AS BIGINT) AS first_key, "
        f"CAST(max({d}_id) AS BIGINT) AS last_key, CAST(0 AS BIGINT) AS dangling FROM g_{d}" for d in ("date", "product", "month"))
    return {
        "grown_dim_date": GROWN + "SELECT * EXCLUDE (b) FROM g_date",
        "grown_dim_product": GROWN + "SELECT * EXCLUDE (b) FROM g_product",
        "grown_dim_month": GROWN + "SELECT * EXCLUDE (b) FROM g_month",
        "grown_fact_sales": GROWN + """SELECT sales_id, date_id, product_id, month_id, CAST(quantity AS DOUBLE) AS quantity,
          CAST(revenue AS DOUBLE) AS revenue, CAST(profit AS DOUBLE) AS profit, CAST(profit_margin AS DOUBLE) AS profit_margin
          FROM g_fact""",
        "summary_monthly_merged": GROWN + f"""SELECT dm.month_id, dm.month_name, dm.year, {_SUMMARY} FROM {month}
          GROUP BY dm.month_id, dm.month_name, dm.year""",
        "summary_product_merged": GROWN + f"""SELECT dp.product_id, dp.product_name, dp.package_size, dp.category, {_SUMMARY}
          FROM g_rows f JOIN {product} WHERE dp.package_size IS NOT NULL AND dp.category IS NOT NULL
          GROUP BY dp.product_id, dp.product_name, dp.package_size, dp.category""",
        "summary_quarter_merged": GROWN + quarter,
        "summary_month_size_merged": GROWN + f"""SELECT dm.month_name, dp.package_size, {_SUMMARY} FROM {month} JOIN {product}
          GROUP BY dm.month_name, dp.package_size""",
        "grown_dangling_keys": GROWN + dims,
        "load_counts": GROWN + f"""SELECT ['first', 'second', 'third'][r.b] AS batch, r.* EXCLUDE (b), c.clean_rows,
          c.clean_rows AS facts, c.no_date, c.no_month
          FROM (SELECT {_BATCH.format("date")} AS b, CAST(count(*) AS BIGINT) AS raw_rows, {counts.format("rejected_")}
                FROM normalized GROUP BY 1) r
          JOIN (SELECT b, CAST(count(*) AS BIGINT) AS clean_rows, CAST(count(*) FILTER (WHERE date_id IS NULL) AS BIGINT) AS no_date,
                       CAST(count(*) FILTER (WHERE month_id IS NULL) AS BIGINT) AS no_month FROM g_rows GROUP BY b) c ON c.b = r.b""",
        "quarantine": f"SELECT *, concat_ws(',', {named}) AS reasons FROM normalized WHERE {any_reason}",
        "rejected_counts": f"""SELECT CAST(count(*) AS BIGINT) AS raw_rows,
          CAST(count(*) FILTER (WHERE NOT ({any_reason})) AS BIGINT) AS kept_rows, {counts.format("")} FROM normalized""",
        "stream_summary_grown": "SELECT * EXCLUDE (month_id) FROM summary_monthly",
    }


def oracle_sql() -> dict[str, str]:
    from ..sinks.writers import STAR_TABLES
    from .bundle import CUBE_DIMENSION_LABELS, CUBE_MEASURE_NAMES, QUERY_TEXTS
    q = dict(QUERIES)
    q["scan_star"] = (f"{STAR_JOIN}, f.sales_id FROM fact_sales f "
                      "JOIN dim_date dd ON f.date_id = dd.date_id "
                      "JOIN dim_product dp ON f.product_id = dp.product_id "
                      "JOIN dim_month dm ON f.month_id = dm.month_id")
    q["tag_source"] = (f"SELECT sheet, {_tag('sheet')} AS month_source, COUNT(*) AS rows "
                       "FROM raw_monthly GROUP BY sheet")
    q["clean_monthly"] = (f"SELECT * REPLACE ({clean('product_type')} AS product_type), "
                          f"{_tag('sheet')} AS month_source FROM monthly_dated "
                          "WHERE date IS NOT NULL AND product_type IS NOT NULL "
                          "AND revenue IS NOT NULL")
    stages = ["raw_master", "master", "catalogue", "dim_date", "dim_product", "dim_month",
              "fact_sales", "summary_monthly", "summary_product"]
    names = ["raw_master", "master_clean", "catalogue_clean", "dim_date", "dim_product",
             "dim_month", "fact_sales", "summary_monthly", "summary_product"]
    q.update(_grown())
    q["audit_counts"] = ("SELECT * FROM (VALUES " + ", ".join(
        f"({i}, '{n}', (SELECT COUNT(*) FROM {t}))"
        for i, (n, t) in enumerate(zip(names, stages), start=1)) + ") t(step, stage, rows)")
    q["query_catalogue"] = ("SELECT * FROM (VALUES " + ", ".join(
        f"('{qid}', '{_esc(title)}', '{_esc(desc)}', {_count(QUERIES[qid])})"
        for qid, title, desc in QUERY_TEXTS) + ") t(query_id, title, description, rows)")
    q["cube_metadata"] = (
        f"SELECT 'sales cube' AS cube_name, '{', '.join(CUBE_DIMENSION_LABELS)}' AS dimensions, "
        f"'{', '.join(CUBE_MEASURE_NAMES)}' AS measures, "
        "(SELECT arg_min(month_name, month_id) || ' - ' || arg_max(month_name, month_id) "
        "FROM dim_month) AS period, "
        "(SELECT COUNT(*) FROM (SELECT DISTINCT month_name, product_name, package_size "
        "FROM cube_joined)) AS total_cells")
    q["best_members"] = " UNION ALL ".join([
        _top("best_month_by_revenue", QUERIES["revenue_by_month"], "month_name", "revenue"),
        _top("best_month_by_margin", QUERIES["margin_by_month"], "month_name", "avg_margin_pct"),
        _top("top_product_by_revenue", QUERIES["products_by_revenue"], "product_name", "total_rev"),
        _top("top_product_by_profit", QUERIES["profit_share"], "product_name", "total_profit")])
    q["f_currency"] = (f"SELECT product_name, revenue, {currency('revenue')} AS revenue_text "
                       f"FROM ({QUERIES['revenue_by_product']})")
    q["f_percent"] = ("SELECT package_size, avg_margin_pct, "
                      "printf('%.2f%%', avg_margin_pct) AS margin_text "
                      f"FROM ({QUERIES['margin_by_size']})")
    q["check_pk"] = ("SELECT * FROM (VALUES " + ", ".join([
        _pk("dim_date", "date_id"), _pk("dim_product", "product_id"),
        _pk("dim_month", "month_id"), _pk("fact_sales", "sales_id")])
        + ") t(table_name, key_column, rows, null_keys, duplicate_keys)")
    q["check_fk"] = ("SELECT * FROM (VALUES " + ", ".join([
        _fk("fact_sales", "date_id", "dim_date", "date_id"),
        _fk("fact_sales", "product_id", "dim_product", "product_id"),
        _fk("fact_sales", "month_id", "dim_month", "month_id"),
        _fk("summary_monthly", "month_id", "dim_month", "month_id"),
        _fk("summary_product", "product_id", "dim_product", "product_id")])
        + ") t(child_table, column_name, parent_table, orphan_rows)")
    q["list_sources"] = "SELECT DISTINCT sheet AS source FROM raw_monthly"
    q["stored_summary_monthly"] = "SELECT * FROM summary_monthly"
    q["stored_summary_product"] = "SELECT * FROM summary_product"
    for t in ("dim_product", "dim_month", "fact_sales", "summary_monthly"):
        q[f"export_{t}"] = f"SELECT * FROM {t}"
    for qid, _, _ in QUERY_TEXTS:
        q[f"query_export_{qid}"] = q[f"shared_{qid}"] = q[f"document_{qid}"] = QUERIES[qid]
    q["cube_export_back"] = q["cube"]
    q["titled_catalogue"], q["titled_monthly"] = q["clean_catalogue"], q["scan_monthly"]
    columns = "Date,Product,Size (g),Boxes Sold,Pieces per Box,Price per Piece,Revenue,Cost per Piece,Total Cost,Profit,Margin %"
    q["titled_headers"] = f"""SELECT sheet, CAST(2 AS BIGINT) AS files, CASE sheet
      WHEN 'june_month_sales' THEN replace('{columns}', 'Date,Product,', 'Sale Date,Item,')
      WHEN 'november_month_sales' THEN replace('{columns}', 'Date,Product,', 'Day,Product,') ELSE '{columns}' END AS header,
      COUNT(*) AS rows FROM raw_monthly GROUP BY sheet"""
    q["scan_summary_sheet"] = "SELECT * FROM summary_monthly"
    q["scan_first_existing"] = q["scan_transactions"]
    q["zorder_dice"] = q["olap_dice"]
    q["zorder_size_rollup"] = f"""SELECT dm.month_name, {money("f.revenue", None)} AS total_revenue,
      {money("f.profit", None)} AS total_profit FROM facts f JOIN dim_product dp ON f.product_id = dp.product_id
      JOIN dim_month dm ON f.month_id = dm.month_id WHERE dp.package_size IN ('500g', '1kg') GROUP BY dm.month_name"""
    q["bucketed_rollup_product"], q["bucketed_star_join"] = q["rollup_product"], q["star_join"]
    for name in ("full", "month_product", "month_size", "product_size", "month", "product", "size", "grand_total"):
        q[f"lattice_{name}"] = q[f"cube_{name}"]
    with_category = "(SELECT c.*, dp.category FROM cube_joined c JOIN dim_product dp ON c.product_id = dp.product_id)"
    q["lattice_category_size"] = (f"SELECT 'All' AS month_name, 'All' AS product_name, package_size, category, {CUBE_MEASURES} "
                                  f"FROM {with_category} GROUP BY category, package_size")
    q["lattice_dice"] = (f"SELECT 'All' AS month_name, product_name, 'All' AS package_size, {CUBE_MEASURES} FROM cube_joined "
                         "WHERE month_name LIKE '1998-%' AND package_size IN ('500g', '1kg') GROUP BY product_name")
    dashboard = {**{t: f"SELECT * FROM {t}" for t in STAR_TABLES}, "kpis": QUERIES["kpis"],
                 "product_revenue": QUERIES["revenue_by_product"],
                 "size_revenue": QUERIES["revenue_by_size"], "daily_trend": QUERIES["daily_trend"],
                 "top_records": q["top_records"]}
    q["export_dashboard"] = ("SELECT * FROM (VALUES " + ", ".join(
        f"('{name}', {_count(body)})" for name, body in dashboard.items()) + ") t(dataset, rows)")
    for name in ("fact_sales", "star_build", "scan_star", "star_join", "bucketed_star_join", "clean_transactions",
                 "export_fact_sales"):
        q[name] = _edge(q[name])
    out = {name: _q(body) for name, body in q.items()}
    for name in ("cube_metadata", "kpis", "summary_monthly"):
        out[f"{name}_named"] = NAMED_PREFIX + q[name]
    out["check_month_named"] = NAMED_PREFIX + q["check_month"].replace(
        "month(CAST(dm.month_name || '-01' AS DATE))",
        "(CASE dm.month_name WHEN 'June' THEN 6 WHEN 'July' THEN 7 ELSE 8 END)")
    return out
