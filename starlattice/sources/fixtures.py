"""Map the TPC-H-ish test tables onto the three raw sheets the ETL reads.

* raw transactions (the master sheet): lineitem joined to orders and part,
  one line per sale, every value as text, with messy headers and dirt;
* raw catalogue: part, seven columns taken by position;
* raw monthly sheets: the same sales lines in the eleven-column layout of
  the monthly sheets, one sheet per calendar month.

The dirt is deterministic, so DuckDB can rebuild every value from the
same tables: text padded and upper-cased, every 7th order's quantity
'x', every 13th order's date missing, every 17th order's size missing,
every 19th order's month 'Unknown', every 23rd order's margin empty,
every 29th order's quantity with six decimals, every 37th order's date
blank, every 41st order's size blank; in the monthly sheets every 11th
order's date is a repeated header text, and the sheets of June and
November have other headers.

Money is exact: revenue = extended price x (1 - discount) in decimals,
profit = unrounded revenue - quantity x retail price, margin = profit /
revenue rounded half away from zero to 4 places with integer arithmetic.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numbers import half_away_quotient
from ..session import discard, job_label, scratch_path, settings

# The five package sizes and the p_size bounds mapped onto them.
SIZE_BUCKETS = [(10, "100g"), (20, "200g"), (30, "500g"), (40, "1kg")]
LARGEST_SIZE = "5kg"

# Raw master headers (normalised and renamed by the cleaner).
RAW_MASTER_HEADERS = [" Date", "Month ", "Product Type", "Unit Size", "Quantity",
                      "Revenue_", "Profit_", "Profit Margin"]
# Raw catalogue headers (replaced by position by the cleaner).
RAW_CATALOGUE_HEADERS = ["Product", "Size", "Pieces", "Price per Piece",
                         "Price per Box", "Shelf Life", "Category"]
# Header texts repeated inside the monthly sheets' date column.
HEADER_DATE_TEXTS = ["date", "date ", "Date"]

LINEAGE = "_src"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def size_bucket(p_size: Column) -> Column:
    expr = F.when(p_size.isNull(), F.lit(None).cast("string"))
    for bound, label in SIZE_BUCKETS:
        expr = expr.when(p_size <= bound, F.lit(label))
    return expr.otherwise(F.lit(LARGEST_SIZE))


def sales_lines(spark: SparkSession, sf_dir: str, partitions: int | None = None,
                per_order: Sequence[Column] = (), share: tuple[int, int] | None = None) -> DataFrame:
    """lineitem x orders x part with the exact money columns (no dirt yet).

    ``share`` (i, n) takes the i-th of n shares of the orders, with all their lines.

    ``partitions`` deals the lines anew first: a table of one file that cannot be
    split would otherwise be one task.

    Money is computed in exact 64-bit integers of 1/10000: extended price
    in cents times (100 - discount in percent), minus quantity times
    retail price in cents times 100. The values equal the decimal formulas
    (price x (1 - discount), revenue - quantity x price) exactly.

    What an order or a part alone decides (the texts of its day, its name and
    its size) is computed before the joins: once per order or part instead of
    once per line, and outside the lines' generated code. That code must stay
    below 8000 bytes a method, above which the JVM interprets it (3 times slower), also
    where the joins are too large to broadcast. ``per_order``
    are further such columns over ``l_orderkey`` and ``day``.
    """
    li = _table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount",
        F.xxhash64("_metadata.file_path", "_metadata.row_index").alias(LINEAGE))
    orders = _table(spark, sf_dir, "orders")
    if share:
        mine = lambda key: F.pmod(F.xxhash64(F.col(key).cast("long")), F.lit(share[1])) == share[0]
        li, orders = li.where(mine("l_orderkey")), orders.where(mine("o_orderkey"))
    if partitions:
        li = li.repartition(partitions)
    orders = orders.select(
        F.col("o_orderkey").alias("l_orderkey"), "o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"),
        F.concat(F.lower(F.date_format("o_orderdate", "MMMM")), F.lit("_month_sales")).alias("sheet"))
    orders = orders.select("*", *per_order)
    size = size_bucket(F.col("p_size"))
    part = _table(spark, sf_dir, "part").select(
        "p_partkey", "p_name", "p_type", "p_size", "p_retailprice", F.upper("p_name").alias("upper_name"),
        size.alias("size"), F.upper(size).alias("upper_size"))
    lines = li.join(part, li.l_partkey == part.p_partkey)
    qty = F.col("l_quantity").cast("decimal(12,0)")
    price = F.col("p_retailprice").cast("decimal(12,2)")
    cents = lambda c: (c * F.lit(100)).cast("long")
    kept = ["l_orderkey", "l_linenumber", "p_name", "p_type", "p_size", "upper_name", "size", "upper_size", LINEAGE]
    base = lines.select(
        *kept, qty.alias("qty"), price.alias("price"),
        (cents(F.col("l_extendedprice").cast("decimal(18,2)"))
         * (F.lit(100) - cents(F.col("l_discount").cast("decimal(4,2)")))).alias("rev4"),
        (qty.cast("long") * cents(price) * F.lit(100)).alias("cost4"))
    staged = base.withColumn("prof4", F.col("rev4") - F.col("cost4"))
    def to_money(c: Column) -> Column:
        """1/10000 to whole cents, half away from zero, as decimal(18,2)."""
        whole = F.signum(c).cast("long") * F.call_function("div", F.abs(c) + F.lit(50), F.lit(100).cast("long"))
        return (whole.cast("decimal(18,0)") * F.lit("0.01").cast("decimal(2,2)")).cast("decimal(18,2)")

    money = staged.select(
        *kept, "qty", "price",
        to_money(F.col("rev4")).alias("revenue"),
        to_money(F.col("prof4")).alias("profit"),
        (F.col("qty") * F.col("price")).cast("decimal(18,2)").alias("cost"),
        half_away_quotient(F.col("prof4"), F.col("rev4"), 4).cast("decimal(18,0)").alias("margin_bp"),
    )
    # the orders come after the money: where this join shuffles, texts and money are code of different stages
    return money.join(orders, "l_orderkey")


def _every(n: int) -> Column:
    return F.col("l_orderkey") % n == 0


def raw_transactions(spark: SparkSession, sf_dir: str, partitions: int | None = None) -> DataFrame:
    """The master sheet as text, with messy headers and deterministic dirt."""
    day = F.col("day")
    dates = F.when(_every(13), F.lit(None).cast("string")).when(_every(37), F.lit("   ")).otherwise(day)
    months = (F.when(_every(19), F.lit(" Unknown "))
              .otherwise(F.concat(F.lit(" "), F.substring(day, 1, 7), F.lit("  "))))
    s = sales_lines(spark, sf_dir, partitions, [dates.alias("date_text"), months.alias("month_text")])
    margin = (F.col("margin_bp").cast("decimal(18,0)")
              * F.lit("0.0001").cast("decimal(5,4)")).cast("decimal(12,4)")
    h = RAW_MASTER_HEADERS
    return s.select(
        F.col("date_text").alias(h[0]), F.col("month_text").alias(h[1]),
        F.concat(F.lit("  "), F.col("upper_name"), F.lit("\t")).alias(h[2]),
        F.when(_every(17), F.lit(None).cast("string")).when(_every(41), F.lit("   "))
         .otherwise(F.concat(F.lit(" "), F.col("upper_size"), F.lit(" "))).alias(h[3]),
        F.when(_every(7), F.lit("x"))
         .when(_every(29), F.concat(F.col("qty").cast("string"), F.lit(".000004")))
         .otherwise(F.col("qty").cast("string")).alias(h[4]),
        F.col("revenue").cast("string").alias(h[5]),
        F.col("profit").cast("string").alias(h[6]),
        F.when(_every(23), F.lit("")).otherwise(margin.cast("string")).alias(h[7]),
        F.col(LINEAGE),
    )


def raw_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part as the product catalogue: seven text columns plus the row order."""
    p = _table(spark, sf_dir, "part")
    price = F.col("p_retailprice").cast("decimal(12,2)")
    h = RAW_CATALOGUE_HEADERS
    return p.select(
        F.when(F.col("p_partkey") % 29 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit(" "), F.upper("p_name"), F.lit(" "))).alias(h[0]),
        F.upper(size_bucket(F.col("p_size"))).alias(h[1]),
        F.col("p_size").cast("string").alias(h[2]),
        price.cast("string").alias(h[3]),
        (price * F.col("p_size")).cast("decimal(18,2)").cast("string").alias(h[4]),
        F.col("p_brand").alias(h[5]),
        F.when(F.col("p_partkey") % 3 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit(" "), F.col("p_type"), F.lit(" "))).alias(h[6]),
        F.col("p_partkey").alias("_row"),
    )


def raw_monthly(spark: SparkSession, sf_dir: str, partitions: int | None = None, share: tuple[int, int] | None = None) -> DataFrame:
    """The monthly sheets (eleven text columns) plus the sheet each row is on."""
    s = sales_lines(spark, sf_dir, partitions, (), share)
    header_text = (F.when(F.col("l_linenumber") % 3 == 0, F.lit(HEADER_DATE_TEXTS[0]))
                    .when(F.col("l_linenumber") % 3 == 1, F.lit(HEADER_DATE_TEXTS[1]))
                    .otherwise(F.lit(HEADER_DATE_TEXTS[2])))
    date_col = (F.when(_every(11), header_text)
                 .when(_every(13), F.lit(None).cast("string"))
                 .otherwise(F.col("day")))
    pct = (F.col("margin_bp").cast("decimal(18,0)") * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(14,2)")
    return s.select(
        date_col.alias("Date"),
        F.concat(F.lit(" "), F.col("upper_name")).alias("Product"),
        F.col("size").alias("Size (g)"),
        F.col("qty").cast("string").alias("Boxes Sold"),
        F.col("p_size").cast("string").alias("Pieces per Box"),
        F.col("price").cast("string").alias("Price per Piece"),
        F.when(_every(31), F.lit(None).cast("string"))
         .otherwise(F.col("revenue").cast("string")).alias("Revenue"),
        F.col("price").cast("string").alias("Cost per Piece"),
        F.col("cost").cast("string").alias("Total Cost"),
        F.col("profit").cast("string").alias("Profit"),
        pct.cast("string").alias("Margin %"),
        F.col("sheet"),
    )


def stage_transactions(spark: SparkSession, sf_dir: str) -> str:
    """Write the raw master sheet as Parquet files; return the folder.

    The real source of the ETL is a file of text columns; staging the
    fixture once makes every later pass a plain scan of that text instead
    of a re-run of the three-table join that produces it.
    """
    path = scratch_path(spark, "raw-transactions")
    with job_label(spark, "stage raw transactions"):
        cores = spark.sparkContext.defaultParallelism
        raw_transactions(spark, sf_dir, cores).drop(LINEAGE).write.mode("overwrite").parquet(path)
    return path


# The twelve sheets, and the two whose headers differ from the others'.
SHEETS = [f"{m}_month_sales" for m in (
    "january", "february", "march", "april", "may", "june", "july", "august", "september",
    "october", "november", "december")]
OTHER_HEADERS = {"june_month_sales": ["Sale Date", "Item"], "november_month_sales": ["Day"]}


def stage_monthly_sheets(spark: SparkSession, sf_dir: str) -> list[str]:
    """Write the monthly sheets as one folder per sheet; return the folders.

    Stands in for the workbook's separate sheets. The sheets of
    ``OTHER_HEADERS`` get other names for their first columns. The tables are
    joined once; only the sheets with other names are read back and written again.
    """
    at = scratch_path(spark, "monthly-sheets")
    rows = raw_monthly(spark, sf_dir, spark.sparkContext.defaultParallelism).where(F.col("sheet").isNotNull())
    other = F.when(F.col("sheet").isin(list(OTHER_HEADERS)), F.lit("other")).otherwise(F.lit("own"))
    rows = rows.withColumn("headers", other)
    with job_label(spark, "stage monthly sheets"):
        rows.write.mode("overwrite").partitionBy("headers", "sheet").parquet(at)
    root = f"{at}/headers=own"
    back = spark.read.schema(rows.schema).parquet(at).where(F.col("headers") == "other").drop("headers")
    for sheet, headers in OTHER_HEADERS.items():
        one = back.where(F.col("sheet") == sheet).drop("sheet")
        one.toDF(*headers, *one.columns[len(headers):]).write.parquet(f"{root}/sheet={sheet}")
    return [f"{root}/sheet={s}" for s in SHEETS]


# How many lines stand above the header line of the catalogue and of a monthly sheet.
CATALOGUE_TITLES, MONTHLY_TITLES = 1, 2
# lines of sales that are joined and dealt to their sheets at a time
LINES_AT_ONCE = 20_000_000
_CSV = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def _csv_lines(df: DataFrame, columns: list[str]) -> Column:
    return F.to_csv(F.struct(*[F.col(f"`{c}`") for c in columns]), _CSV)


def stage_titled_catalogue(spark: SparkSession, sf_dir: str, files: int = 3) -> str:
    """Write the catalogue as CSV files in row order, a title line and the header on top of each; return the folder."""
    path = scratch_path(spark, "titled-catalogue")
    rows = raw_catalogue(spark, sf_dir)
    header = ",".join(RAW_CATALOGUE_HEADERS)
    line = _csv_lines(rows, RAW_CATALOGUE_HEADERS)
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    ranged = rows.repartitionByRange(files, "_row").sortWithinPartitions("_row")
    ranged.select(F.when(first, F.concat(F.lit(f"Business overview\n{header}\n"), line)).otherwise(line).alias("value")).write.text(path)
    return path


def stage_titled_sheets(spark: SparkSession, sf_dir: str, files: int = 2, lines_at_once: int | None = None) -> str:
    """Write the monthly sheets as CSV, ``files`` files a sheet, each with a title, a blank line and the header; return the folder.

    A share of the orders at a time is joined and dealt to the sheets, about ``lines_at_once`` lines, and what it shuffled
    is removed when its lines are written. Then a task for each file reads its lines of all shares and writes them
    as one gzip file, without a shuffle or a sort; the lines between go. So the disk holds the lines twice,
    compressed, and one share's shuffles.
    """
    parts, path = scratch_path(spark, "titled-lines"), scratch_path(spark, "titled-sheets")
    shares = max(1, -(-_table(spark, sf_dir, "lineitem").count() // (lines_at_once or LINES_AT_ONCE)))
    columns: list[str] = []
    for i in range(shares):
        rows = raw_monthly(spark, sf_dir, spark.sparkContext.defaultParallelism, (i, shares) if shares > 1 else None)
        columns = [c for c in rows.columns if c != "sheet"]
        lines = rows.select("sheet", _csv_lines(rows, columns).alias("line")).withColumn(
            "part", F.pmod(F.xxhash64("line"), F.lit(files)).cast("int"))
        # a place for each file; rows without a day are on a sheet of their own
        place = F.coalesce(F.nullif(F.array_position(F.lit(SHEETS), F.col("sheet")), F.lit(0)), F.lit(len(SHEETS) + 1)) - 1
        with settings(spark, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true"), job_label(spark, "stage lines of titled sheets"):
            lines.repartitionById(files * (len(SHEETS) + 1), (place * files + F.col("part")).cast("int")).write.mode("append").option(
                "compression", "zstd").partitionBy("part", "sheet").parquet(parts)
    lines = spark.read.schema("line string, part int, sheet string").parquet(parts)

    def one(part: int, sheet: str | None) -> DataFrame:
        own = lines.where((F.col("part") == part) & F.col("sheet").eqNullSafe(F.lit(sheet))).select("line").coalesce(1)
        other = OTHER_HEADERS.get(sheet, [])
        top = f"Monthly sales\n\n{','.join([*other, *columns[len(other):]])}\n"
        return own.select(F.lit(top).alias("top"), "line", F.lit(part).alias("part"), F.lit(sheet).cast("string").alias("sheet"))

    found = [one(r["part"], r["sheet"]) for r in lines.select("part", "sheet").distinct().orderBy("part", "sheet").collect()]
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    titled = F.when(first, F.concat("top", "line")).otherwise(F.col("line"))
    # a task has one file to write, so no rows wait for a sort by file; a union of single partitions stays a task each
    with settings(spark, spark__sql__maxConcurrentOutputFileWriters="1", spark__sql__unionOutputPartitioning="false"), job_label(spark, "stage titled sheets"):
        whole = reduce(DataFrame.union, found) if found else lines.withColumn("top", F.lit(""))
        whole.select(titled.alias("value"), "part", "sheet").write.partitionBy("part", "sheet").options(
            **{"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}).text(path)
    discard(spark, parts)
    return path


def stage_summary_sheet(summary: DataFrame) -> str:
    """Write a summary table as the CSV sheet that a report would export, the header on its first line."""
    path = scratch_path(summary.sparkSession, "summary-sheet")
    summary.write.option("header", "true").csv(path)
    return path
