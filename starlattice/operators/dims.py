"""Dimension builders.

Members are found with ``distinct`` (partial aggregation before the
shuffle, so a hot member costs nothing extra), numbered with the
distributed :func:`sequential_ids`, and described with calendar
functions. Each returns a DataFrame over files written once, so its row
count is exact and cheap to read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import calendar_columns
from ..spec import DEFAULT_SPEC, StarSpec
from .numbering import sequential_ids


# grouping ids of the three member sets (bit set = column rolled up, over
# date, product_type, unit_size, __year, __month, first most significant)
DATE_SET, PAIR_SET, MONTH_SET = 0b01111, 0b10011, 0b11100


def dimension_members(master: DataFrame) -> DataFrame:
    """Distinct dates, (product, size) pairs and (year, month)s from ONE pass.

    A three-set ``groupingSets`` aggregate: every task reduces its rows to
    members before the (small) shuffle, so a hot member costs nothing, and
    the master is scanned once for all dimensions. ``__set`` tells the sets
    apart (``DATE_SET``, ``PAIR_SET``, ``MONTH_SET``).
    """
    dated = master.select("date", "product_type", "unit_size",
                          F.year("date").cast("bigint").alias("__year"),
                          F.month("date").cast("bigint").alias("__month"))
    return (dated.groupingSets([["date"], ["product_type", "unit_size"], ["__year", "__month"]],
                               "date", "product_type", "unit_size", "__year", "__month")
                 .agg(F.grouping_id().alias("__set"), F.count(F.lit(1)).alias("__rows")))


def member_counts(members: DataFrame) -> dict[int, int]:
    """Number of members per set (three small numbers); missing dates and months are no members."""
    known = members.where((F.col("__set") != DATE_SET) | F.col("date").isNotNull()) \
        .where((F.col("__set") != MONTH_SET) | F.col("__year").isNotNull())
    return {r["__set"]: r["n"] for r in
            known.groupBy("__set").agg(F.count(F.lit(1)).alias("n")).collect()}


def member_rows(members: DataFrame) -> int:
    """Rows of the master, from the counts kept beside the members."""
    return members.where(F.col("__set") == DATE_SET).agg(F.sum("__rows")).first()[0] or 0


def require_unique(dim: DataFrame, keys: list[str], name: str) -> DataFrame:
    """``dim`` itself; raises when a key that facts are matched by appears twice, as every
    fact with that key would be doubled."""
    twice = dim.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(3).collect()
    if twice:
        shown = ", ".join(str(tuple(r[k] for k in keys)) for r in twice)
        raise ValueError(f"{name}: {'/'.join(keys)} must be unique; repeated: {shown}")
    return dim


def dates_of(members: DataFrame) -> DataFrame:
    return members.where(F.col("__set") == DATE_SET).select(F.col("date").alias("full_date"))


def pairs_of(members: DataFrame) -> DataFrame:
    return members.where(F.col("__set") == PAIR_SET).select(
        F.col("product_type").alias("product_name"), F.col("unit_size").alias("package_size"))


def months_of(members: DataFrame) -> DataFrame:
    return (members.where((F.col("__set") == MONTH_SET) & F.col("__year").isNotNull())
                   .select(F.col("__year").alias("year"), F.col("__month").alias("month_num")))


def date_dim(master: DataFrame, spec: StarSpec = DEFAULT_SPEC,
             dates: DataFrame | None = None, start: int = 1) -> DataFrame:
    """Distinct dates -> date_id from ``start`` on in date order plus calendar attributes."""
    if dates is None:
        dates = master.select(F.col("date").alias("full_date")).distinct()
    dates = dates.where(F.col("full_date").isNotNull())
    numbered = sequential_ids(dates, [F.col("full_date").asc()], "date_id", start,
                              partitions=spec.id_partitions, name="dim_date")
    cal = calendar_columns("full_date")
    return numbered.select("date_id", "full_date", *[c.alias(k) for k, c in cal.items()])


def category_lookup(catalogue: DataFrame) -> DataFrame:
    """product_type -> first non-null category in catalogue row order."""
    return (catalogue.where(F.col("category").isNotNull())
                     .groupBy("product_type")
                     .agg(F.min_by("category", "_row").alias("category")))


def product_dim(master: DataFrame, catalogue: DataFrame,
                spec: StarSpec = DEFAULT_SPEC, pairs: DataFrame | None = None,
                start: int = 1) -> DataFrame:
    """Distinct (product, size) pairs with their category; ids by (name, size)."""
    if pairs is None:
        pairs = master.select(F.col("product_type").alias("product_name"),
                              F.col("unit_size").alias("package_size")).distinct()
    cats = category_lookup(catalogue).withColumnRenamed("product_type", "_cat_product")
    enriched = (pairs.join(cats, pairs.product_name == cats._cat_product, "left")
                     .select("product_name", "package_size",
                             F.coalesce("category", F.lit(spec.default_category)).alias("category")))
    order = [F.col("product_name").asc_nulls_last(), F.col("package_size").asc_nulls_last()]
    numbered = sequential_ids(enriched, order, "product_id", start,
                              partitions=spec.id_partitions, name="dim_product")
    return numbered.select("product_id", "product_name", "package_size", "category")


def month_name_of(year, month_num, spec: StarSpec = DEFAULT_SPEC):
    """The month's name as the spec formats it."""
    return F.date_format(F.make_date(year, month_num, F.lit(1)), spec.month_key_format)


def month_dim(dim_date: DataFrame, spec: StarSpec = DEFAULT_SPEC,
              months: DataFrame | None = None, start: int = 1) -> DataFrame:
    """Months present in the date dimension, ids in (year, month) order.

    month_name is the month formatted with ``spec.month_key_format``
    ('yyyy-MM' keeps several years apart); month_key is its lower-case
    form, the value the master's month text is matched against.
    """
    if months is None:
        months = dim_date.select("year", "month_num").distinct()
    numbered = sequential_ids(months, [F.col("year").asc(), F.col("month_num").asc()],
                              "month_id", start, partitions=spec.id_partitions, name="dim_month")
    first_day = F.make_date("year", "month_num", F.lit(1))
    name = month_name_of(F.col("year"), F.col("month_num"), spec)
    return numbered.select("month_id", name.alias("month_name"), F.lower(name).alias("month_key"),
                           F.quarter(first_day).cast("bigint").alias("quarter"),
                           F.col("year").cast("bigint").alias("year"))


def month_dim_from_rows(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """A fixed month dimension: (month_id, month_name, month_key, quarter, year)."""
    schema = "month_id bigint, month_name string, month_key string, quarter bigint, year bigint"
    return spark.createDataFrame(rows, schema)
