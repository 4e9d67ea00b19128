"""Fact builder (B7): key lookups, measure rounding, numbering.

Lookups are left joins against the (checked-size) dimensions, so an
unknown month text or a missing date gives a NULL key instead of losing
the sale. ``sales_id`` numbers the facts in the order of their own
content, which is total up to rows that are equal in every column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import exact_cast, round_to
from ..spec import DEFAULT_SPEC, StarSpec
from .joins import dim_side
from .numbering import sequential_ids

FACT_COLUMNS = ["sales_id", "date_id", "product_id", "month_id", "quantity", "revenue",
                "profit", "profit_margin"]


def lookup_keys(master: DataFrame, dim_date: DataFrame, dim_product: DataFrame,
                dim_month: DataFrame, rows: dict, spec: StarSpec = DEFAULT_SPEC) -> DataFrame:
    """Master rows with date_id, product_id and month_id (NULL when unmapped)."""
    d = dim_side(dim_date.select(F.col("full_date").alias("_k_date"), "date_id"),
                 rows.get("dim_date"), spec)
    p = dim_side(dim_product.select(F.col("product_name").alias("_k_name"),
                                    F.col("package_size").alias("_k_size"), "product_id"),
                 rows.get("dim_product"), spec)
    m = dim_side(dim_month.select(F.col("month_key").alias("_k_month"), "month_id"),
                 rows.get("dim_month"), spec)
    out = (master.join(d, F.col("date") == F.col("_k_date"), "left")
                 .join(p, (F.col("product_type") == F.col("_k_name"))
                       & F.col("unit_size").eqNullSafe(F.col("_k_size")), "left")
                 .join(m, F.col("month") == F.col("_k_month"), "left"))
    return out.drop("_k_date", "_k_name", "_k_size", "_k_month")


def fact_rows(keyed: DataFrame, spec: StarSpec = DEFAULT_SPEC) -> DataFrame:
    """Keyed master -> fact columns (no sales_id), measures rounded and typed."""
    extra = [c for c in ("_src",) if c in keyed.columns]
    r = spec.rounding
    return keyed.select(
        "date_id", "product_id", "month_id",
        exact_cast("quantity", spec.quantity_type).alias("quantity"),
        round_to("revenue", spec.money_places, r).cast(spec.money_type).alias("revenue"),
        round_to("profit", spec.money_places, r).cast(spec.money_type).alias("profit"),
        round_to("profit_margin", spec.ratio_places, r).cast(spec.ratio_type).alias("profit_margin"),
        *extra,
    )


FACT_ORDER = ["date_id", "product_id", "month_id", "quantity", "revenue", "profit",
              "profit_margin"]


def number_facts(facts: DataFrame, spec: StarSpec = DEFAULT_SPEC,
                 keep: dict | None = None, start: int = 1) -> DataFrame:
    """sales_id from ``start`` on in content order (NULLs first), ties split by lineage.

    ``keep["rows"]`` (when given) receives the written facts without ids.
    """
    order = [F.col(c).asc_nulls_first() for c in FACT_ORDER]
    if "_src" in facts.columns:
        order.append(F.col("_src").asc())
    numbered = sequential_ids(facts, order, "sales_id", start,
                              partitions=spec.id_partitions, name="fact_sales", keep=keep)
    if keep is not None and "rows" in keep:
        keep["rows"] = keep["rows"].select(*FACT_COLUMNS[1:])
    return numbered.select(*FACT_COLUMNS)
