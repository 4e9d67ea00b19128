"""Cleaning operators (P1-P7, B1-B3): one narrow select chain each.

All of them are projections and filters, so Catalyst fuses them into the
scan's whole-stage-codegen span; none shuffles.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import lenient_date, strict_date
from ..functions.numbers import lenient_number
from ..functions.text import clean_text, normalize_name, source_tag
from ..spec import DEFAULT_SPEC, StarSpec

# Header renames applied after normalisation.
RENAME_MAP = {"revenue_": "revenue", "profit_": "profit", "unit_size_": "unit_size"}
# Positional names of the catalogue and monthly sheets.
CATALOGUE_COLUMNS = ["product_type", "size", "pieces_per_box", "sell_price_per_piece",
                     "sell_price_per_box", "shelf_life", "category"]
MONTHLY_COLUMNS = ["date", "product_type", "size_g", "quantity_sold_box",
                   "pieces_per_box", "selling_price_per_piece", "revenue",
                   "cost_per_piece", "total_cost", "profit", "margin_pct"]
HEADER_DATE_TEXTS = ["date", "date ", "Date"]

# Columns carried along for lineage / row order; never renamed by position.
LINEAGE_COLUMNS = ("_src", "_row", "sheet")

MASTER_COLUMNS = ["date", "month", "product_type", "unit_size", "quantity",
                  "revenue", "profit", "profit_margin"]


def normalize_columns(df: DataFrame, rename: dict | None = None) -> DataFrame:
    """Header names: strip, lower case, blank -> '_', then the rename map."""
    names = [normalize_name(c) for c in df.columns]
    out = df.toDF(*names)
    mapping = {k: v for k, v in (RENAME_MAP if rename is None else rename).items()
               if k in names and k != v}
    return out.withColumnsRenamed(mapping) if mapping else out


def rename_positional(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Replace all data column names by position; a wrong count raises."""
    data = [c for c in df.columns if c not in LINEAGE_COLUMNS]
    if len(data) != len(names):
        raise ValueError(f"expected {len(names)} columns, found {len(data)}: {data}")
    mapping = dict(zip(data, names))
    return df.select(*[F.col(f"`{c}`").alias(mapping.get(c, c)) for c in df.columns])


def drop_missing(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop rows with NULL in any of ``cols``."""
    return df.na.drop(how="any", subset=list(cols))


def keep_date_like(df: DataFrame, col: str = "date", header_texts=HEADER_DATE_TEXTS,
                   fmt: str | None = None) -> DataFrame:
    """Drop repeated header rows, parse leniently, drop what did not parse (P5)."""
    kept = df.where(~F.col(col).isin(list(header_texts)))
    return drop_missing(kept.withColumn(col, lenient_date(F.col(col), fmt)), [col])


def tag_source(df: DataFrame, sheet_col: str = "sheet", spec: StarSpec = DEFAULT_SPEC,
               out: str = "month_source") -> DataFrame:
    """month_source from the sheet name: drop suffix, '_' -> ' ', title case."""
    return df.withColumn(out, source_tag(F.col(sheet_col), spec.monthly_sheet_suffix))


def clean_transactions(raw: DataFrame, spec: StarSpec = DEFAULT_SPEC) -> DataFrame:
    """The master sheet -> typed master rows (B1).

    Order as in the reference: normalise names, drop rows without date or
    product, parse the date strictly, clean text, parse numbers leniently,
    drop rows without quantity, revenue or profit.
    """
    df = drop_missing(normalize_columns(raw), ["date", "product_type"])
    extra = [c for c in df.columns if c in LINEAGE_COLUMNS]
    typed = df.select(
        strict_date(F.col("date"), spec.date_format).alias("date"),
        clean_text("month").alias("month"),
        clean_text("product_type").alias("product_type"),
        clean_text("unit_size").alias("unit_size"),
        lenient_number("quantity", spec.parse_type).alias("quantity"),
        lenient_number("revenue", spec.parse_type).alias("revenue"),
        lenient_number("profit", spec.parse_type).alias("profit"),
        lenient_number("profit_margin", spec.parse_type).alias("profit_margin"),
        *extra,
    )
    return drop_missing(typed, ["quantity", "revenue", "profit"])


# Why a raw sale is not loaded, in the order in which the rows are looked at.
REJECTIONS = ["corrupt_record", "no_date", "no_product", "bad_quantity", "bad_revenue", "bad_profit"]
CORRUPT_COLUMN = "_corrupt_record"


def _rejections(df: DataFrame, spec: StarSpec):
    """(all fields are there, why a sale is dropped) as expressions over normalised raw columns."""
    corrupt = F.col(CORRUPT_COLUMN).isNotNull() if CORRUPT_COLUMN in df.columns else F.lit(False)
    present = ~corrupt & F.col("date").isNotNull() & F.col("product_type").isNotNull()
    bad = [present & F.when(present, lenient_number(c, spec.parse_type)).isNull() for c in ("quantity", "revenue", "profit")]
    tests = [corrupt, ~corrupt & F.col("date").isNull(), ~corrupt & F.col("product_type").isNull(), *bad]
    return present, F.array_compact(F.array(*[F.when(t, F.lit(r)) for t, r in zip(tests, REJECTIONS)]))


def flag_transactions(raw: DataFrame, spec: StarSpec = DEFAULT_SPEC) -> DataFrame:
    """Every raw sale with its typed columns and ``reasons``, the array of why it would be dropped.

    The rows without a reason are exactly those of :func:`clean_transactions`. As there,
    numbers are looked at only where date and product are present, so a row has reasons of one
    stage: a corrupt record or missing fields, else bad numbers. A text source read with a
    ``_corrupt_record`` column brings the records that could not be parsed.
    """
    df = normalize_columns(raw)
    present, reasons = _rejections(df, spec)
    return df.select(
        F.when(present, strict_date(F.col("date"), spec.date_format)).alias("date"),
        clean_text("month").alias("month"), clean_text("product_type").alias("product_type"),
        clean_text("unit_size").alias("unit_size"),
        *[F.when(present, lenient_number(c, spec.parse_type)).alias(c)
          for c in ("quantity", "revenue", "profit", "profit_margin")],
        *[c for c in df.columns if c in LINEAGE_COLUMNS], reasons.alias("reasons"))


def kept_transactions(flagged: DataFrame) -> DataFrame:
    """The flagged sales that are loaded, without their (empty) reasons."""
    return flagged.where(F.size("reasons") == 0).drop("reasons")


def quarantine_transactions(raw: DataFrame, spec: StarSpec = DEFAULT_SPEC) -> DataFrame:
    """The raw sales that are not loaded, as they were read (column names normalised), with their reasons."""
    df = normalize_columns(raw)
    return df.withColumn("reasons", _rejections(df, spec)[1]).where(F.size("reasons") > 0)


def clean_catalogue(raw: DataFrame) -> DataFrame:
    """Catalogue -> (product_type, category, ...) by position (B2)."""
    df = drop_missing(rename_positional(raw, CATALOGUE_COLUMNS), ["product_type"])
    return (df.withColumn("product_type", clean_text("product_type"))
              .withColumn("category", clean_text("category")))


def clean_monthly(raw: DataFrame, spec: StarSpec = DEFAULT_SPEC) -> DataFrame:
    """Monthly sheets -> dated, tagged rows with product and revenue."""
    df = drop_missing(rename_positional(raw, MONTHLY_COLUMNS), ["date"])
    df = keep_date_like(df, "date", fmt=spec.date_format)
    df = tag_source(df, "sheet", spec)
    df = df.withColumn("product_type", clean_text("product_type"))
    return drop_missing(df, ["date", "product_type", "revenue"])
