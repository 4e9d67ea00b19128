"""Calendar attributes and date parsing as built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip_ws


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strict_date(c, fmt: str | None = None) -> Column:
    """Text -> date; blank text is NULL, other malformed text raises (ANSI), like ``pd.to_datetime``."""
    c = F.nullif(strip_ws(_col(c).cast("string")), F.lit(""))
    return F.to_date(c, fmt) if fmt else F.to_date(c)


def lenient_date(c, fmt: str | None = None) -> Column:
    """Text -> date; malformed text gives NULL (``errors='coerce'``)."""
    c = strip_ws(_col(c).cast("string"))
    return F.try_to_date(c, fmt) if fmt else F.try_to_date(c)


def calendar_columns(d) -> dict[str, Column]:
    """day, month number and name, quarter, year and ISO week of a date."""
    d = _col(d)
    return {
        "day": F.dayofmonth(d).cast("bigint"),
        "month_num": F.month(d).cast("bigint"),
        "month_name": F.date_format(d, "MMMM"),
        "quarter": F.quarter(d).cast("bigint"),
        "year": F.year(d).cast("bigint"),
        "week_of_year": F.weekofyear(d).cast("bigint"),
    }


def date_text(d) -> Column:
    return F.date_format(_col(d), "yyyy-MM-dd")
