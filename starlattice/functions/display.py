"""Presentation columns: Indian-grouped currency text and percent text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numbers import floor_div

# Fixed value: the currency symbol the dashboard prints before amounts.
RUPEE = "₹"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def indian_grouping(digits: Column) -> Column:
    """'1792382' -> '17,92,382': last three digits, then pairs from the right."""
    n = F.length(digits)
    head = F.when(n > 3, F.substring(digits, F.lit(1), n - 3))
    tail = F.when(n > 3, F.substring(digits, n - 2, F.lit(3))).otherwise(digits)
    paired = F.reverse(F.regexp_replace(F.reverse(head), r"([0-9]{2})", "$1,"))
    paired = F.regexp_replace(paired, r"^,", "")
    return F.when(n > 3, F.concat(paired, F.lit(","), tail)).otherwise(tail)


def currency_text(c, symbol: str = RUPEE, max_fraction_digits: int = 2) -> Column:
    """Amount -> grouped text with at most two decimals, trailing zeros dropped.

    The amount is rounded half away from zero in decimal arithmetic first.
    """
    v = F.round(_col(c).cast("decimal(38,10)"), max_fraction_digits)
    cents = (F.abs(v) * F.lit(10 ** max_fraction_digits)).cast("decimal(38,0)")
    whole = floor_div(cents, F.lit(10 ** max_fraction_digits).cast("decimal(38,0)"))
    frac = (cents - whole * F.lit(10 ** max_fraction_digits)).cast("bigint")
    frac_text = F.regexp_replace(
        F.lpad(frac.cast("string"), max_fraction_digits, "0"), "0+$", "")
    body = F.concat(indian_grouping(whole.cast("string")),
                    F.when(frac_text != "", F.concat(F.lit("."), frac_text)).otherwise(F.lit("")))
    sign = F.when(v < 0, F.lit("-")).otherwise(F.lit(""))
    return F.when(v.isNotNull(), F.concat(sign, F.lit(symbol), body))


def percent_text(c, places: int = 2) -> Column:
    """Value -> 'xx.xx%'."""
    return F.format_string(f"%.{places}f%%", _col(c).cast("double"))
