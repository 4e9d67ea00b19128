"""Exact numeric helpers.

Money is kept in decimals and rounded as decimals; ratios that must agree
across engines are computed with integer arithmetic on integral decimals,
never through doubles.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INT38 = "decimal(38,0)"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lenient_number(c, parse_type: str = "decimal(38,10)") -> Column:
    """Text -> decimal, NULL for anything that is not a number ('x', '1,200', '').

    A finite number too large for ``parse_type`` raises: as a NULL it would be
    taken for missing and its row dropped without a trace.
    """
    value = _col(c).try_cast(parse_type)
    wide = _col(c).try_cast("double")
    written = _col(c).cast("string").rlike(r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$")
    finite = wide.isNotNull() & written & (F.abs(wide) < F.lit(float("inf")))
    # coalesce parses a number once; only what did not parse is looked at again
    return F.coalesce(value, F.when(finite, F.raise_error(F.concat(F.lit(f"number does not fit {parse_type}: "), _col(c).cast("string")))
                                    .cast(parse_type)))


def exact_cast(c, to: str) -> Column:
    """Cast a decimal; raise where digits would be lost."""
    c = _col(c)
    out = c.try_cast(to)
    return (F.when(c.isNull() | (out == c), out)
            .otherwise(F.raise_error(F.concat(F.lit(f"digits lost in {to}: "), c.cast("string"))).cast(to)))


def round_to(c, places: int, rounding: str = "half_up") -> Column:
    """Round a decimal half away from zero (SQL) or half to even (pandas)."""
    if rounding == "half_even":
        return F.bround(_col(c), places)
    return F.round(_col(c), places)


def floor_div(a: Column, b: Column) -> Column:
    """floor(a / b) for non-negative integral decimals, exactly."""
    return ((a - a % b) / b).cast(INT38)


def half_away_quotient(a, b, places: int = 0, fast: bool = True) -> Column:
    """round_half_away_from_zero(a * 10**places / b) as an integral decimal.

    ``a`` and ``b`` must be integral. NULL when ``b`` is zero or NULL.
    Rows whose operands keep every intermediate in 64 bits take a fast
    path in 64-bit integers; larger rows take the same formula in 38-digit
    decimals. Both paths give the same integer, in every engine.
    ``fast=False`` keeps only the decimal path (smaller code, for values
    computed once per group rather than per row).
    """
    a = _col(a)
    b = _col(b)
    if not fast:
        da, db = a.cast(INT38), b.cast(INT38)
        num = F.abs(da) * F.lit(2 * 10 ** places).cast(INT38) + F.abs(db)
        den = F.abs(db) * F.lit(2).cast(INT38)
        k = floor_div(num, F.when(den == 0, F.lit(1).cast(INT38)).otherwise(den))
        return F.when(db != 0, F.when((da < 0) != (db < 0), -k).otherwise(k))
    bound = (2 ** 62 - 1) // (2 * 10 ** places + 1)
    la, lb = a.cast("long"), b.cast("long")
    fast_num = F.abs(la) * F.lit(2 * 10 ** places) + F.abs(lb)
    fast_den = F.abs(lb) * F.lit(2)
    fast_k = F.call_function("div", fast_num, fast_den).cast(INT38)
    da, db = a.cast(INT38), b.cast(INT38)
    num = F.abs(da) * F.lit(2 * 10 ** places).cast(INT38) + F.abs(db)
    den = F.abs(db) * F.lit(2).cast(INT38)
    slow_k = floor_div(num, F.when(den == 0, F.lit(1).cast(INT38)).otherwise(den))
    small = (F.abs(a) <= F.lit(bound)) & (F.abs(b) <= F.lit(bound))
    k = F.when(small, fast_k).otherwise(slow_k)
    signed = F.when((a < 0) != (b < 0), -k).otherwise(k)
    return F.when(b != 0, signed)


def scaled_ratio(a, b, places: int, fast: bool = False) -> Column:
    """a / b rounded half away from zero to ``places``, as a double."""
    return half_away_quotient(a, b, places, fast).cast("double") / F.lit(10 ** places)
