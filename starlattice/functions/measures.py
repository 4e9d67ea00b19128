"""Measures as (partial aggregates, final expression) pairs.

Sums stay decimal until the final rounding and only then become doubles
(exact in every engine). A mean of ratios is not additive, so it is
carried as the pair (sum of basis points, count) and finished with
integer arithmetic; the same pair rolls up correctly through any level.

A :class:`Measure` names its partial aggregates and builds its final
expression from a resolver (partial name -> Column), so the same measure
can be finished over plain group-by output, pivoted columns or a union.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, GroupedData
from pyspark.sql import functions as F

from .numbers import INT38, scaled_ratio

Resolver = Callable[[str], Column]


@dataclass
class Measure:
    name: str
    parts: list[tuple[str, Column]]
    finish: Callable[[Resolver], Column]

    @property
    def partials(self) -> list[Column]:
        return [expr.alias(key) for key, expr in self.parts]

    @property
    def final(self) -> Column:
        return self.finish(F.col).alias(self.name)

    def final_over(self, resolve: Resolver, name: str | None = None) -> Column:
        return self.finish(resolve).alias(name or self.name)


def _p(name: str, part: str) -> str:
    return f"__{name}__{part}"


def money_sum(column: str, name: str, places: int | None = 2) -> Measure:
    """SUM(column), rounded (decimal, half up) to ``places``, then a double."""
    key = _p(name, "s")

    def finish(r: Resolver) -> Column:
        total = r(key)
        return (F.round(total, places) if places is not None else total).cast("double")
    return Measure(name, [(key, F.sum(F.col(column)))], finish)


def int_sum(column: str, name: str) -> Measure:
    """CAST(SUM(column) AS INTEGER): truncation toward zero."""
    key = _p(name, "s")
    return Measure(name, [(key, F.sum(F.col(column)))], lambda r: r(key).cast("bigint"))


def row_count(name: str) -> Measure:
    """COUNT(key) over a never-null key, i.e. COUNT(*)."""
    key = _p(name, "n")
    return Measure(name, [(key, F.count(F.lit(1)))], lambda r: r(key))


def basis_points(column: str, ratio_places: int = 4) -> Column:
    """A ratio kept at ``ratio_places`` decimals as an exact integer."""
    return (F.col(column) * F.lit(10 ** ratio_places)).cast("decimal(18,0)")


def mean_ratio(column: str, name: str, places: int | None = 2, percent: bool = True,
               ratio_places: int = 4) -> Measure:
    """AVG(ratio) (x100 when ``percent``), NULLs skipped, rounded half up.

    ``places=None`` gives the unrounded double S / (n * unit).
    """
    bp = basis_points(column, ratio_places)
    s, n = _p(name, "s"), _p(name, "n")
    unit = 10 ** ratio_places // (100 if percent else 1)

    def finish(r: Resolver) -> Column:
        if places is None:
            return F.when(r(n) > 0, r(s).cast("double") / (r(n).cast("double") * F.lit(float(unit))))
        return scaled_ratio(r(s), r(n) * F.lit(unit), places)
    return Measure(name, [(s, F.sum(bp)), (n, F.count(bp))], finish)


def share_pct(part: Column, whole: Column, places: int = 2, money_places: int = 2) -> Column:
    """part * 100 / whole, rounded half up to ``places``; NULL when whole is 0."""
    scale = F.lit(10 ** money_places)
    return scaled_ratio((part * scale * F.lit(100)).cast(INT38),
                        (whole * scale).cast(INT38), places)


def merged_measures(measures) -> list[Measure]:
    """The same measures over cells: every partial is a sum or a count, and merges by adding."""
    return [Measure(m.name, [(key, F.sum(F.col(key))) for key, _ in m.parts], m.finish)
            for m in measures]


def aggregate(grouped: GroupedData, keys: list[Column], measures: list[Measure]):
    """Run all partial aggregates in one pass, then the final expressions."""
    partials = [p for m in measures for p in m.partials]
    return grouped.agg(*partials).select(*keys, *[m.final for m in measures])


def cube_measures(spec=None) -> list[Measure]:
    """The five cube measures: revenue, profit, units, transactions, margin %."""
    ratio_places = spec.ratio_places if spec else 4
    return [
        money_sum("revenue", "total_revenue", 2),
        money_sum("profit", "total_profit", 2),
        money_sum("quantity", "total_units", 0),
        row_count("total_transactions"),
        mean_ratio("profit_margin", "avg_margin_pct", 2, True, ratio_places),
    ]
