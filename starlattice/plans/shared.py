"""The query bundle from one scan of the fact (K3, A13-A20), and as one table of unlike rows.

A :class:`Report` says what a query groups by, what it measures and how it is sorted. :func:`common_grain` finds the
fewest keys of the fact that all reports together need, :func:`shared_cells` aggregates the fact to them once, each
distinct partial state once however many reports use it, and writes the cells. Every report then adds up cells by its own
keys, joins the dimensions to the few groups left and finishes its measures; shares take their whole from the same cells.
Cells are as many as the combinations of the keys that occur, whatever the number of sales. Keys that did not resolve stay
in the cells, so each report drops only those that its own joins would.

:func:`bundle_document` puts results of different shapes into one table, a row as a VARIANT; :func:`document_rows` reads
those of one query back by path. Rows carry no position: a reader sorts by the columns the query sorts by.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.measures import Measure, int_sum, mean_ratio, money_sum, row_count, share_pct
from ..session import materialize
from .bundle import QUERY_TEXTS, SQL_TEXTS

# Where a level column lives: its dimension and the fact's key of it.
LEVELS = {"month_id": ("dim_month", "month_id"), "full_date": ("dim_date", "date_id"), "month_name": ("dim_month", "month_id"),
          "product_name": ("dim_product", "product_id"), "package_size": ("dim_product", "product_id"),
          "category": ("dim_product", "product_id")}


@dataclass(frozen=True)
class Report:
    """Measures by ``levels``; ``share`` is (measure, fact column, name): that measure's percent of the whole fact's.

    ``first`` is a key whose smallest value in a group is what the group is sorted by, ahead of ``order``;
    ``hidden`` levels are grouped and sorted by, and not returned.
    """

    levels: tuple[str, ...]
    measures: tuple[Measure, ...]
    order: tuple[Column, ...] = ()
    limit: int | None = None
    share: tuple[str, str, str] | None = None
    first: str | None = None
    hidden: tuple[str, ...] = ()

    @property
    def keys(self) -> list[str]:
        return sorted({LEVELS[c][1] for c in self.levels + self.hidden})


def bundle_reports(spec) -> dict[str, Report]:
    """The eight queries of the bundle."""
    places = spec.money_places
    money = lambda column, name: money_sum(column, name, places)
    margin = mean_ratio("profit_margin", "avg_margin_pct", 2, True, spec.ratio_places)
    return {
        "revenue_by_month": Report(("month_name",), (money("revenue", "revenue"), money("profit", "profit")),
                                   (F.asc("month_id"),), hidden=("month_id",)),
        "products_by_revenue": Report(("product_name",), (money("revenue", "total_rev"),),
                                      (F.desc("total_rev"), F.asc("product_name"))),
        "daily_sales_20": Report(("full_date",), (money("revenue", "rev"), int_sum("quantity", "units")),
                                 (F.asc("full_date"),), 20),
        "margin_by_size": Report(("package_size",), (margin,),
                                 (F.desc_nulls_last("avg_margin_pct"), F.asc_nulls_last("package_size"))),
        "margin_by_month": Report(("month_name",), (margin, row_count("transactions")), first="month_id"),
        "category_size": Report(("category", "package_size"), (money("revenue", "revenue"), int_sum("quantity", "units")),
                                (F.desc("revenue"), F.asc_nulls_last("category"), F.asc_nulls_last("package_size"))),
        "best_days": Report(("month_name", "full_date"), (money("revenue", "daily_rev"),),
                            (F.desc("daily_rev"), F.asc("full_date"), F.asc("month_name")), 10),
        "profit_share": Report(("product_name",), (money("profit", "total_profit"),),
                               (F.desc("total_profit"), F.asc("product_name")), share=("total_profit", "profit", "profit_share_pct")),
    }


def common_grain(reports: Sequence[Report]) -> list[str]:
    """The fact's keys that the reports together need: any fewer, and one of them could not be answered."""
    return sorted({k for r in reports for k in r.keys})


def _states(reports: Sequence[Report]) -> dict[str, tuple[str, Column]]:
    """Each distinct partial aggregate of the reports once: its text -> (column of the cells, expression)."""
    out: dict[str, tuple[str, Column]] = {}
    for r in reports:
        for m in r.measures:
            for _, expr in m.parts:
                out.setdefault(str(expr), (f"state_{len(out)}", expr))
    return out


def _merged(report: Report, states: dict[str, tuple[str, Column]]) -> list[Measure]:
    return [Measure(m.name, [(key, F.sum(states[str(expr)][0])) for key, expr in m.parts], m.finish)
            for m in report.measures]


def shared_cells(star, reports: Sequence[Report]) -> DataFrame:
    """The fact at the reports' common grain with all their states, written once: the only scan of the fact."""
    states = _states(reports)
    cells = star.measures.groupBy(*common_grain(reports)).agg(*[e.alias(name) for name, e in states.values()])
    return materialize(cells, "shared-cells")


def run_report(star, report: Report, cells: DataFrame, reports: Sequence[Report]) -> DataFrame:
    """``report`` over the cells of ``reports`` (of which it is one)."""
    states = _states(reports)
    own = cells.groupBy(*report.keys).agg(*[F.sum(name).alias(name) for name, _ in states.values()])
    levels = report.levels + report.hidden
    for dim, key in sorted({LEVELS[c] for c in levels}):
        own = own.join(star.dim(dim).select(key, *[c for c in levels if LEVELS[c][0] == dim and c != key]), key)
    merged = _merged(report, states)
    first = [F.min(report.first).alias("__first")] if report.first else []
    out = own.groupBy(*levels).agg(*first, *[p for m in merged for p in m.partials])
    finals = [m.final for m in merged]
    if report.share:
        measure, column, name = report.share
        part = next(m for m in merged if m.name == measure).parts[0][0]
        whole = next(n for n, e in states.values() if str(e) == str(F.sum(F.col(column))))
        out = out.withColumn("__whole", cells.agg(F.sum(whole)).scalar())
        finals.append(share_pct(F.col(part), F.col("__whole"), 2, star.spec.money_places).alias(name))
    out = out.select(*levels, *(["__first"] if report.first else []), *finals)
    by = [*([F.asc("__first")] if report.first else []), *report.order]
    out = out.orderBy(*by) if by else out
    return (out if report.limit is None else out.limit(report.limit)).drop("__first", *report.hidden)


def shared_bundle(star) -> list[dict]:
    """[{id, title, description, sql, df}] like ``query_bundle``, all eight from one scan of the fact."""
    reports = bundle_reports(star.spec)
    every = list(reports.values())
    cells = shared_cells(star, every)
    return [{"id": qid, "title": title, "description": desc, "sql": SQL_TEXTS[qid],
             "df": run_report(star, reports[qid], cells, every)} for qid, title, desc in QUERY_TEXTS]


def bundle_document(bundle: list[dict], path: str) -> DataFrame:
    """All results in one written table: query_id, title and the row as a VARIANT; read back."""
    parts = [item["df"].select(F.lit(item["id"]).alias("query_id"), F.lit(item["title"]).alias("title"),
                               F.to_variant_object(F.struct("*")).alias("result")) for item in bundle]
    reduce(DataFrame.unionByName, parts).write.mode("errorifexists").parquet(path)
    return bundle[0]["df"].sparkSession.read.parquet(path)


def document_rows(document: DataFrame, query_id: str, schema: StructType) -> DataFrame:
    """One query's rows of a bundle document, its columns taken from the VARIANT by path."""
    return document.where(F.col("query_id") == query_id).select(
        *[F.variant_get("result", f"$.{f.name}", f.dataType.simpleString()).alias(f.name) for f in schema.fields])
