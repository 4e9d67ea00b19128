"""Every operator of the inventory as a query over the test tables.

Each entry is ``(spark, sf_dir) -> DataFrame`` and reads the given
tables (or data Spark derived from them). The star of one ``sf_dir`` is
built once per application: dimensions and the numbered fact are written
under the checkpoint root, and the queries read those, as the reference
queries read its warehouse file.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import calendar_columns, date_text
from ..functions.display import currency_text, percent_text
from ..functions.measures import cube_measures, mean_ratio, money_sum
from ..functions.numbers import lenient_number
from ..functions.text import clean_text, strip_ws
from ..operators import analytics as A
from ..operators import checks as Q
from ..operators import olap as O
from ..operators.clean import (CATALOGUE_COLUMNS, MONTHLY_COLUMNS, REJECTIONS, clean_catalogue, clean_monthly, drop_missing,
                               flag_transactions, keep_date_like, normalize_columns, quarantine_transactions,
                               rename_positional, tag_source)
from ..operators.fact import lookup_keys
from ..session import scratch_path
from ..sinks import writers
from ..sources import fixtures, readers
from ..sources.sheets import numbered_lines, read_sheets
from ..spec import DEFAULT_SPEC
from . import growing, lattice
from .bucketed import write_bucketed
from .bundle import QUERY_TEXTS, cube_metadata, dashboard_datasets, query_bundle
from .layout import write_layout
from .shared import bundle_document, document_rows, shared_bundle
from .star import Star, fixture_star, named_star, star_from_tables

# Parameters of the OLAP report queries (the member values are the feature).
SLICE_MONTH = "1998-07"
DICE_MEMBERS = {"product_name": "red plate", "package_size": "500g",
                "month_name": [f"1998-{m:02d}" for m in range(1, 13)]}
# Calendar month names (pivot columns), in calendar order.
CALENDAR_MONTHS = ["January", "February", "March", "April", "May", "June", "July",
                   "August", "September", "October", "November", "December"]

_STARS: dict = {}


def at_edge(df: DataFrame) -> DataFrame:
    """Decimal columns as doubles: the stored tables keep exact decimals,
    query results hand plain doubles to their consumers."""
    from pyspark.sql.types import DecimalType
    return df.select(*[F.col(f.name).cast("double").alias(f.name)
                       if isinstance(f.dataType, DecimalType) else F.col(f.name)
                       for f in df.schema.fields])


def star_for(spark: SparkSession, sf_dir: str) -> Star:
    """The fixture star of ``sf_dir``, built and numbered once per application."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _STARS:
        star = fixture_star(spark, sf_dir, DEFAULT_SPEC)
        star.fact  # number and write the fact once; queries read it
        _STARS[key] = star
    return _STARS[key]


def _with_star(fn: Callable[[Star], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(star_for(spark, sf_dir))
    return run


def _cube_join(star: Star) -> DataFrame:
    return (star.measures.join(star.dim("dim_month").select("month_id", "month_name"), "month_id")
            .join(star.dim("dim_product").select("product_id", "product_name", "package_size"),
                  "product_id"))


def _cube_slice(keep):
    def fn(star: Star) -> DataFrame:
        return O.cube_slice(_cube_join(star), star.measures, keep, measures=cube_measures(star.spec))
    return fn


def _cube(star: Star) -> DataFrame:
    return O.star_cube(star, cube_measures(star.spec))


# --- sources --------------------------------------------------------------

def scan_transactions(spark, sf_dir):
    return fixtures.raw_transactions(spark, sf_dir).drop("_src")


def scan_catalogue(spark, sf_dir):
    return fixtures.raw_catalogue(spark, sf_dir).drop("_row")


def _staged_monthly(spark, sf_dir) -> list[str]:
    key = ("monthly", spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _STARS:
        _STARS[key] = fixtures.stage_monthly_sheets(spark, sf_dir)
    return _STARS[key]


def scan_monthly(spark, sf_dir):
    return readers.read_monthly(spark, _staged_monthly(spark, sf_dir))


def union_monthly(spark, sf_dir):
    from functools import reduce
    sheets = [readers.read_monthly(spark, [p]) for p in _staged_monthly(spark, sf_dir)]
    return reduce(DataFrame.unionByName, sheets)


def clean_monthly_q(spark, sf_dir):
    return clean_monthly(scan_monthly(spark, sf_dir), DEFAULT_SPEC)


def keep_date_like_q(spark, sf_dir):
    return keep_date_like(rename_positional(scan_monthly(spark, sf_dir), MONTHLY_COLUMNS), "date")


def tag_source_q(spark, sf_dir):
    tagged = tag_source(scan_monthly(spark, sf_dir), "sheet", DEFAULT_SPEC)
    return tagged.groupBy("sheet", "month_source").agg(F.count(F.lit(1)).alias("rows"))


def normalize_columns_q(spark, sf_dir):
    return normalize_columns(scan_transactions(spark, sf_dir))


def rename_positional_q(spark, sf_dir):
    return rename_positional(scan_catalogue(spark, sf_dir), CATALOGUE_COLUMNS)


def drop_missing_q(spark, sf_dir):
    return drop_missing(normalize_columns_q(spark, sf_dir), ["date", "product_type"])


def clean_transactions_q(spark, sf_dir):
    return at_edge(star_for(spark, sf_dir).master.drop("_src"))


def clean_catalogue_q(spark, sf_dir):
    return star_for(spark, sf_dir).catalogue.drop("_row")


def _written(spark, sf_dir) -> Star:
    """The star written (K1) and opened again (S7), once per application."""
    key = ("written", spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _STARS:
        star = star_for(spark, sf_dir)
        root = scratch_path(spark, "warehouse")
        writers.write_star(star, root)
        _STARS[key] = (star_from_tables(readers.read_star(spark, root), star.spec),
                       readers.read_star(spark, root))
    return _STARS[key][0]


def scan_star(spark, sf_dir):
    """The written star, opened again and denormalized."""
    back = _written(spark, sf_dir)
    return at_edge(O.denormalize(back, back.fact).drop("month_key"))


def star_roundtrip(spark, sf_dir):
    """Rows of each table after a write and read-back."""
    from functools import reduce
    _written(spark, sf_dir)
    tables = _STARS[("written", spark.sparkContext.applicationId, sf_dir.rstrip("/"))][1]
    parts = [df.agg(F.count(F.lit(1)).alias("rows"))
               .select(F.lit(name).alias("table_name"), "rows") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def _stored(table: str):
    """A stored summary, as read back from the written star."""
    return lambda spark, sf_dir: _written(spark, sf_dir).stored[table]


def _named(fn: Callable[[Star], DataFrame]):
    """The query over the star with three named months."""
    def run(spark, sf_dir):
        key = ("named", spark.sparkContext.applicationId, sf_dir.rstrip("/"))
        if key not in _STARS:
            _STARS[key] = named_star(star_for(spark, sf_dir))
        return fn(_STARS[key])
    return run


def export_dashboard(spark, sf_dir):
    """Write the dashboard's eleven datasets; rows of each, read back."""
    from functools import reduce
    back = writers.export_dashboard(dashboard_datasets(star_for(spark, sf_dir)),
                                    scratch_path(spark, "dashboard"))
    return reduce(DataFrame.unionByName, [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("dataset"), "rows")
        for name, df in back.items()])


def _query_back(query_id: str):
    """One result of the query bundle, written as JSON and read back."""
    def run(spark, sf_dir):
        item = next(x for x in query_bundle(star_for(spark, sf_dir)) if x["id"] == query_id)
        path = scratch_path(spark, "query-export")
        writers.export_queries([item], path)
        return readers.read_bundle(spark, f"{path}/{query_id}", item["df"].schema)
    return run


def cube_export_back(star):
    """The cube written by slice (K4) and read back."""
    return writers.export_cube(_cube(star), scratch_path(star.spark, "cube-export"))


def star_build(spark, sf_dir):
    """The fact of the whole built warehouse, written and read back."""
    return at_edge(_written(spark, sf_dir).fact)


def _export_back(table: str):
    def run(spark, sf_dir):
        star = star_for(spark, sf_dir)
        path = scratch_path(spark, "export")
        writers.export_tables({table: star.table(table)}, path)
        back = readers.read_bundle(spark, f"{path}/{table}", star.table(table).schema)
        return at_edge(back)
    return run


def query_catalogue(spark, sf_dir):
    """Export the eight query results as JSON (K3) and return their catalogue."""
    star = star_for(spark, sf_dir)
    meta = writers.export_queries(query_bundle(star), scratch_path(spark, "query-bundle"))
    return meta.drop("sql")


def list_sources_q(spark, sf_dir):
    """The staged monthly sheets found under their folder."""
    root = _staged_monthly(spark, sf_dir)[0].rsplit("/", 1)[0]
    files = readers.list_sources(spark, root).where(F.col("path").endswith(".parquet"))
    return files.select("source").distinct()


def audit(spark, sf_dir):
    star = star_for(spark, sf_dir)
    return Q.audit_counts({
        "raw_master": readers.read_transactions(spark, star.raw_path),
        "master_clean": star.master,
        "catalogue_clean": star.catalogue,
        "dim_date": star.dim_date,
        "dim_product": star.dim_product,
        "dim_month": star.dim_month,
        "fact_sales": star.fact,
        "summary_monthly": star.summary_monthly,
        "summary_product": star.summary_product,
    })


# --- projections, lookups, functions ------------------------------------

def lookup_date(star):
    keyed = lookup_keys(star.master, star.dim_date, star.dim_product, star.dim_month, star.rows,
                        star.spec)
    return keyed.select("date", "date_id")


def lookup_product(star):
    keyed = lookup_keys(star.master, star.dim_date, star.dim_product, star.dim_month, star.rows,
                        star.spec)
    return keyed.select("product_type", "unit_size", "product_id")


def lookup_month(star):
    keyed = lookup_keys(star.master, star.dim_date, star.dim_product, star.dim_month, star.rows,
                        star.spec)
    return keyed.select("month", "month_id")


def enrich_category(star):
    return star.dim_product.select("product_name", "category").distinct()


def f_clean_text(spark, sf_dir):
    raw = scan_transactions(spark, sf_dir)
    return raw.select(
        F.col("`Product Type`").alias("product_raw"), clean_text("`Product Type`").alias("product_clean"),
        F.col("`Month `").alias("month_raw"), strip_ws(F.col("`Month `")).alias("month_stripped"),
        F.lower(strip_ws(F.col("`Month `"))).alias("month_clean"),
        F.col("`Unit Size`").alias("size_raw"), clean_text("`Unit Size`").alias("size_clean"))


def f_calendar(star):
    cal = calendar_columns("full_date")
    return star.dim_date.select("full_date", *[c.alias(k) for k, c in cal.items()],
                                date_text("full_date").alias("date_text"))


def f_lenient_parse(spark, sf_dir):
    raw = normalize_columns(scan_transactions(spark, sf_dir))
    return raw.select(
        F.col("quantity").alias("quantity_text"),
        lenient_number("quantity").cast("double").alias("quantity_value"),
        F.col("profit_margin").alias("margin_text"),
        lenient_number("profit_margin").cast("double").alias("margin_value"))


def f_currency(star):
    return A.revenue_by_product(star).select("product_name", "revenue",
                                             currency_text("revenue").alias("revenue_text"))


def f_percent(star):
    return A.margin_by_size(star).select("package_size", "avg_margin_pct",
                                         percent_text("avg_margin_pct").alias("margin_text"))


# --- OLAP report queries ----------------------------------------------------

def rollup_month(star):
    j = star.measures.join(star.dim("dim_month").select("month_id", "month_name"), "month_id")
    return O.roll_up(j, ["month_name"], [money_sum("revenue", "total_revenue", None),
                                         money_sum("profit", "total_profit", None)])


def rollup_product(star):
    j = star.measures.join(star.dim("dim_product").select("product_id", "product_name"), "product_id")
    return O.roll_up(j, ["product_name"], [money_sum("revenue", "total_revenue", None),
                                           money_sum("profit", "total_profit", None)])


def olap_drill_down(star):
    j = star.measures.join(star.dim("dim_date").select("date_id", "full_date", "month_name"),
                           "date_id")
    out = O.drill_down(j, ["month_name", "full_date"], "month_name",
                       [money_sum("revenue", "daily_revenue", None),
                        money_sum("quantity", "units", None)])
    return out.orderBy("full_date")


def olap_slice(star):
    j = O.denormalize(star, star.fact, ("dim_month", "dim_product"))
    return O.slice_(j, "month_name", SLICE_MONTH).select(
        "sales_id", "product_name", "package_size",
        *[F.col(c).cast("double").alias(c) for c in ("quantity", "revenue", "profit")])


def olap_dice(star):
    j = O.denormalize(star, None, ("dim_date", "dim_month", "dim_product"))
    return O.dice(j, DICE_MEMBERS).select(
        "full_date", "month_name",
        *[F.col(c).cast("double").alias(c) for c in ("quantity", "revenue")])


def olap_pivot(star):
    j = (star.measures.join(star.dim("dim_date").select("date_id", "month_name"), "date_id")
         .join(star.dim("dim_product").select("product_id", "product_name"), "product_id"))
    m = mean_ratio("profit_margin", "margin", 2, True, star.spec.ratio_places)
    return O.pivot(j, ["product_name"], "month_name", CALENDAR_MONTHS, m,
                   [f"{name.lower()}_margin" for name in CALENDAR_MONTHS])


def star_join(star):
    return at_edge(O.denormalize(star).drop("month_key"))


def cube_metadata_q(star):
    """Write the cube by slice with its metadata (K4); return the metadata read back."""
    path = scratch_path(star.spark, "cube-export")
    cube = writers.export_cube(_cube(star), path)
    meta = writers.export_metadata(cube_metadata(cube, star), path)
    lists = [F.array_join(c, ", ").alias(c) for c in ("dimensions", "measures")]
    return meta.select("cube_name", *lists, "period", "total_cells")


# --- checks ------------------------------------------------------------------

def check_pk(star):
    from functools import reduce
    keys = [("dim_date", "date_id"), ("dim_product", "product_id"), ("dim_month", "month_id"),
            ("fact_sales", "sales_id")]
    return reduce(DataFrame.unionByName,
                  [Q.check_primary_key(star.table(t), k, t) for t, k in keys])


def check_fk(star):
    links = [(k, star.dim(d), k, d) for k, d in (("date_id", "dim_date"), ("product_id", "dim_product"),
                                                 ("month_id", "dim_month"))]
    return (Q.check_foreign_keys(star.measures, links, "fact_sales")
            .unionByName(Q.check_foreign_key(star.summary_monthly, "month_id", star.dim("dim_month"),
                                             "month_id", "summary_monthly", "dim_month"))
            .unionByName(Q.check_foreign_key(star.summary_product, "product_id", star.dim("dim_product"),
                                             "product_id", "summary_product", "dim_product")))


def check_not_null(star):
    return (Q.check_not_null(star.dim_date, ["full_date"], "dim_date")
            .unionByName(Q.check_not_null(star.dim_product, ["product_name"], "dim_product"))
            .unionByName(Q.check_not_null(star.dim_month, ["month_name"], "dim_month")))


def stream_summary_monthly(spark, sf_dir):
    """Summary_Monthly kept by Structured Streaming over the staged raw files."""
    from ..streaming.summaries import run_monthly_summary
    star = star_for(spark, sf_dir)
    return run_monthly_summary(spark, star.raw_path, star, files_per_batch=2)


# The raw sheet in three batches by the text of its dates; undated rows come last.
BATCH_BOUNDS = ["1997", "1999"]


def _grown(spark, sf_dir):
    """(root, star) of the star grown from three batches, one of them sent twice and the cells compacted on the way."""
    key = ("grown", spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _STARS:
        raw = readers.read_transactions(spark, star_for(spark, sf_dir).raw_path)
        catalogue = fixtures.raw_catalogue(spark, sf_dir)
        date = F.col("` Date`")
        dated = F.coalesce(date.rlike("^[0-9]{4}-"), F.lit(False))
        first, second = [F.coalesce(dated & (date < b), F.lit(False)) for b in BATCH_BOUNDS]
        root = scratch_path(spark, "growing-star")
        growing.append_batch(spark, root, raw.where(first), catalogue, "first")
        growing.append_batch(spark, root, raw.where(second & ~first), catalogue, "second")
        growing.append_batch(spark, root, raw.where(second & ~first), catalogue, "second")
        growing.compact(spark, root)
        growing.append_batch(spark, root, raw.where(~second), catalogue, "third")
        _STARS[key] = (root, growing.open_growing(spark, root))
    return _STARS[key]


def _grown_table(name: str):
    return lambda spark, sf_dir: at_edge(_grown(spark, sf_dir)[1].table(name))


def _rolled_cells(*keys: str):
    """A coarser summary from the stored cells alone."""
    def run(spark, sf_dir):
        root, star = _grown(spark, sf_dir)
        return growing.roll_up_cells(star, growing.stored_cells(spark, root), list(keys))
    return run


def _shared(spark, sf_dir) -> tuple[dict, DataFrame]:
    """The bundle's results from one scan of the fact, by id, and the one table that holds them all."""
    key = ("shared", spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _STARS:
        bundle = shared_bundle(star_for(spark, sf_dir))
        document = bundle_document(bundle, scratch_path(spark, "bundle-document"))
        _STARS[key] = ({item["id"]: item["df"] for item in bundle}, document)
    return _STARS[key]


def _shared_query(query_id: str):
    return lambda spark, sf_dir: _shared(spark, sf_dir)[0][query_id]


def _document_query(query_id: str):
    def run(spark, sf_dir):
        results, document = _shared(spark, sf_dir)
        return document_rows(document, query_id, results[query_id].schema)
    return run


LATTICE_DIMENSIONS = [*O.CUBE_DIMENSIONS, "category"]
LATTICE_SLICES = {"full": ["month_name", "product_name", "package_size"], "month_product": ["month_name", "product_name"],
                  "month_size": ["month_name", "package_size"], "product_size": ["product_name", "package_size"],
                  "month": ["month_name"], "product": ["product_name"], "size": ["package_size"], "grand_total": []}


def _lattice(spark, sf_dir) -> lattice.Lattice:
    """The stored cuboids of the star: written from the facts of its earlier dates, extended by all others."""
    key = ("lattice", spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _STARS:
        star, root = star_for(spark, sf_dir), scratch_path(spark, "lattice")
        measures = cube_measures(star.spec)
        early = F.coalesce(F.col("date_id") <= star.rows["dim_date"] // 2, F.lit(False))
        cells = [O.star_cells(star, measures, star.measures.where(part), LATTICE_DIMENSIONS[1:]) for part in (early, ~early)]
        lattice.extend_lattice(lattice.write_lattice(spark, root, cells[0], LATTICE_DIMENSIONS, measures), cells[1])
        _STARS[key] = lattice.open_lattice(spark, root, measures)
    return _STARS[key]


def _from_lattice(keep, members=None, labelled=O.CUBE_DIMENSIONS):
    return lambda spark, sf_dir: _lattice(spark, sf_dir).answer(keep, members, labelled)


def load_counts_q(spark, sf_dir):
    return growing.load_counts(spark, _grown(spark, sf_dir)[0])


def quarantine_q(spark, sf_dir):
    return quarantine_transactions(scan_transactions(spark, sf_dir)).withColumn("reasons", F.array_join("reasons", ","))


def rejected_counts(spark, sf_dir):
    """Rows read, kept and dropped, and dropped rows by reason, from one pass."""
    flagged = flag_transactions(scan_transactions(spark, sf_dir))
    return flagged.agg(F.count(F.lit(1)).alias("raw_rows"), F.count_if(F.size("reasons") == 0).alias("kept_rows"),
                       *[F.count_if(F.array_contains("reasons", r)).alias(r) for r in REJECTIONS])


def stream_summary_grown(spark, sf_dir):
    """Summary_Monthly of a star fed by the stream, new months included; keys are in order of arrival and left out."""
    from ..streaming.summaries import run_stream_star
    star = run_stream_star(spark, star_for(spark, sf_dir).raw_path, fixtures.raw_catalogue(spark, sf_dir), files_per_batch=4)
    return star.summary_monthly.drop("month_id")


# --- sheets whose header stands below titles ---------------------------------

def _staged(kind: str, stage, spark, sf_dir) -> str:
    key = (kind, spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _STARS:
        _STARS[key] = stage(spark, sf_dir)
    return _STARS[key]


def titled_catalogue(spark, sf_dir):
    """The catalogue from CSV with its header on the second line, cleaned."""
    path = _staged("titled-catalogue", fixtures.stage_titled_catalogue, spark, sf_dir)
    raw = read_sheets(spark, path, CATALOGUE_COLUMNS, fixtures.CATALOGUE_TITLES)
    return clean_catalogue(raw.drop("sheet")).drop("_row")


def titled_monthly(spark, sf_dir):
    """All monthly sheets from CSV with their headers on the third line, named by position."""
    path = _staged("titled-sheets", fixtures.stage_titled_sheets, spark, sf_dir)
    return read_sheets(spark, path, MONTHLY_COLUMNS, fixtures.MONTHLY_TITLES).drop("_row")


def titled_headers(spark, sf_dir):
    """Sheets, their files, their header text and the lines below it, from the lines' places."""
    from ..functions.text import path_leaf_dir
    path = _staged("titled-sheets", fixtures.stage_titled_sheets, spark, sf_dir)
    lines, titles = numbered_lines(spark, path), fixtures.MONTHLY_TITLES
    # by file first, without a sort of all lines: a list keeps the one header line of a file
    files = lines.groupBy("file").agg(F.collect_list(F.when(F.col("line_no") == titles, F.col("line"))).alias("headers"),
                                      F.count_if(F.col("line_no") > titles).alias("rows"))
    return (files.groupBy(path_leaf_dir(F.col("file")).alias("sheet"))
            .agg(F.count(F.lit(1)).alias("files"), F.max(F.array_max("headers")).alias("header"), F.sum("rows").alias("rows")))


def scan_summary_sheet(star):
    """A summary sheet (S4): the monthly summary as exported text, read back as text and typed."""
    summary = star.summary_monthly
    raw = read_sheets(star.spark, fixtures.stage_summary_sheet(summary), summary.columns)
    return raw.select(*[F.col(f.name).cast(f.dataType) for f in summary.schema.fields])


def scan_first_existing(spark, sf_dir):
    """The master sheet from the first of several places that exists."""
    path = star_for(spark, sf_dir).raw_path
    return readers.first_existing(spark, [f"{path}-absent", path],
                                  lambda s, p: readers.read_transactions(s, p, lineage=False))


# --- a fact laid out by several dimensions, and one bucketed with a dimension -----

# enough files at any size for the layout to leave most of them out
LAYOUT_FILES = 32


def _layout(star):
    key = ("layout", id(star))
    if key not in _STARS:
        _STARS[key] = write_layout(star, scratch_path(star.spark, "layout"), files=LAYOUT_FILES)
    return _STARS[key]


def zorder_dice(star):
    return at_edge(_layout(star).dice(DICE_MEMBERS).select("full_date", "month_name", "quantity", "revenue"))


def zorder_size_rollup(star):
    """Revenue by month of two sizes, months left open."""
    diced = _layout(star).dice({"package_size": ["500g", "1kg"]}, ["dim_product", "dim_month"])
    return O.roll_up(diced, ["month_name"], [money_sum("revenue", "total_revenue", None),
                                             money_sum("profit", "total_profit", None)])


def _bucketed(star):
    key = ("bucketed", id(star))
    if key not in _STARS:
        _STARS[key] = write_bucketed(star, name=scratch_path(star.spark, "bucketed").rsplit("/", 1)[1].replace("-", "_"))
    return _STARS[key]


def bucketed_rollup_product(star):
    return O.roll_up(_bucketed(star).join(["product_name"]), ["product_name"],
                     [money_sum("revenue", "total_revenue", None), money_sum("profit", "total_profit", None)])


def bucketed_star_join(star):
    joined = _bucketed(star).join(["product_name", "package_size", "category"])
    return at_edge(O.denormalize(star, joined, ("dim_date", "dim_month")).drop("month_key", "sales_id"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    s = _with_star
    return {
        # sources and sinks
        "scan_transactions": scan_transactions,
        "scan_catalogue": scan_catalogue,
        "scan_monthly": scan_monthly,
        "scan_star": scan_star,
        "star_roundtrip": star_roundtrip,
        "export_summary_product": _export_back("summary_product"),
        **{f"export_{t}": _export_back(t) for t in ("dim_date", "dim_product", "dim_month",
                                                    "fact_sales", "summary_monthly")},
        "export_dashboard": export_dashboard,
        "stored_summary_monthly": _stored("summary_monthly"),
        "stored_summary_product": _stored("summary_product"),
        **{f"query_export_{qid}": _query_back(qid) for qid, _, _ in QUERY_TEXTS},
        # a star grown batch by batch
        **{f"grown_{t}": _grown_table(t) for t in ("dim_date", "dim_product", "dim_month", "fact_sales")},
        "summary_monthly_merged": _grown_table("summary_monthly"),
        "summary_product_merged": _grown_table("summary_product"),
        "summary_quarter_merged": _rolled_cells("year", "quarter"),
        "summary_month_size_merged": _rolled_cells("month_name", "package_size"),
        "grown_dangling_keys": lambda spark, sf_dir: growing.dangling_keys(_grown(spark, sf_dir)[1]),
        "load_counts": load_counts_q,
        "quarantine": quarantine_q,
        "rejected_counts": rejected_counts,
        "stream_summary_grown": stream_summary_grown,
        # the bundle from one scan, and read back from one table of VARIANT rows
        **{f"shared_{qid}": _shared_query(qid) for qid, _, _ in QUERY_TEXTS},
        **{f"document_{qid}": _document_query(qid) for qid, _, _ in QUERY_TEXTS},
        # sheets with titles above their headers, and the sources that had no entry
        "titled_catalogue": titled_catalogue,
        "titled_monthly": titled_monthly,
        "titled_headers": titled_headers,
        "scan_summary_sheet": s(scan_summary_sheet),
        "scan_first_existing": scan_first_existing,
        # dices over a Z-ordered fact, joins over a bucketed one
        "zorder_dice": s(zorder_dice),
        "zorder_size_rollup": s(zorder_size_rollup),
        "bucketed_rollup_product": s(bucketed_rollup_product),
        "bucketed_star_join": s(bucketed_star_join),
        # roll-ups and dices from stored cuboids
        **{f"lattice_{name}": _from_lattice(keep) for name, keep in LATTICE_SLICES.items()},
        "lattice_category_size": _from_lattice(["category", "package_size"], labelled=LATTICE_DIMENSIONS),
        "lattice_dice": _from_lattice(["product_name"], {"month_name": DICE_MEMBERS["month_name"],
                                                         "package_size": [DICE_MEMBERS["package_size"], "1kg"]}),
        "cube_export_back": s(cube_export_back),
        "cube_metadata_named": _named(cube_metadata_q),
        "check_month_named": _named(Q.check_month_agreement),
        "kpis_named": _named(A.kpis),
        "summary_monthly_named": _named(lambda st: st.summary_monthly),
        "query_catalogue": query_catalogue,
        "cube_metadata": s(cube_metadata_q),
        "audit_counts": audit,
        "list_sources": list_sources_q,
        # projections and filters
        "normalize_columns": normalize_columns_q,
        "rename_positional": rename_positional_q,
        "drop_missing": drop_missing_q,
        "keep_date_like": keep_date_like_q,
        "tag_source": tag_source_q,
        "olap_slice": s(olap_slice),
        "olap_dice": s(olap_dice),
        "top_records": s(A.top_records),
        # joins
        "lookup_date": s(lookup_date),
        "lookup_product": s(lookup_product),
        "lookup_month": s(lookup_month),
        "enrich_category": s(enrich_category),
        "rollup_month": s(rollup_month),
        "rollup_product": s(rollup_product),
        "daily_trend": s(A.daily_trend),
        "star_join": s(star_join),
        # aggregations
        "summary_monthly": s(lambda st: st.summary_monthly),
        "summary_product": s(lambda st: st.summary_product),
        "kpis": s(A.kpis),
        "cube_full": s(_cube_slice(["month_name", "product_name", "package_size"])),
        "cube_month_product": s(_cube_slice(["month_name", "product_name"])),
        "cube_month_size": s(_cube_slice(["month_name", "package_size"])),
        "cube_product_size": s(_cube_slice(["product_name", "package_size"])),
        "cube_month": s(_cube_slice(["month_name"])),
        "cube_product": s(_cube_slice(["product_name"])),
        "cube_size": s(_cube_slice(["package_size"])),
        "cube_grand_total": s(_cube_slice([])),
        "cube": s(_cube),
        "revenue_by_month": s(A.revenue_by_month),
        "products_by_revenue": s(A.products_by_revenue),
        "daily_sales_20": s(A.daily_sales),
        "margin_by_size": s(A.margin_by_size),
        "margin_by_month": s(A.margin_by_month),
        "category_size": s(A.category_size),
        "best_days": s(A.best_days),
        "profit_share": s(A.profit_share),
        "revenue_by_product": s(A.revenue_by_product),
        "revenue_by_size": s(A.revenue_by_size),
        "category_totals": s(A.category_totals),
        "size_totals": s(A.size_totals),
        "olap_drill_down": s(olap_drill_down),
        "olap_pivot": s(olap_pivot),
        "revenue_share": s(A.revenue_share),
        "best_members": s(A.best_members),
        # numbering, sort, set operations
        "dim_date": s(lambda st: st.dim_date),
        "dim_product": s(lambda st: st.dim_product),
        "dim_month": s(lambda st: st.dim_month),
        "fact_sales": s(lambda st: at_edge(st.fact)),
        "preview": s(lambda st: A.preview(A.products_by_revenue(st), 4)),
        "top_products_6": s(A.top_products),
        "union_monthly": union_monthly,
        # scalar functions
        "f_clean_text": f_clean_text,
        "f_calendar": s(f_calendar),
        "f_lenient_parse": f_lenient_parse,
        "f_currency": s(f_currency),
        "f_percent": s(f_percent),
        # builders
        "clean_transactions": clean_transactions_q,
        "clean_catalogue": clean_catalogue_q,
        "clean_monthly": clean_monthly_q,
        "star_build": star_build,
        # checks
        "check_pk": s(check_pk),
        "check_fk": s(check_fk),
        "check_not_null": s(check_not_null),
        "check_month": s(Q.check_month_agreement),
        "reconcile": lambda spark, sf_dir: Q.reconcile(_written(spark, sf_dir)),
        # streaming
        "stream_summary_monthly": stream_summary_monthly,
    }
