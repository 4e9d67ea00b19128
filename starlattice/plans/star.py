"""The star schema as lazy DataFrames plus the build composition.

The master is scanned once for the members of both dimensions; the
dimensions are numbered and written once, and their exact member counts
decide whether joins broadcast them. The fact exists in two forms:
``facts`` - the lazy lookup of the cleaned master, without ``sales_id`` -
and ``fact`` - numbered with ``sales_id``, written once on first use.
``measures`` is what aggregates read: the written fact rows once the
fact has been numbered (no recomputation, no offsets join), else the
lazy lookup, so a query that never needs the key never pays for it.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.measures import mean_ratio, merged_measures, money_sum, row_count
from ..operators.clean import clean_catalogue, clean_transactions
from ..operators.dims import (DATE_SET, MONTH_SET, PAIR_SET, date_dim, dates_of,
                              dimension_members, member_counts, member_rows, month_dim,
                              month_dim_from_rows, months_of,
                              pairs_of, product_dim, require_unique)
from ..operators.fact import fact_rows, lookup_keys, number_facts
from ..operators.joins import dim_side
from ..session import job_label, materialize
from ..sources import fixtures, readers
from ..spec import DEFAULT_SPEC, StarSpec

DIMENSIONS = ("dim_date", "dim_product", "dim_month")


@dataclass
class Star:
    spec: StarSpec
    master: DataFrame
    catalogue: DataFrame | None
    dim_date: DataFrame
    dim_product: DataFrame
    dim_month: DataFrame
    rows: dict
    facts: DataFrame
    _fact: DataFrame | None = field(default=None, repr=False)
    _fact_rows: DataFrame | None = field(default=None, repr=False)
    raw_path: str | None = None
    id_partitions: int | None = None
    stored: dict = field(default_factory=dict, repr=False)

    @property
    def spark(self) -> SparkSession:
        return self.facts.sparkSession

    @property
    def fact(self) -> DataFrame:
        """Fact_Sales with sales_id (numbered and written on first use)."""
        if self._fact is None:
            keep: dict = {}
            spec = self.spec
            if spec.id_partitions is None and self.id_partitions:
                spec = replace(spec, id_partitions=self.id_partitions)
            self._fact = number_facts(self.facts, spec, keep)
            self._fact_rows = keep.get("rows")
        return self._fact

    @property
    def measures(self) -> DataFrame:
        """The fact without sales_id and lineage: what aggregates read.

        Once the fact has been numbered (and so written), aggregates read
        the written fact instead of recomputing the lookups.
        """
        if self._fact_rows is not None:
            return self._fact_rows
        if self._fact is not None:
            return self._fact.drop("sales_id")
        return self.facts.drop("_src")

    def dim(self, name: str) -> DataFrame:
        """A dimension, marked for broadcast when its checked size allows."""
        return dim_side(getattr(self, name), self.rows.get(name), self.spec)

    @property
    def summary_monthly(self) -> DataFrame:
        """The stored summary; computed together with the other one when there is none."""
        return self._summary("summary_monthly")

    @property
    def summary_product(self) -> DataFrame:
        """The stored summary; computed together with the other one when there is none."""
        return self._summary("summary_product")

    def _summary(self, name: str) -> DataFrame:
        if name not in self.stored:
            self.stored["summary_monthly"], self.stored["summary_product"] = both_summaries(self)
        return self.stored[name]

    def table(self, name: str) -> DataFrame:
        if name == "fact_sales":
            return self.fact
        return getattr(self, name)


def build_star(master_raw: DataFrame, catalogue_raw: DataFrame | None,
               spec: StarSpec = DEFAULT_SPEC, dim_month: DataFrame | None = None,
               store_master: bool = False) -> Star:
    """Clean the sources and build dimensions and the (lazy) fact.

    ``store_master`` writes the cleaned master once, so that the members, the
    sampling and the numbering of the fact read typed rows instead of parsing
    every text again.

    ``dim_month`` replaces the month dimension derived from the dates with a
    given table (month_id, month_name, month_key, quarter, year), e.g. a
    fixed list of months; the master's month text is matched to month_key.
    """
    master = clean_transactions(master_raw, spec)
    if store_master:
        master = materialize(master, "master")
    catalogue = clean_catalogue(catalogue_raw) if catalogue_raw is not None else None
    if catalogue is None:
        catalogue = master.sparkSession.createDataFrame(
            [], "product_type string, category string, _row bigint")
    members = materialize(dimension_members(master), "members")
    with job_label(master.sparkSession, "count members"):
        counts = member_counts(members)
    n_dates, n_pairs = counts.get(DATE_SET, 0), counts.get(PAIR_SET, 0)
    # each dimension is written once, so queries read small files, not the plan
    d_date = materialize(date_dim(master, spec, dates=dates_of(members)), "dim_date")
    d_product = materialize(product_dim(master, catalogue, spec, pairs=pairs_of(members)),
                            "dim_product")
    if dim_month is None:
        n_months = counts.get(MONTH_SET, 0)
        d_month = materialize(month_dim(d_date, spec, months=months_of(members)), "dim_month")
    else:
        d_month = materialize(dim_month.select(
            F.col("month_id").cast("bigint"), "month_name", F.lower("month_key").alias("month_key"),
            F.col("quarter").cast("bigint"), F.col("year").cast("bigint")), "dim_month")
        with job_label(master.sparkSession, "count months"):
            n_months = d_month.count()
    with job_label(master.sparkSession, "check dimension keys"):
        require_unique(d_date, ["full_date"], "dim_date")
        require_unique(d_product, ["product_name", "package_size"], "dim_product")
        require_unique(d_month, ["month_key"], "dim_month")
        require_unique(d_month, ["month_id"], "dim_month")
    rows = {"dim_date": n_dates, "dim_product": n_pairs, "dim_month": n_months}
    keyed = lookup_keys(master, d_date, d_product, d_month, rows, spec)
    star = Star(spec, master, catalogue, d_date, d_product, d_month, rows,
                fact_rows(keyed, spec))
    star.id_partitions = numbering_partitions(master.sparkSession, member_rows(members))
    return star


# A fact row is eight columns of at most 8 bytes; a numbering partition holds about this many bytes.
FACT_ROW_BYTES = 64
NUMBERING_BYTES = 512 * 1024 * 1024


def numbering_partitions(spark: SparkSession, fact_rows: int) -> int:
    """Range partitions for numbering the fact, from the bytes of the typed fact.

    Adaptive execution never splits range partitions, so their number grows
    with the data; it starts from the session's shuffle partitions.
    """
    shuffle = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(shuffle, -(-fact_rows * FACT_ROW_BYTES // NUMBERING_BYTES))


def star_from_tables(tables: dict, spec: StarSpec = DEFAULT_SPEC) -> Star:
    """A Star over already built tables (e.g. from :func:`read_star`)."""
    rows = {k: tables[k].count() for k in DIMENSIONS}
    fact = tables["fact_sales"]
    if "month_id" in fact.columns:  # a partition column reads back as int
        fact = fact.withColumn("month_id", F.col("month_id").cast("bigint"))
    star = Star(spec, fact, None, tables["dim_date"], tables["dim_product"],
                tables["dim_month"], rows, fact.drop("sales_id"))
    star._fact = fact
    star.stored = {k: tables[k] for k in ("summary_monthly", "summary_product") if k in tables}
    return star


# A month dimension of three named months, as a plan for one summer.
NAMED_MONTHS = [(1, "June", "1998-06", 2, 1998), (2, "July", "1998-07", 3, 1998),
                (3, "August", "1998-08", 3, 1998)]


def named_star(star: Star) -> Star:
    """The same sales against the fixed list of named months (other months stay unmapped)."""
    months = month_dim_from_rows(star.spark, NAMED_MONTHS)
    d_month = require_unique(materialize(months, "dim_month"), ["month_key"], "dim_month")
    rows = {**star.rows, "dim_month": len(NAMED_MONTHS)}
    keyed = lookup_keys(star.master, star.dim_date, star.dim_product, d_month, rows, star.spec)
    return Star(star.spec, star.master, star.catalogue, star.dim_date, star.dim_product, d_month,
                rows, fact_rows(keyed, star.spec))


def fixture_star(spark: SparkSession, sf_dir: str, spec: StarSpec = DEFAULT_SPEC) -> Star:
    """The star built from the test tables (see ``sources.fixtures``).

    The raw master sheet is staged as Parquet once and read back with the
    transaction reader, as a real sheet export would be.
    """
    raw_path = fixtures.stage_transactions(spark, sf_dir)
    star = build_star(readers.read_transactions(spark, raw_path),
                      fixtures.raw_catalogue(spark, sf_dir), spec, store_master=True)
    star.raw_path = raw_path
    return star


# --- stored summaries (A1, A2) ------------------------------------------

def summary_measures(spec: StarSpec):
    return [money_sum("revenue", "total_revenue", spec.money_places),
            money_sum("profit", "total_profit", spec.money_places),
            money_sum("quantity", "total_quantity", None),
            mean_ratio("profit_margin", "avg_margin", spec.ratio_places, False, spec.ratio_places),
            row_count("num_transactions")]


MONTH_KEYS = ["month_id", "month_name", "year"]
PRODUCT_KEYS = ["product_id", "product_name", "package_size", "category"]


def fact_cells(facts: DataFrame, spec: StarSpec) -> DataFrame:
    """The summaries' partial states by (month_id, product_id): what can be stored, added up and finished later."""
    return facts.groupBy("month_id", "product_id").agg(*[p for m in summary_measures(spec) for p in m.partials])


def finish_months(cells: DataFrame, star: Star) -> DataFrame:
    """Summary_Monthly from cells; cells of no known month are left out, as an inner join would."""
    merged = merged_measures(summary_measures(star.spec))
    states = cells.groupBy("month_id").agg(*[p for m in merged for p in m.partials])
    return (states.join(star.dim("dim_month").select(*MONTH_KEYS), "month_id")
            .select(*MONTH_KEYS, *[m.final for m in merged]))


def finish_products(cells: DataFrame, star: Star) -> DataFrame:
    """Summary_Product from cells; products without size or category are left out."""
    merged = merged_measures(summary_measures(star.spec))
    states = cells.groupBy("product_id").agg(*[p for m in merged for p in m.partials])
    return (states.join(star.dim("dim_product").select(*PRODUCT_KEYS), "product_id")
            .na.drop(subset=PRODUCT_KEYS).select(*PRODUCT_KEYS, *[m.final for m in merged]))


def both_summaries(star: Star) -> tuple[DataFrame, DataFrame]:
    """Summary_Monthly and Summary_Product from ONE pass over the fact.

    The fact is aggregated to cells by its own keys, which are written once; both summaries add
    them up and join the dimensions to the few groups that are left.
    """
    cells = materialize(fact_cells(star.measures, star.spec), "summary-cells")
    return finish_months(cells, star), finish_products(cells, star)
