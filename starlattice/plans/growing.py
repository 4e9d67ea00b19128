"""A star that grows batch by batch: stable keys (W1, W2, B4-B8) and mergeable summaries (A1, A2).

Every batch of raw sales is a folder of its own with the members it brought, its facts, and its *cells*:
the additive state of every measure by (month, product) - sums, the sum of basis points and counts. A
commit row written last names the folders that count, so a batch that fails part-way is not seen, and one that
is sent twice is loaded once (its name is in the commit).

* **Keys.** Members of a batch that the dimensions do not have (null-safe anti-join) are numbered
  from the largest key given so far, in the order a full build would give them; old members keep
  theirs, facts likewise. Keys stay dense, and no old fact is read or rewritten.
* **Summaries.** Cells add up: over batches, and from months and products to any coarser level. A mean of
  ratios is finished from its (sum, count) pair after the last addition, so it is exact at every level. Reading a summary
  touches cells only; :func:`compact` folds many batches' cells into one folder.
* **Counts.** Rows read, rows rejected by reason, facts and unmapped keys come from ``DataFrame.observe`` inside the
  jobs that read and write the batch, not from scans of their own.

A sale whose month text names a month that no batch has brought yet gets no month key, and keeps none.
One writer at a time: a commit builds on the newest one.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass, field, replace

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.measures import merged_measures
from ..operators.clean import REJECTIONS, clean_catalogue, flag_transactions, kept_transactions
from ..operators.dims import (date_dim, dates_of, dimension_members, member_rows, month_dim,
                              month_name_of, months_of, pairs_of, product_dim)
from ..operators.fact import fact_rows, lookup_keys, number_facts
from ..operators.joins import dim_side
from ..session import job_label, materialize
from ..spec import DEFAULT_SPEC, StarSpec
from .star import (DIMENSIONS, MONTH_KEYS, PRODUCT_KEYS, Star, fact_cells, finish_months, finish_products,
                   numbering_partitions, star_from_tables, summary_measures)

IDS = {"dim_date": "date_id", "dim_product": "product_id", "dim_month": "month_id", "fact_sales": "sales_id"}
COUNTS = ["raw_rows", *[f"rejected_{r}" for r in REJECTIONS], "clean_rows", "facts", "no_date", "no_month"]
_COMMIT = ("at bigint, batches array<string>, folders array<string>, cells array<string>, "
           "last_ids map<string,bigint>, counts map<string,bigint>, batch string")


@dataclass
class Commit:
    """What a reader may see: folders of members and facts, folders of cells, the last key given of each table."""

    batches: list[str] = field(default_factory=list)
    folders: list[str] = field(default_factory=list)
    cells: list[str] = field(default_factory=list)
    last_ids: dict[str, int] = field(default_factory=lambda: {t: 0 for t in IDS})


def _commits(spark: SparkSession, root: str) -> DataFrame | None:
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/commits")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return None
    return spark.read.schema(_COMMIT).json(f"{path.toString()}/*")


def current_commit(spark: SparkSession, root: str) -> Commit:
    """The newest commit; an empty one where nothing was loaded."""
    commits = _commits(spark, root)
    rows = commits.orderBy(F.desc("at")).take(1) if commits is not None else []
    if not rows:
        return Commit()
    r = rows[0]
    return Commit(list(r.batches), list(r.folders), list(r.cells), dict(r.last_ids))


def _write_commit(spark: SparkSession, root: str, commit: Commit, batch: str | None, counts: dict[str, int]) -> None:
    now = time.time_ns()
    texts = lambda xs: F.array(*[F.lit(x) for x in xs]).cast("array<string>")
    numbers = lambda xs: (F.create_map(*[v for k, n in xs.items() for v in (F.lit(k), F.lit(n).cast("bigint"))])
                          if xs else F.lit(None).cast("map<string,bigint>"))
    row = spark.range(1).select(F.lit(now).alias("at"), texts(commit.batches).alias("batches"),
                                texts(commit.folders).alias("folders"), texts(commit.cells).alias("cells"),
                                numbers(commit.last_ids).alias("last_ids"), numbers(counts).alias("counts"),
                                F.lit(batch).cast("string").alias("batch"))
    with job_label(spark, "commit batch"):
        row.write.mode("errorifexists").json(f"{root.rstrip('/')}/commits/{now}-{uuid.uuid4().hex}")


def _table(spark: SparkSession, root: str, commit: Commit, name: str, like: DataFrame) -> DataFrame:
    """The rows of all committed batches; without a batch, none, with the columns of ``like``."""
    paths = [f"{root.rstrip('/')}/{f}/{name}" for f in commit.folders]
    return spark.read.schema(like.schema).parquet(*paths) if paths else like.limit(0)


def new_members(members: DataFrame, known: DataFrame, keys: dict[str, Column | str]) -> DataFrame:
    """Members that ``known`` does not have; ``keys`` maps a column of ``known`` to the member's (null-safe)."""
    old = known.select(*[F.col(k).alias(f"__old_{k}") for k in keys])
    match = None
    for k, own in keys.items():
        own = members[own] if isinstance(own, str) else own
        same = own.eqNullSafe(old[f"__old_{k}"])
        match = same if match is None else match & same
    return members.join(old, match, "left_anti")


def append_batch(spark: SparkSession, root: str, master_raw: DataFrame, catalogue_raw: DataFrame, batch: str,
                 spec: StarSpec = DEFAULT_SPEC) -> Commit:
    """Load one batch of raw sales into the star under ``root``; a batch already committed is left alone."""
    last = current_commit(spark, root)
    if batch in last.batches:
        return last
    folder = f"batch-{uuid.uuid4().hex}"
    at = f"{root.rstrip('/')}/{folder}"
    read = Observation(f"read-{folder}")
    flagged = flag_transactions(master_raw, spec)
    reasons = [F.count(F.when(F.array_contains("reasons", r), F.lit(1))).alias(f"rejected_{r}") for r in REJECTIONS]
    tallies = [F.count(F.lit(1)).alias("raw_rows"), *reasons,
               F.count(F.when(F.size("reasons") == 0, F.lit(1))).alias("clean_rows")]
    # parsed once, for the members and for both passes over the facts
    master = materialize(kept_transactions(flagged.observe(read, *tallies)), "batch-rows")
    members = materialize(dimension_members(master), "batch-members")
    catalogue = clean_catalogue(catalogue_raw)

    def dimension(name: str, build) -> DataFrame:
        """Write the new members; all members are read back."""
        part = build(_table(spark, root, last, name, build(None)), last.last_ids[name] + 1)
        with job_label(spark, f"new members of {name}"):
            part.write.mode("errorifexists").parquet(f"{at}/{name}")
        return _table(spark, root, replace(last, folders=last.folders + [folder]), name, part)

    def dates(known: DataFrame | None, start: int = 1) -> DataFrame:
        found = dates_of(members)
        return date_dim(master, spec, new_members(found, known, {"full_date": "full_date"}), start) if known is not None \
            else _empty(spark, "date_id bigint, full_date date, day bigint, month_num bigint, month_name string, "
                               "quarter bigint, year bigint, week_of_year bigint")

    def products(known: DataFrame | None, start: int = 1) -> DataFrame:
        found = pairs_of(members)
        keys = {"product_name": "product_name", "package_size": "package_size"}
        return product_dim(master, catalogue, spec, new_members(found, known, keys), start) if known is not None \
            else _empty(spark, "product_id bigint, product_name string, package_size string, category string")

    def months(known: DataFrame | None, start: int = 1) -> DataFrame:
        found = months_of(members)
        name = month_name_of(found["year"], found["month_num"], spec)
        return month_dim(found, spec, new_members(found, known, {"month_name": name}), start) if known is not None \
            else _empty(spark, "month_id bigint, month_name string, month_key string, quarter bigint, year bigint")

    d_date, d_product, d_month = (dimension(n, b) for n, b in zip(DIMENSIONS, (dates, products, months)))
    ids = {}
    for name, dim in zip(DIMENSIONS, (d_date, d_product, d_month)):
        new = spark.read.schema(dim.schema).parquet(f"{at}/{name}")
        ids[name] = new.agg(F.max(IDS[name])).first()[0] or last.last_ids[name]
    keyed = lookup_keys(master, d_date, d_product, d_month, ids, spec)
    keep: dict = {}
    sized = spec if spec.id_partitions else replace(spec, id_partitions=numbering_partitions(spark, member_rows(members)))
    numbered = number_facts(fact_rows(keyed, spec), sized, keep, start=last.last_ids["fact_sales"] + 1)
    written = Observation(f"facts-{folder}")
    missing = lambda c: F.count(F.when(F.col(c).isNull(), F.lit(1)))
    facts = [F.count(F.lit(1)).alias("facts"), missing("date_id").alias("no_date"), missing("month_id").alias("no_month")]
    with job_label(spark, "facts of a batch"):
        numbered.observe(written, *facts).write.mode("errorifexists").parquet(f"{at}/fact_sales")
    with job_label(spark, "cells of a batch"):
        fact_cells(keep["rows"], spec).write.mode("errorifexists").parquet(f"{at}/cells")
    seen_counts = {**_observed(read, flagged, tallies), **_observed(written, numbered, facts)}
    counts = {c: int(seen_counts[c]) for c in COUNTS}
    ids["fact_sales"] = last.last_ids["fact_sales"] + counts["facts"]
    commit = Commit(last.batches + [batch], last.folders + [folder], last.cells + [folder], ids)
    _write_commit(spark, root, commit, batch, counts)
    return commit


def _observed(metrics: Observation, df: DataFrame, tallies: list[Column]) -> dict:
    """What the job observed. A batch of which no row is left is replaced at run time by an empty relation,
    observation and all; only then are the (few) rows counted apart."""
    try:
        return metrics.get
    except Py4JJavaError:
        return df.agg(*tallies).first().asDict()


def _empty(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)


def stored_cells(spark: SparkSession, root: str, spec: StarSpec = DEFAULT_SPEC) -> DataFrame:
    """The merged cells of all committed batches: month_id, product_id and the measures' partials."""
    commit = current_commit(spark, root)
    if not commit.cells:
        raise FileNotFoundError(f"no batch was loaded under {root}")
    raw = spark.read.parquet(*[f"{root.rstrip('/')}/{f}/cells" for f in commit.cells])
    return merge_cells(raw, ["month_id", "product_id"], spec)


def merge_cells(cells: DataFrame, keys: list[str], spec: StarSpec = DEFAULT_SPEC) -> DataFrame:
    """Cells added up by ``keys``: partial states stay partial states, so merging can go on from the result."""
    types = {f.name: f.dataType for f in cells.schema.fields}
    merged = [p for m in merged_measures(summary_measures(spec)) for p in m.partials]
    names = [k for m in summary_measures(spec) for k, _ in m.parts]
    out = cells.groupBy(*keys).agg(*merged)
    # a sum of decimals widens its type with every merge; the stored type stays
    return out.select(*keys, *[F.col(n).cast(types[n]).alias(n) for n in names])


def compact(spark: SparkSession, root: str, spec: StarSpec = DEFAULT_SPEC) -> Commit:
    """Fold the cells of all batches into one folder and make it the current one; facts and members stay."""
    commit = current_commit(spark, root)
    if len(commit.cells) < 2:
        return commit
    folder = f"cells-{uuid.uuid4().hex}"
    with job_label(spark, "compact cells"):
        stored_cells(spark, root, spec).write.mode("errorifexists").parquet(f"{root.rstrip('/')}/{folder}/cells")
    after = replace(commit, cells=[folder])
    _write_commit(spark, root, after, None, {})
    return after


def open_growing(spark: SparkSession, root: str, spec: StarSpec = DEFAULT_SPEC) -> Star:
    """The star of all committed batches; its summaries are finished from the merged cells."""
    commit = current_commit(spark, root)
    if not commit.folders:
        raise FileNotFoundError(f"no batch was loaded under {root}")
    read = lambda name: spark.read.parquet(*[f"{root.rstrip('/')}/{f}/{name}" for f in commit.folders])
    star = star_from_tables({name: read(name) for name in (*DIMENSIONS, "fact_sales")}, spec)
    cells = stored_cells(spark, root, spec)
    star.stored = {"summary_monthly": finish_months(cells, star), "summary_product": finish_products(cells, star)}
    return star


def roll_up_cells(star: Star, cells: DataFrame, keys: list[str]) -> DataFrame:
    """Summary measures by any columns of the month and product dimensions, from cells alone.

    Cells are added up by the dimensions' keys that are needed before names are joined.
    """
    month = [k for k in keys if k in (*MONTH_KEYS, "month_key", "quarter")]
    product = [k for k in keys if k in PRODUCT_KEYS]
    unknown = sorted(set(keys) - set(month) - set(product))
    if unknown:
        raise ValueError(f"not columns of the month or product dimension: {', '.join(unknown)}")
    ids = ["month_id"] * bool(month) + ["product_id"] * bool(product)
    out = merge_cells(cells, ids, star.spec)
    if month:
        out = out.join(dim_side(star.dim_month.select("month_id", *[k for k in month if k != "month_id"]),
                                star.rows.get("dim_month"), star.spec), "month_id")
    if product:
        out = out.join(dim_side(star.dim_product.select("product_id", *[k for k in product if k != "product_id"]),
                                star.rows.get("dim_product"), star.spec), "product_id")
    merged = merged_measures(summary_measures(star.spec))
    return out.groupBy(*keys).agg(*[p for m in merged for p in m.partials]).select(*keys, *[m.final for m in merged])


def load_counts(spark: SparkSession, root: str) -> DataFrame:
    """What each batch read, rejected and wrote: batch, and the counts its own jobs observed."""
    commits = _commits(spark, root)
    if commits is None:
        raise FileNotFoundError(f"no batch was loaded under {root}")
    return commits.where(F.col("batch").isNotNull()).select(
        "batch", *[F.col("counts").getItem(c).alias(c) for c in COUNTS])


def dangling_keys(star: Star) -> DataFrame:
    """Per dimension: members, smallest and largest key, and facts whose key has no member."""
    parts = None
    for name in DIMENSIONS:
        key = IDS[name]
        dim = getattr(star, name)
        used = star.measures.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
        both = used.join(dim.select(key, F.lit(True).alias("known")), key, "full")
        known = F.when(F.col("known"), F.col(key))
        one = both.agg(F.count(known).alias("members"), F.min(known).alias("first_key"), F.max(known).alias("last_key"),
                       F.coalesce(F.sum(F.when(F.col("known").isNull(), F.col("n"))), F.lit(0)).alias("dangling"))
        one = one.select(F.lit(name).alias("dimension"), "*")
        parts = one if parts is None else parts.unionByName(one)
    return parts


__all__ = ["Commit", "append_batch", "compact", "current_commit", "dangling_keys", "load_counts", "merge_cells",
           "new_members", "open_growing", "roll_up_cells", "stored_cells"]
