"""OLAP operators over a star: denormalize, roll-up, drill-down, slice,
dice, pivot and the full cube (A4-A12, A26, A27, P8-P11, J5-J9).

The cube reads the fact once. The fact is first aggregated to its cells (for
a star: by the surrogate keys, before any dimension is joined), and the
grouping sets run over the cells: their ``Expand`` copies cells, not facts.
All measures are additive partials, so this loses nothing. Rolled-up
members are labelled with ``grouping()``, so a real NULL member keeps
its NULL. The grand total counts every fact, resolved keys or not, and
is one more grouping set of the same pass, not a second scan.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.measures import Measure, aggregate, cube_measures, merged_measures
from ..spec import ALL_LABEL

# The reference's names for the eight slices of the cube.
SLICE_NAMES = {
    (): "full_cube",
    ("package_size",): "rollup_month_product",
    ("product_name",): "rollup_month_size",
    ("month_name",): "rollup_product_size",
    ("product_name", "package_size"): "rollup_month",
    ("month_name", "package_size"): "rollup_product",
    ("month_name", "product_name"): "rollup_size",
    ("month_name", "product_name", "package_size"): "grand_total",
}
CUBE_DIMENSIONS = ["month_name", "product_name", "package_size"]
# The column that tells cells whose keys all resolved.
MATCHED = "__matched"


def denormalize(star, fact: DataFrame | None = None,
                dims: Sequence[str] = ("dim_date", "dim_product", "dim_month")) -> DataFrame:
    """fact x date x product x month, inner joins on the surrogate keys.

    Dimension columns that share a name are kept apart: the date's month
    name becomes ``date_month_name``, its quarter and year ``date_quarter``
    and ``date_year``; the month dimension's become ``month_quarter`` and
    ``month_year``.
    """
    out = star.measures if fact is None else fact
    for d in dims:
        side = star.dim(d)
        if d == "dim_date":
            side = side.select("date_id", "full_date", F.col("month_name").alias("date_month_name"),
                               "day", "month_num", F.col("quarter").alias("date_quarter"),
                               F.col("year").alias("date_year"), "week_of_year")
            out = out.join(side, "date_id")
        elif d == "dim_product":
            out = out.join(side, "product_id")
        elif d == "dim_month":
            side = side.select("month_id", "month_name", "month_key",
                               F.col("quarter").alias("month_quarter"),
                               F.col("year").alias("month_year"))
            out = out.join(side, "month_id")
        else:
            raise ValueError(f"unknown dimension {d}")
    return out


def roll_up(df: DataFrame, levels: Sequence[str], measures: Sequence[Measure]) -> DataFrame:
    """Aggregate ``df`` to ``levels`` with the given measures."""
    return aggregate(df.groupBy(*levels), [F.col(c) for c in levels], list(measures))


def drill_down(df: DataFrame, hierarchy: Sequence[str], level: str,
               measures: Sequence[Measure]) -> DataFrame:
    """From ``level`` one step finer in ``hierarchy`` (coarse -> fine), keeping parents."""
    i = list(hierarchy).index(level)
    if i + 1 >= len(hierarchy):
        raise ValueError(f"{level} is the finest level of {list(hierarchy)}")
    return roll_up(df, list(hierarchy[: i + 2]), measures)


def slice_(df: DataFrame, column: str, value) -> DataFrame:
    """Fix one dimension member."""
    return df.where(F.col(column) == F.lit(value))


def dice(df: DataFrame, members: dict) -> DataFrame:
    """Fix several dimensions; a list value means IN."""
    cond: Column | None = None
    for column, value in members.items():
        c = (F.col(column).isin(list(value)) if isinstance(value, (list, tuple, set))
             else F.col(column) == F.lit(value))
        cond = c if cond is None else cond & c
    return df if cond is None else df.where(cond)


def pivot(df: DataFrame, rows: Sequence[str], column: str, values: Sequence,
          measure: Measure, names: Sequence[str]) -> DataFrame:
    """One row per ``rows`` member, one ``measure`` column per value.

    The value list is explicit, so Spark needs no extra job to find it.
    Every cell carries the measure's partial aggregates (Spark names them
    ``<value>_<partial>``) and is finished after the pivot, which keeps
    non-additive measures such as a mean of ratios exact.
    """
    keys = [k for k, _ in measure.parts]
    grouped = df.groupBy(*rows).pivot(column, list(values)).agg(*measure.partials)
    finals = []
    for value, out in zip(values, names):
        if len(keys) == 1:
            resolve = (lambda k, v=value: F.col(f"`{v}`"))
        else:
            resolve = (lambda k, v=value: F.col(f"`{v}_{k}`"))
        finals.append(measure.final_over(resolve, out))
    return grouped.select(*[F.col(r) for r in rows], *finals)


def _slice_name(rolled: tuple[str, ...], dims: Sequence[str], names: dict | None) -> str:
    if names is not None and rolled in names:
        return names[rolled]
    kept = [d for d in dims if d not in rolled]
    if not kept:
        return "grand_total"
    if not rolled:
        return "full_cube"
    return "rollup_" + "_".join(kept)


def grand_total(fact: DataFrame, dims: Sequence[str], measures: Sequence[Measure],
                all_label: str = ALL_LABEL) -> DataFrame:
    """The 0-D cell from the fact alone (A11); one row even on empty input."""
    partials = [p for m in measures for p in m.partials]
    return (fact.agg(*partials)
                .select(*[F.lit(all_label).alias(d) for d in dims],
                        *[m.final for m in measures]))


def cube(df: DataFrame, dims: Sequence[str] = CUBE_DIMENSIONS,
         measures: Sequence[Measure] | None = None, all_label: str = ALL_LABEL,
         slice_names: dict | None = None, matched: Column | None = None) -> DataFrame:
    """Every grouping set of ``dims`` and the grand total from ONE scan, labelled.

    ``df`` is the fact joined (left) to its dimensions; ``matched`` is true
    for rows whose keys all resolved (default: every row). It is aggregated
    to its cells first; see :func:`cube_of_cells`.
    """
    measures = list(measures or cube_measures())
    flag = matched if matched is not None else F.lit(True)
    cells = (df.withColumn("__matched", F.coalesce(flag, F.lit(False))).groupBy(*dims, "__matched")
             .agg(*[p for m in measures for p in m.partials]))
    return cube_of_cells(cells, dims, measures, all_label, slice_names)


def cube_of_cells(cells: DataFrame, dims: Sequence[str], measures: Sequence[Measure],
                  all_label: str = ALL_LABEL, slice_names: dict | None = None) -> DataFrame:
    """The cube over cells: ``dims``, ``__matched`` and the measures' partials.

    The grouping sets with at least one dimension cover matched cells only,
    as inner joins would; the grand total covers every cell (an unresolved
    key still counts).

    On empty input an aggregate has no groups, but the grand total must
    still be one row (sums NULL, count 0): one neutral cell, unmatched and
    without any value, joins the cells, so the grand total always exists.

    Columns: ``slice`` (the set's name), ``grouping_id`` (bit i set when
    dims[i] is rolled up, first dimension most significant), the dims with
    'All' where rolled up (a real NULL member stays NULL), the measures.
    """
    dims = list(dims)
    names = SLICE_NAMES if slice_names is None and dims == CUBE_DIMENSIONS else slice_names
    flag, merged = "__matched", merged_measures(measures)
    keys = [key for m in measures for key, _ in m.parts]
    cells = cells.select(*dims, flag, *keys)
    types = {f.name: f.dataType for f in cells.schema.fields}
    neutral = cells.sparkSession.range(1).select(
        *[F.lit(None).cast(types[d]).alias(d) for d in dims], F.lit(False).alias(flag),
        *[F.lit(0 if k.endswith("__n") else None).cast(types[k]).alias(k) for k in keys])
    sets = [list(c) + [flag] for k in range(len(dims), 0, -1) for c in combinations(dims, k)]
    agg = cells.unionByName(neutral).groupingSets(sets + [[]], *dims, flag).agg(
        *[p for m in merged for p in m.partials],
        *[F.grouping(d).alias(f"__rolled_{d}") for d in dims])
    gid = sum((F.col(f"__rolled_{d}") * F.lit(1 << (len(dims) - 1 - i))
               for i, d in enumerate(dims)), F.lit(0))
    full = (1 << len(dims)) - 1
    slice_col = F.lit(_slice_name(tuple(dims), dims, names))
    for k in range(len(dims)):
        for rolled in combinations(dims, k):
            code = sum(1 << (len(dims) - 1 - dims.index(d)) for d in rolled)
            slice_col = F.when(gid == code,
                               F.lit(_slice_name(rolled, dims, names))).otherwise(slice_col)
    return agg.where(F.coalesce(F.col(flag), F.lit(False)) | (gid == full)).select(
        slice_col.alias("slice"), gid.cast("bigint").alias("grouping_id"),
        *[F.when(F.col(f"__rolled_{d}") == 1, F.lit(all_label)).otherwise(F.col(d)).alias(d)
          for d in dims],
        *[m.final for m in merged])


def star_cells(star, measures: Sequence[Measure], facts: DataFrame | None = None,
               products: Sequence[str] = ("product_name", "package_size")) -> DataFrame:
    """A star's cells: the measures' partials by (month_id, product_id), named, with ``__matched``.

    The fact (or some ``facts`` of it) is aggregated before anything is joined; the dimensions are
    left-joined to those cells, so that unresolved facts are kept, unmatched.
    """
    months = star.dim("dim_month").select("month_id", "month_name", F.lit(True).alias("__m"))
    members = star.dim("dim_product").select("product_id", *products, F.lit(True).alias("__p"))
    cells = ((star.measures if facts is None else facts).groupBy("month_id", "product_id")
             .agg(*[p for m in measures for p in m.partials])
             .join(months, "month_id", "left").join(members, "product_id", "left"))
    matched = F.coalesce(F.col("__m"), F.lit(False)) & F.coalesce(F.col("__p"), F.lit(False))
    return cells.withColumn(MATCHED, matched)


def star_cube(star, measures: Sequence[Measure] | None = None) -> DataFrame:
    """The month x product x size cube of a star.

    It comes from :func:`star_cells`. The slices with a dimension keep the cells whose month and
    product both resolved, as the reference's inner joins do; the grand total keeps every cell.
    """
    measures = list(measures or cube_measures(star.spec))
    return cube_of_cells(star_cells(star, measures), CUBE_DIMENSIONS, measures, star.spec.all_label)


# Slices by one dimension other than the month come by revenue, the others by their members.
REVENUE_ORDER = (["product_name"], ["package_size"])


def cube_slice(joined: DataFrame, fact: DataFrame, keep: Sequence[str],
               dims: Sequence[str] = CUBE_DIMENSIONS, measures: Sequence[Measure] | None = None,
               all_label: str = ALL_LABEL) -> DataFrame:
    """One slice of the cube on its own: group by ``keep``, 'All' for the rest."""
    measures = list(measures or cube_measures())
    if not keep:
        return grand_total(fact, dims, measures, all_label)
    out = roll_up(joined, list(keep), measures)
    out = out.select(*[F.col(d) if d in keep else F.lit(all_label).alias(d) for d in dims],
                     *[m.name for m in measures])
    members = [F.col(d).asc_nulls_first() for d in keep]
    if list(keep) in REVENUE_ORDER:
        return out.orderBy(F.desc(measures[0].name), *members)
    return out.orderBy(*members)
