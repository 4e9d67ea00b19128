"""A fact laid out by several dimensions at once (P8, P9): bit-interleaved keys, file ranges, skipped files.

A fact partitioned by month serves a slice of a month; a dice on product and size reads every file of its months. Here:

* **Codes.** The members of each dimension column are numbered in order and spread over ``bits`` bits, 0 standing
  for facts whose key did not resolve. More members than codes share codes.
* **Order.** The codes' bits are interleaved to one key (Z-order) and the fact is range-partitioned and sorted by it,
  then by ``sales_id``, so a cell that holds a third of all facts still spreads over files.
* **Ranges.** A table keeps every file's least and greatest code of each column.
* **Dice.** The members asked for become codes; files whose ranges hold none of them are not opened, the codes
  are pushed to the Parquet row groups of the rest, and the members themselves decide about each row. So the layout
  decides what is read, never a result.

What reaches the driver is the codes of the members asked for and the paths of the files that may match.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import dim_side
from ..operators.numbering import sequential_ids
from ..operators.olap import denormalize, dice
from ..session import job_label
from .star import FACT_ROW_BYTES

#: dimension column -> the dimension table that holds it
LAYOUT_COLUMNS = {"month_name": "dim_month", "product_name": "dim_product", "package_size": "dim_product"}
KEYS = {"dim_date": "date_id", "dim_product": "product_id", "dim_month": "month_id"}
FILE_BYTES = 128 * 1024 * 1024
MAX_BITS = 16


def interleaved(codes: Sequence[Column], bits: int) -> Column:
    """One bigint from the lowest ``bits`` bits of each code: bit b of code j becomes bit b * len(codes) + j."""
    if bits * len(codes) > 62:
        raise ValueError(f"{len(codes)} codes of {bits} bits do not fit a bigint")
    spread = [F.shiftleft(F.shiftright(c.cast("bigint"), b).bitwiseAND(F.lit(1).cast("bigint")), b * len(codes) + j)
              for j, c in enumerate(codes) for b in range(bits)]
    return reduce(Column.bitwiseOR, spread)


def member_codes(dimension: DataFrame, column: str, bits: int) -> tuple[DataFrame, int]:
    """(member, code): the distinct members in order, spread over codes 1 .. 2^bits - 1; and their number."""
    members = dimension.select(F.col(column).alias("member")).distinct()
    ranked = sequential_ids(members, [F.col("member").asc_nulls_first()], "rank", name=f"codes-{column}")
    n = ranked.count()
    room = (1 << bits) - 1
    spread = F.expr(f"CAST(1 + (rank - 1) * {room}L div {max(n, 1)}L AS INT)") if n < room else \
        F.expr(f"CAST(1 + CAST((rank - 1) AS DECIMAL(38,0)) * {room} div {n} AS INT)")
    return ranked.select("member", spread.alias("code")), n


class Layout:
    """A fact laid out under ``root``; see :func:`write_layout`."""

    def __init__(self, star, root: str, columns: dict[str, str]):
        self.star, self.root, self.columns = star, root.rstrip("/"), dict(columns)
        self.spark: SparkSession = star.spark

    def codes(self, column: str, values) -> list[int]:
        """The codes of the members asked for; unknown members have none."""
        values = list(values) if isinstance(values, (list, tuple, set)) else [values]
        table = self.spark.read.parquet(f"{self.root}/codes/{column}")
        return sorted(r["code"] for r in table.where(F.col("member").isin(values)).select("code").distinct().collect())

    @property
    def ranges(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/ranges")

    def _may_match(self, wanted: dict[str, list[int]]) -> Column:
        def test(column: str, codes: list[int]) -> Column:
            ends = F.col(f"least_{column}"), F.col(f"greatest_{column}")
            return F.exists(F.lit(codes).cast("array<int>"), lambda code: code.between(*ends))
        return reduce(Column.__and__, [test(*each) for each in wanted.items()], F.lit(True))

    def read(self, members: dict) -> DataFrame:
        """Facts that may match ``members``, from the files that may hold them."""
        wanted = {c: self.codes(c, v) for c, v in members.items()}
        paths = [r["file"] for r in self.ranges.where(self._may_match(wanted)).select("file").collect()]
        everything = self.spark.read.parquet(f"{self.root}/fact")
        facts = self.spark.read.schema(everything.schema).parquet(*paths) if paths else everything.where(F.lit(False))
        for c, codes in wanted.items():
            facts = facts.where(F.col(f"__code_{c}").isin(codes))
        return facts.drop(*[f"__code_{c}" for c in self.columns])

    def dice(self, members: dict, dims: Sequence[str] = tuple(KEYS)) -> DataFrame:
        """The joined facts of ``members`` (a list means IN), as :func:`starlattice.operators.olap.dice` gives them."""
        unknown = sorted(set(members) - set(self.columns))
        if unknown:
            raise ValueError(f"not columns of this layout: {', '.join(unknown)}")
        return dice(denormalize(self.star, self.read(members), dims), members)

    def files(self, members: dict) -> tuple[int, int]:
        """(files opened for a dice on ``members``, all files)."""
        wanted = {c: self.codes(c, v) for c, v in members.items()}
        row = self.ranges.agg(F.count_if(self._may_match(wanted)).alias("opened"), F.count(F.lit(1)).alias("every")).first()
        return row["opened"], row["every"]


def write_layout(star, root: str, columns: dict[str, str] | None = None, files: int | None = None) -> Layout:
    """Write the star's fact in Z-order of ``columns`` (dimension column -> its table) under a fresh ``root``."""
    columns = dict(LAYOUT_COLUMNS if columns is None else columns)
    spark, root = star.spark, root.rstrip("/")
    bits = min(MAX_BITS, 62 // len(columns))
    fact = star.fact
    by_table: dict[str, list[str]] = {}
    for column, table in columns.items():
        by_table.setdefault(table, []).append(column)
    for table, its in by_table.items():
        key, side = KEYS[table], getattr(star, table)
        side = side.select(key, *its)
        for column in its:
            codes, n = member_codes(side, column, bits)
            with job_label(spark, f"codes of {column}"):
                codes.write.parquet(f"{root}/codes/{column}")
            codes = dim_side(spark.read.parquet(f"{root}/codes/{column}"), n, star.spec)
            side = (side.join(codes, side[column].eqNullSafe(codes["member"]), "left")
                    .withColumn(f"__code_{column}", F.col("code")).drop("member", "code"))
        side = side.select(F.col(key).alias("__key"), *[f"__code_{c}" for c in its])
        fact = fact.join(dim_side(side, star.rows.get(table), star.spec), fact[key] == F.col("__key"), "left").drop("__key")
    fact = fact.select(*star.fact.columns, *[F.coalesce(f"__code_{c}", F.lit(0)).alias(f"__code_{c}") for c in columns])
    if files is None:
        files = max(1, -(-star.fact.count() * FACT_ROW_BYTES // FILE_BYTES))
    z = interleaved([F.col(f"__code_{c}") for c in columns], bits)
    with job_label(spark, "write fact in Z-order"):
        (fact.withColumn("__z", z).repartitionByRange(files, "__z", "sales_id")
         .sortWithinPartitions("__z", "sales_id").drop("__z").write.parquet(f"{root}/fact"))
    stored = spark.read.parquet(f"{root}/fact").select(F.col("_metadata.file_path").alias("file"), *[f"__code_{c}" for c in columns])
    ends = [f(f"__code_{c}").alias(f"{name}_{c}") for c in columns for f, name in ((F.min, "least"), (F.max, "greatest"))]
    with job_label(spark, "file ranges"):
        stored.groupBy("file").agg(F.count(F.lit(1)).alias("rows"), *ends).write.parquet(f"{root}/ranges")
    return Layout(star, root, columns)
