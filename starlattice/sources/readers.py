"""Readers (S1-S8): lazy scans with explicit schemas where given.

Every reader returns a DataFrame without running a job, except
:func:`first_existing`, which only resolves file listings.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.text import path_leaf_dir
from ..operators.clean import MONTHLY_COLUMNS

STAR_TABLES = ["dim_date", "dim_product", "dim_month", "fact_sales",
               "summary_monthly", "summary_product"]


def _reader(spark: SparkSession, fmt: str, schema: StructType | str | None, options: dict | None):
    r = spark.read.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    for k, v in (options or {}).items():
        r = r.option(k, v)
    return r


def read_transactions(spark: SparkSession, path: str | Sequence[str], schema=None,
                      fmt: str = "parquet", options: dict | None = None,
                      lineage: bool = True) -> DataFrame:
    """The core transaction sheet (S1). ``lineage`` adds ``_src``, a per-row hash of
    the file and the row's place, used only to split ties. Parquet tells a row's
    place in its file; for text formats it is the place within the scan's task."""
    paths = [path] if isinstance(path, str) else list(path)
    df = _reader(spark, fmt, schema, options).load(paths)
    if lineage:
        place = F.col("_metadata.row_index") if fmt == "parquet" else F.monotonically_increasing_id()
        df = df.select("*", F.xxhash64(F.col("_metadata.file_path"), place).alias("_src"))
    return df


def read_catalogue(spark: SparkSession, path: str, schema=None, fmt: str = "parquet",
                   options: dict | None = None, title_rows: Callable | None = None) -> DataFrame:
    """The product catalogue (S2), with ``_row`` giving the row order.

    ``title_rows`` is a predicate on the raw rows marking leading title or
    header rows to drop (e.g. a CSV whose header sits on the second line).
    """
    df = _reader(spark, fmt, schema, options).load(path)
    if fmt == "parquet":
        order = F.struct(F.col("_metadata.file_path"), F.col("_metadata.row_index"))
    else:
        order = F.struct(F.input_file_name(), F.monotonically_increasing_id())
    df = df.select("*", order.alias("_row"))
    if title_rows is not None:
        df = df.where(~title_rows(df))
    return df


def read_monthly(spark: SparkSession, paths: Sequence[str], schema=None,
                 fmt: str = "parquet", options: dict | None = None,
                 title_rows: Callable | None = None,
                 names: Sequence[str] = MONTHLY_COLUMNS) -> DataFrame:
    """All monthly sheets, named by position and united.

    Sheets need not agree on their headers: each one is read by itself, must
    have ``names`` many columns, and takes these names before the union.
    ``sheet`` is the name of the folder holding each file (a ``key=value``
    folder gives the value), taken from the scan's file metadata.
    ``title_rows`` drops leading title/header lines of text sources.
    """
    def one(path: str) -> DataFrame:
        df = _reader(spark, fmt, schema, options).load(path)
        columns = df.columns
        if len(columns) != len(names):
            raise ValueError(f"{path}: expected {len(names)} columns, found {len(columns)}: {columns}")
        df = df.select("*", path_leaf_dir(F.col("_metadata.file_path")).alias("__sheet"))
        if title_rows is not None:
            df = df.where(~title_rows(df))
        return df.toDF(*names, "sheet")
    return reduce(DataFrame.unionByName, [one(p) for p in paths])


def first_existing(spark: SparkSession, paths: Sequence[str],
                   read: Callable[[SparkSession, str], DataFrame]) -> DataFrame:
    """Default path, then fall-backs; a clear error naming all paths."""
    for p in paths:
        try:
            df = read(spark, p)
            df.schema  # resolves the listing; fails fast for a missing path
            return df
        except AnalysisException as exc:
            if "PATH_NOT_FOUND" not in str(exc) and "Path does not exist" not in str(exc):
                raise
    raise FileNotFoundError("no source found; checked:\n" + "\n".join(f"  - {p}" for p in paths))


def list_sources(spark: SparkSession, path: str) -> DataFrame:
    """Files under ``path`` with their folder name and size (S6), distributed."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .load(path).select("path", "length"))
    return files.select(path_leaf_dir(F.col("path")).alias("source"), "path", "length")


def read_star(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Open the six star tables of the current build (S7); fail if absent."""
    from ..sinks.writers import current_build
    build = current_build(spark, root)
    return {t: spark.read.parquet(f"{build}/{t}") for t in STAR_TABLES}


def read_bundle(spark: SparkSession, path: str, schema) -> DataFrame:
    """Read exported JSON back with an explicit schema."""
    return spark.read.schema(schema).json(path)
