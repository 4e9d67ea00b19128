"""Sheets exported as CSV whose header stands below title lines.

A large text file is read in blocks, and no block knows how many lines lie before it, so "the header is the
third line" cannot be told from a row alone. Here every line gets its place in its file:

1. the lines are written once with their file, the start of their block and their order inside the task;
2. lines are counted by block, and running sums over a file's blocks give each block's first line;
3. the place of a line is its block's first line plus its place inside the block.

A file is never read by one task, unless it is compressed in a way that cannot be split. The table of blocks has a row per block of up to
``spark.sql.files.maxPartitionBytes``; it is broadcast only behind a check of its size. Records must not contain
line breaks, as in any CSV file that is read in blocks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import path_leaf_dir
from ..operators.clean import CORRUPT_COLUMN
from ..session import materialize
from ..spec import DEFAULT_SPEC, StarSpec

BYTE_ORDER_MARK = "\ufeff"


def numbered_lines(spark: SparkSession, paths: str | Sequence[str], spec: StarSpec = DEFAULT_SPEC) -> DataFrame:
    """(file, line_no, line) of text files; line_no counts all lines of a file from 0."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    lines = materialize(spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), F.col("value").alias("line")), "sheet-lines", compression="zstd")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = materialize(
        lines.groupBy("file", "block").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
        .select("file", "block", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift")),
        "sheet-blocks")
    size = blocks.agg(F.count(F.lit(1)).alias("n"), F.max(F.octet_length("file")).alias("width")).first()
    if size["n"] * ((size["width"] or 0) + 48) <= spec.broadcast_max_bytes:
        blocks = F.broadcast(blocks)
    return lines.join(blocks, ["file", "block"]).select("file", (F.col("at") + F.col("shift")).alias("line_no"), "line")


def read_sheets(spark: SparkSession, paths: str | Sequence[str], names: Sequence[str], title_lines: int = 0,
                options: dict | None = None, keep_corrupt: bool = False, spec: StarSpec = DEFAULT_SPEC) -> DataFrame:
    """CSV sheets as text columns ``names``, taken by position, with ``sheet`` and ``_row`` (file and line).

    ``title_lines`` lines stand above the header line in every file; they and the header are left out, wherever
    the file is split. All sheets are one scan, whatever their number and headers. A header with another
    number of fields raises and names the file. Blank lines below the header are no rows. A row with another number of fields raises
    too, unless ``keep_corrupt`` keeps it with its text in ``_corrupt_record``.
    """
    lines = numbered_lines(spark, paths, spec)
    text = F.when((F.col("line_no") == 0) & F.startswith("line", F.lit(BYTE_ORDER_MARK)), F.expr("substring(line, 2)")).otherwise(F.col("line"))
    fields = ", ".join(f"`{n}` string" for n in [*names, CORRUPT_COLUMN])
    # more or fewer fields than names make a record corrupt
    parsed = F.from_csv(text, F.lit(fields), {**(options or {}), "columnNameOfCorruptRecord": CORRUPT_COLUMN})
    rows = lines.where(F.col("line_no") >= title_lines).withColumn("__cells", parsed)
    wrong = F.col(f"__cells.{CORRUPT_COLUMN}").isNotNull()
    refused = lambda what: F.raise_error(F.concat(
        F.lit(f"{what} does not have {len(names)} fields: "), "file", F.lit(" line "), F.col("line_no") + 1)).cast("boolean")
    data = F.lit(True) if keep_corrupt else F.when(wrong, refused("row")).otherwise(True)
    # the tests name their lines themselves: filters are merged and have no order
    rows = rows.where(F.when((F.col("line_no") > title_lines) & (F.trim("line") != ""), data)
                      .when((F.col("line_no") == title_lines) & wrong, refused("header")).otherwise(False))
    cells = [F.col(f"__cells.`{n}`").alias(n) for n in [*names, *([CORRUPT_COLUMN] if keep_corrupt else [])]]
    return rows.select(*cells, path_leaf_dir(F.col("file")).alias("sheet"), F.struct("file", "line_no").alias("_row"))
