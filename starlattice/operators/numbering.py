"""Distributed surrogate keys: 1..n in a total order, no single partition.

``row_number()`` over an unpartitioned window moves every row into one
task. Instead the rows are range-partitioned on the order keys (the
partitioner samples, so a hot leading key such as one busy date is split
on the following keys), sorted inside each partition, and numbered by
(partition, position). The positions are written once under the
checkpoint root, so a retried task can never renumber rows. Partition
offsets are a running sum over at most ``partitions`` counts - a table
whose size is bounded by the partition count, so it is broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

_PART, _POS, _OFF, _N = "__part", "__pos", "__off", "__n"


def sequential_ids(df: DataFrame, order: Sequence[Column], id_col: str, start: int = 1,
                   partitions: int | None = None, name: str = "ids",
                   keep: dict | None = None) -> DataFrame:
    """Add ``id_col`` = start .. start+n-1 following ``order``.

    Rows equal in every order key get adjacent ids in an unspecified order;
    add a lineage column as the last key to make the order total.

    When ``keep`` is given, ``keep["rows"]`` receives the written rows
    without ids, for readers that do not need them (no offsets join).
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (df.repartitionByRange(n, *order)
                .sortWithinPartitions(*order)
                .withColumn(_PART, F.spark_partition_id())
                .withColumn(_POS, F.monotonically_increasing_id()
                            - F.col(_PART).cast("long") * F.lit(1 << 33)))
    pinned = materialize(ranged, name)
    if keep is not None:
        keep["rows"] = pinned.select(*df.columns)
    counts = pinned.groupBy(_PART).agg(F.count(F.lit(1)).alias(_N))
    if keep is not None:
        keep["partition_rows"] = counts.select(F.col(_PART).alias("partition"),
                                               F.col(_N).alias("rows"))
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = materialize(
        counts.select(_PART, F.coalesce(F.sum(_N).over(before), F.lit(0)).alias(_OFF)),
        f"{name}-offsets")
    numbered = pinned.join(F.broadcast(offsets), _PART)
    ident = (F.col(_OFF) + F.col(_POS) + F.lit(start)).cast("bigint").alias(id_col)
    return numbered.select(ident, *[c for c in df.columns])
