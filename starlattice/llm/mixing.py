"""Operator 8, mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in a shuffled order (by the MD5 of the doc_id, so that
reruns agree); a queue may be served up to ``cap`` times over. Each document gets virtual start and
finish times: the source's words before it, or up to its end, over the source's target. Sorted by
finish time over all sources, the queue is served until the total budget is used up. As the targets
add up to the budget, that is virtual time 1: a document finishing by then is taken whole, one that
is being served when the budget ends is taken in part, so a source misses its target by less than a
word.

Targets: the weights 5, 2, 1 repeat over the sources in code-point order, null last. A target stops at
``cap`` times its source's words and the excess is shared again by weight; the closed form sorts
the sources by cap over weight and finds the level at which the rest of the budget is spent.

Running totals never need one ordered pass: a source is cut into buckets by its shuffle key, in
proportion to its rows, buckets are summed first, and the totals inside a bucket start from the sum
of the buckets before. So a source with a third of all rows spreads like any other. Rows of one source
that are alike in key, doc_id and size are one row with a count until their totals are known, and then
come apart in portions that are dealt anew; so a doc_id that repeats in very many rows spreads too.

Defined results: null text has size 0 and is taken 0; a null source is a source of its own; null
doc_ids are shuffled by their text. Repeated rows are documents of their
own. An empty table gives an empty table. A source without words has target 0 and no finish time.
Only doc_id, text and source are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starlattice.llm.common import materialize, text_or_empty

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2
BUCKET_ROWS = 2_000
WORD = r"[^\x20\x09-\x0D]+"


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """(source, source_size, rows, target) from rows (source, size, copies).

    The windows below order the sources themselves - one row each, not the documents.
    """
    per = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size"), F.sum("copies").alias("rows"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    per = (per.withColumn("rank", rank)
           .withColumn("w", F.element_at(F.array(*[F.lit(w) for w in weights]),
                                         ((F.col("rank") - 1) % len(weights) + 1).cast("int")))
           .withColumn("most", F.lit(cap) * F.col("source_size")))
    level = Window.orderBy(F.col("most") / F.col("w"), "rank")
    before, rest = level.rowsBetween(Window.unboundedPreceding, -1), level.rowsBetween(0, Window.unboundedFollowing)
    everything = level.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    budget = F.lit(share) * F.sum("source_size").over(everything)
    left = budget - F.coalesce(F.sum("most").over(before), F.lit(0))
    per = (per.withColumn("level", left / F.sum("w").over(rest))
           .withColumn("full", F.col("level") * F.col("w") >= F.col("most")))
    # the first source that is not full fixes the level of all that follow
    fixed = F.min(F.when(~F.col("full"), F.struct(F.col("most") / F.col("w"), "rank", "level"))).over(everything)
    return (per.withColumn("fixed", fixed)
            .select("source", "source_size", "rows",
                    F.when(F.col("full"), F.col("most").cast("double"))
                    .otherwise(F.col("fixed.level") * F.col("w")).alias("target")))


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: int = CAP,
        bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Per document, in the order of service: doc_id, source, size, source_size, target,
    virtual_finish (of its first copy) and taken."""
    sized = materialize(
        docs.select("doc_id", "source",
                    F.regexp_count(text_or_empty(), F.lit(WORD)).cast("long").alias("size"),
                    F.md5(F.coalesce(F.col("doc_id").cast("string"), text_or_empty())).alias("key"))
        .groupBy("source", "key", "doc_id", "size").agg(F.count(F.lit(1)).alias("copies")),
        "mix-sizes")
    targets = materialize(source_targets(sized, weights, share, cap)
                          .withColumnRenamed("source", "__source"), "mix-targets")
    spot = F.conv(F.substring("key", 1, 8), 16, 10).cast("long") / F.lit(2.0 ** 32)
    rows = (sized.join(targets, sized["source"].eqNullSafe(targets["__source"]))
            .withColumn("bucket", F.floor(spot * F.ceil(F.col("rows") / F.lit(bucket_rows)))))
    words = F.sum(F.col("size") * F.col("copies"))
    sums = rows.groupBy("__source", "bucket").agg(words.alias("words"))
    offsets = materialize(
        sums.select(F.col("__source").alias("of_source"), F.col("bucket").alias("of_bucket"),
                    F.coalesce(F.sum("words").over(
                        Window.partitionBy("__source").orderBy("bucket")
                        .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("offset")),
        "mix-offsets")
    inside = (Window.partitionBy("__source", "bucket").orderBy("key", "doc_id", "size")
              .rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("inside", F.coalesce(words.over(inside), F.lit(0)))
    rows = rows.join(offsets, rows["__source"].eqNullSafe(offsets["of_source"])
                     & (rows["bucket"] == offsets["of_bucket"]))
    # rows that are alike come apart: portions of them first, which any task may take
    rows = (rows.withColumn("portion", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(bucket_rows).cast("long"))))
            .repartition("key", "doc_id", "size", "portion")
            .withColumn("nth", F.explode(F.sequence("portion", F.least(F.col("portion") + bucket_rows, "copies") - 1))))
    start = F.col("offset") + F.col("inside") + F.col("nth") * F.col("size")
    until = F.floor(F.col("target"))
    served = [F.greatest(F.lit(0), F.least(F.col("size"), until - (F.col("source_size") * copy + start)))
              for copy in range(cap)]
    return (rows.select("doc_id", "source", "size", "source_size", "target",
                        F.when(F.col("target") > 0, (start + F.col("size")) / F.col("target"))
                        .alias("virtual_finish"),
                        sum(served[1:], served[0]).alias("taken"), "key", "nth")
            .orderBy(F.col("virtual_finish").asc_nulls_last(), "key", "doc_id", "nth")
            .drop("key", "nth"))
