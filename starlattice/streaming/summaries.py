"""Keep Summary_Monthly current from arriving raw sheet files.

The reference rebuilds everything in a full refresh and has no stream.
This job is the incremental form of the same summary: new raw files are
read as a file stream, cleaned by the same operator as the batch build,
keyed against the (static, broadcast) dimensions, and folded into
per-month state. The state holds only additive partials - exact decimal
sums, the basis-point sum and count of the margin - so the mean margin is
finished correctly after every micro-batch, never averaged from averages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..operators.clean import clean_transactions
from ..operators.fact import fact_rows, lookup_keys
from ..plans.growing import append_batch, open_growing
from ..plans.star import summary_measures
from ..session import scratch_path
from ..sinks.writers import current_build, switch_build
from ..spec import DEFAULT_SPEC, StarSpec


def monthly_summary_stream(spark: SparkSession, source: str, schema: StructType, star,
                           sink: str, checkpoint: str | None = None,
                           files_per_batch: int | None = None):
    """Start the stream; every micro-batch publishes the full summary under ``sink``.

    Uses the ``availableNow`` trigger: all files present are processed (in
    several micro-batches when ``files_per_batch`` is set) and the query
    stops. Returns the ``StreamingQuery``.
    """
    spec = star.spec
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    master = clean_transactions(reader.parquet(source), spec)
    keyed = lookup_keys(master, star.dim_date, star.dim_product, star.dim_month, star.rows, spec)
    months = star.dim("dim_month").select("month_id", "month_name", "year")
    joined = fact_rows(keyed, spec).drop("_src").join(months, "month_id")
    keys = ["month_id", "month_name", "year"]
    measures = summary_measures(spec)
    state = joined.groupBy(*keys).agg(*[p for m in measures for p in m.partials])
    summary = state.select(*keys, *[m.final for m in measures])

    def publish(batch: DataFrame, epoch: int) -> None:
        # an epoch's own folder, then the pointer: a reader never meets a half-written summary
        batch.write.mode("overwrite").parquet(f"{sink}/epoch-{epoch}")
        switch_build(spark, sink, f"epoch-{epoch}")

    return (summary.writeStream.outputMode("complete")
            .option("checkpointLocation", checkpoint or scratch_path(spark, "stream-checkpoint"))
            .foreachBatch(publish)
            .trigger(availableNow=True)
            .start())


def run_monthly_summary(spark: SparkSession, source: str, star,
                        files_per_batch: int | None = 2) -> DataFrame:
    """Run the stream to completion over ``source`` and read the summary back."""
    schema = spark.read.parquet(source).schema
    sink = scratch_path(spark, "stream-summary-monthly")
    query = monthly_summary_stream(spark, source, schema, star, sink,
                                   files_per_batch=files_per_batch)
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return spark.read.parquet(current_build(spark, sink))


def stream_star(spark: SparkSession, source: str, catalogue_raw: DataFrame, root: str, spec: StarSpec = DEFAULT_SPEC,
                checkpoint: str | None = None, files_per_batch: int | None = 2):
    """Feed the growing star under ``root`` from raw files as they arrive; returns the ``StreamingQuery``.

    Every micro-batch is a batch of the star, named by its epoch, so one that is run again after a failure
    is loaded once. New dates, products and months get their keys as they come: no sale is lost to a
    dimension that did not know its month.
    """
    reader = spark.readStream.schema(spark.read.parquet(source).schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return (reader.parquet(source).writeStream
            .option("checkpointLocation", checkpoint or scratch_path(spark, "stream-checkpoint"))
            .foreachBatch(lambda batch, epoch: append_batch(spark, root, batch, catalogue_raw, f"epoch-{epoch}", spec))
            .trigger(availableNow=True)
            .start())


def run_stream_star(spark: SparkSession, source: str, catalogue_raw: DataFrame, spec: StarSpec = DEFAULT_SPEC,
                    files_per_batch: int | None = 2):
    """Run :func:`stream_star` to completion over ``source`` and open the star it left."""
    root = scratch_path(spark, "stream-star")
    query = stream_star(spark, source, catalogue_raw, root, spec, files_per_batch=files_per_batch)
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return open_growing(spark, root, spec)


__all__ = ["run_stream_star", "stream_star", "monthly_summary_stream", "run_monthly_summary"]
