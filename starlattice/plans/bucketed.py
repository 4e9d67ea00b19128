"""Fact and a large dimension bucketed alike, so that their join moves no fact.

A dimension above the broadcast budget makes every lookup shuffle the fact. Here both are stored once as tables
bucketed by the key, and later joins read bucket against bucket. A key that holds more facts than a bucket should
(one product with a third of all sales) would make one bucket, and one task, huge; adaptive execution cannot split a
bucket. So such keys are salted when the tables are written: their facts are dealt over as many salts as they would
fill buckets, and their dimension rows are repeated once per salt. A key is hot beyond rows / buckets, hence there are
fewer hot keys than buckets, and fewer than twice as many repeated rows: both bounds hold whatever the data. Facts without a key are dealt over
all salts too; they match nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import job_label, materialize, scratch_path
from .star import FACT_ROW_BYTES

SALT = "__salt"
BUCKET_BYTES = 256 * 1024 * 1024


@dataclass(frozen=True)
class BucketSpec:
    buckets: int
    columns: tuple[str, ...]


def bucket_spec(spark: SparkSession, table: str) -> BucketSpec | None:
    """How the catalog says that ``table`` is bucketed, or None."""
    said = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    if not said.get("Num Buckets"):
        return None
    columns = said["Bucket Columns"].strip("[]").split(",")
    return BucketSpec(int(said["Num Buckets"]), tuple(c.strip().strip("`") for c in columns))


def hot_keys(fact: DataFrame, key: str, rows: int, buckets: int) -> DataFrame:
    """(key, salts) of the keys with more facts than rows / buckets: fewer than ``buckets`` rows."""
    fair = max(1, -(-rows // buckets))
    counts = fact.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("hot")).agg(F.count(F.lit(1)).alias("n"))
    return materialize(counts.where(F.col("n") > fair).select("hot", F.ceil(F.col("n") / fair).cast("int").alias("salts")), "hot-keys")


def _write(df: DataFrame, table: str, keys: list[str], buckets: int) -> None:
    with job_label(df.sparkSession, f"write {table}"):
        # dealt as the buckets are, so each bucket is one file
        (df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys)
         .option("path", scratch_path(df.sparkSession, table)).saveAsTable(table))


@dataclass
class Bucketed:
    """Tables ``fact`` and ``dimension`` of the session catalog, bucketed by ``key`` and a salt."""

    star: object
    fact: str
    dimension: str
    key: str

    def join(self, columns: list[str] | None = None, how: str = "inner") -> DataFrame:
        """Facts with the dimension's columns; checks in the catalog that the tables still fit each other."""
        spark = self.star.spark
        specs = {bucket_spec(spark, t) for t in (self.fact, self.dimension)}
        if len(specs) != 1 or None in specs or specs.copy().pop().columns != (self.key, SALT):
            raise ValueError(f"{self.fact} and {self.dimension} are not bucketed alike by {self.key}")
        side = spark.table(self.dimension)
        if columns is not None:
            side = side.select(self.key, SALT, *columns)
        return spark.table(self.fact).join(side.hint("merge"), [self.key, SALT], how).drop(SALT)


def write_bucketed(star, dimension: str = "dim_product", key: str = "product_id", buckets: int | None = None,
                   name: str = "star") -> Bucketed:
    """Store the fact and ``dimension`` bucketed by ``key``, as tables ``<name>_fact`` and ``<name>_<dimension>``."""
    spark, fact = star.spark, star.fact
    rows = fact.count()
    if buckets is None:
        buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows * FACT_ROW_BYTES // BUCKET_BYTES))
    hot = hot_keys(fact, key, rows, buckets)
    dealt = (fact.join(F.broadcast(hot), fact[key] == hot["hot"], "left")
             .withColumn(SALT, F.when(F.col(key).isNull(), F.pmod(F.col("sales_id"), F.lit(buckets)))
                         .when(F.col("salts").isNotNull(), F.pmod(F.col("sales_id"), F.col("salts"))).otherwise(0).cast("int"))
             .drop("hot", "salts"))
    members = getattr(star, dimension)
    repeated = (members.join(F.broadcast(hot), members[key] == hot["hot"], "left")
                .withColumn(SALT, F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)))
                .drop("hot", "salts"))
    out = Bucketed(star, f"{name}_fact", f"{name}_{dimension}", key)
    _write(dealt, out.fact, [key, SALT], buckets)
    _write(repeated, out.dimension, [key, SALT], buckets)
    return out
