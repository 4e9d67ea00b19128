"""Writers (K1-K4): the star as Parquet, exports as JSON.

``write_star`` never overwrites the tables a reader may be using: each
build goes to its own folder, and a one-row pointer of its own is written
last. The newest pointer names the current build, and no pointer is ever
overwritten, so a failure part-way leaves the previous build current.
The fact is partitioned by month for partition pruning of slices.
"""

from __future__ import annotations

import time
import uuid
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import job_label

STAR_TABLES = ["dim_date", "dim_product", "dim_month", "fact_sales",
               "summary_monthly", "summary_product"]
# Key order of each table in exports (summary_product: revenue descending).
EXPORT_ORDER = {
    "dim_date": [("date_id", "asc")],
    "dim_product": [("product_id", "asc")],
    "dim_month": [("month_id", "asc")],
    "fact_sales": [("sales_id", "asc")],
    "summary_monthly": [("month_id", "asc")],
    "summary_product": [("total_revenue", "desc"), ("product_id", "asc")],
}


def _pointers(root: str) -> str:
    return f"{root.rstrip('/')}/pointers"


def write_star(star, root: str, partition_fact_by_month: bool = True) -> str:
    """Write the six tables into a new build folder, then switch the pointer."""
    from ..plans.star import both_summaries
    spark = star.spark
    name = f"build-{uuid.uuid4().hex}"
    build = f"{root.rstrip('/')}/{name}"
    star.fact  # numbered and written first, so the summaries read the written fact
    with job_label(spark, "summaries"):
        monthly, product = both_summaries(star)
    tables = {"summary_monthly": monthly, "summary_product": product}
    for table in STAR_TABLES:
        df = tables[table] if table in tables else star.table(table)
        writer = df.write.mode("errorifexists")
        if table == "fact_sales" and partition_fact_by_month:
            writer = writer.partitionBy("month_id")
        with job_label(spark, f"write {table}"):
            writer.parquet(f"{build}/{table}")
    switch_build(spark, root, name)
    return build


def switch_build(spark: SparkSession, root: str, name: str) -> None:
    """Make ``name`` (a folder under ``root``) the current build."""
    now = time.time_ns()
    pointer = spark.range(1).select(F.lit(now).alias("at"), F.lit(name).alias("build"))
    with job_label(spark, "switch current build"):
        pointer.write.mode("errorifexists").json(f"{_pointers(root)}/{now}-{name}")


def current_build(spark: SparkSession, root: str) -> str:
    """The folder of the current build; fails when the star was never built."""
    try:
        pointers = spark.read.schema("at bigint, build string").json(f"{_pointers(root)}/*")
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        raise FileNotFoundError(f"no star built under {root}; run the build first") from exc
    rows = pointers.orderBy(F.desc("at")).take(1)
    if not rows:
        raise FileNotFoundError(f"no star built under {root}; run the build first")
    return f"{root.rstrip('/')}/{rows[0].build}"


def export_tables(tables: dict[str, DataFrame], path: str) -> dict[str, str]:
    """Each table as JSON in key order; NULLs kept as JSON nulls (K2)."""
    out = {}
    for name, df in tables.items():
        target = f"{path.rstrip('/')}/{name}"
        order = [F.desc(c) if d == "desc" else F.asc(c) for c, d in EXPORT_ORDER.get(name, [])]
        (df.orderBy(*order) if order else df).write.mode("overwrite") \
            .option("ignoreNullFields", "false").json(target)
        out[name] = target
    return out


def export_queries(bundle: list[dict], path: str) -> DataFrame:
    """Each query's result as JSON plus a metadata table (K3).

    ``bundle`` items: {id, title, description, sql, df}. Returns the metadata
    (id, title, description, sql, rows), read back; the rows are those of the
    written files, so no query runs twice.
    """
    metas = []
    for item in bundle:
        target = f"{path.rstrip('/')}/{item['id']}"
        item["df"].write.mode("overwrite").option("ignoreNullFields", "false").json(target)
        back = item["df"].sparkSession.read.schema(item["df"].schema).json(target)
        metas.append(back.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(item["id"]).alias("query_id"), F.lit(item["title"]).alias("title"),
            F.lit(item["description"]).alias("description"), F.lit(item["sql"]).alias("sql"),
            "rows"))
    meta = reduce(DataFrame.unionByName, metas)
    meta.write.mode("overwrite").json(f"{path.rstrip('/')}/_queries")
    return meta.sparkSession.read.schema(meta.schema).json(f"{path.rstrip('/')}/_queries")


def export_cube(cube: DataFrame, path: str) -> DataFrame:
    """The cube as JSON partitioned by slice (K4); the written cube, read back."""
    target = f"{path.rstrip('/')}/slices"
    cube.write.mode("overwrite").partitionBy("slice").option("ignoreNullFields", "false").json(target)
    return cube.sparkSession.read.schema(cube.schema).json(target)


def export_metadata(metadata: DataFrame, path: str) -> DataFrame:
    """The cube's one-row metadata beside its slices; read back."""
    target = f"{path.rstrip('/')}/metadata"
    metadata.write.mode("overwrite").json(target)
    return metadata.sparkSession.read.schema(metadata.schema).json(target)


def export_dashboard(datasets: dict[str, DataFrame], path: str) -> dict[str, DataFrame]:
    """Every dataset of the dashboard as JSON, each written once; the written ones, read back."""
    out = {}
    for name, df in datasets.items():
        order = [F.desc(c) if d == "desc" else F.asc(c) for c, d in EXPORT_ORDER.get(name, [])]
        target = f"{path.rstrip('/')}/{name}"
        (df.orderBy(*order) if order else df).write.mode("overwrite") \
            .option("ignoreNullFields", "false").json(target)
        out[name] = df.sparkSession.read.schema(df.schema).json(target)
    return out
