"""Benchmark: the star build (ETL) and the OLAP / analytical queries.

Runs at $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS]
and prints ONE JSON line. The ETL is timed end to end (stage the raw
sheet, clean, dimensions, numbered fact, summaries, write the star); the
queries run over the written star, as the reference's queries run over
its warehouse file, each executed to a no-op sink (one warm-up, then the
median of three runs).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from starlattice.functions.measures import cube_measures, mean_ratio, money_sum  # noqa: E402
from starlattice.operators import analytics as A  # noqa: E402
from starlattice.operators import checks as Q  # noqa: E402
from starlattice.operators import olap as O  # noqa: E402
from starlattice.plans.registry import CALENDAR_MONTHS, DICE_MEMBERS, SLICE_MONTH  # noqa: E402
from starlattice.plans.star import both_summaries, fixture_star, star_from_tables  # noqa: E402
from starlattice.session import get_session, scratch_path  # noqa: E402
from starlattice.sinks.writers import write_star  # noqa: E402
from starlattice.sources.readers import read_star  # noqa: E402


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn, repeats: int = 3) -> float:
    run(fn())
    times = []
    for _ in range(repeats):
        t = time.perf_counter()
        run(fn())
        times.append(time.perf_counter() - t)
    return statistics.median(times)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    partitions = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(cpus)))
    spark = get_session(f"local[{cpus}]", "starlattice-bench", partitions,
                        {"spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")

    # warm-up of the JVM on the smallest scale
    small = os.path.join(os.path.dirname(sf_dir), "sf0.001")
    if os.path.isdir(small):
        warm = fixture_star(spark, small)
        run(warm.fact)

    out: dict[str, float] = {}
    t = time.perf_counter()
    star = fixture_star(spark, sf_dir)
    root = scratch_path(spark, "bench-warehouse")
    write_star(star, root)
    out["etl_star_build"] = time.perf_counter() - t

    s = star_from_tables(read_star(spark, root), star.spec)
    measures = cube_measures(s.spec)

    def cube_join():
        return (s.measures.join(s.dim("dim_month").select("month_id", "month_name"), "month_id")
                .join(s.dim("dim_product").select("product_id", "product_name", "package_size"),
                      "product_id"))

    def eight_scans():
        from functools import reduce
        sets = [["month_name", "product_name", "package_size"], ["month_name", "product_name"],
                ["month_name", "package_size"], ["product_name", "package_size"], ["month_name"],
                ["product_name"], ["package_size"], []]
        parts = [O.cube_slice(cube_join(), s.measures, keep, measures=measures) for keep in sets]
        return reduce(lambda a, b: a.unionByName(b), parts)

    def pivot():
        j = (s.measures.join(s.dim("dim_date").select("date_id", "month_name"), "date_id")
             .join(s.dim("dim_product").select("product_id", "product_name"), "product_id"))
        return O.pivot(j, ["product_name"], "month_name", CALENDAR_MONTHS,
                       mean_ratio("profit_margin", "margin", 2, True),
                       [f"{m.lower()}_margin" for m in CALENDAR_MONTHS])

    stored = read_star(spark, root)

    queries = {
        "cube_one_pass": lambda: O.star_cube(s, measures),
        "cube_eight_group_bys": eight_scans,
        "revenue_by_month": lambda: A.revenue_by_month(s),
        "products_by_revenue": lambda: A.products_by_revenue(s),
        "daily_sales_20": lambda: A.daily_sales(s),
        "margin_by_size": lambda: A.margin_by_size(s),
        "margin_by_month": lambda: A.margin_by_month(s),
        "category_size": lambda: A.category_size(s),
        "best_days": lambda: A.best_days(s),
        "profit_share": lambda: A.profit_share(s),
        "kpis": lambda: A.kpis(s),
        "daily_trend": lambda: A.daily_trend(s),
        "top_records": lambda: A.top_records(s),
        "olap_pivot": pivot,
        "olap_slice": lambda: O.slice_(O.denormalize(s, s.fact, ("dim_month", "dim_product")),
                                       "month_name", SLICE_MONTH),
        "olap_dice": lambda: O.dice(O.denormalize(s), DICE_MEMBERS),
        "summary_monthly_from_fact": lambda: both_summaries(s)[0],
        "summary_monthly_stored": lambda: stored["summary_monthly"],
        "star_join": lambda: O.denormalize(s),
        "check_pk_fact": lambda: Q.check_primary_key(s.fact, "sales_id", "fact_sales"),
        "reconcile": lambda: Q.reconcile(s),
        "rollup_month": lambda: O.roll_up(
            s.measures.join(s.dim("dim_month").select("month_id", "month_name"), "month_id"),
            ["month_name"], [money_sum("revenue", "total_revenue", None)]),
    }
    failed = []
    for name, fn in queries.items():
        try:
            out[name] = timed(fn)
        except Exception as exc:  # noqa: BLE001 - report and keep measuring the rest
            out[name] = None
            failed.append(f"{name}: {str(exc)[:200]}")

    headline = ["etl_star_build", "cube_one_pass"] + [
        k for k in queries if k not in ("cube_one_pass", "cube_eight_group_bys",
                                        "summary_monthly_stored")]
    total = sum(out[k] for k in dict.fromkeys(headline) if out[k] is not None)
    print(json.dumps({
        "metric": "etl_plus_queries_total",
        "value": round(total, 3),
        "unit": "sec",
        "queries": {k: (round(v, 3) if v is not None else None) for k, v in out.items()},
        "failed": failed,
        "sf": os.path.basename(sf_dir).replace("sf", ""),
        "cpus": cpus,
        "shuffle_partitions": partitions,
        "spark": spark.version,
    }))


if __name__ == "__main__":
    main()
