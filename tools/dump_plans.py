"""Write the physical plans of the headline queries to PLANS.md.

Usage: python tools/dump_plans.py [sf_dir]

Plans are taken over the written star (as the benchmark runs them), with
AQE's initial plan shown (no job is run, so no runtime re-planning).
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from starlattice.operators import analytics as A  # noqa: E402
from starlattice.operators import olap as O  # noqa: E402
from starlattice.plans.registry import SLICE_MONTH, star_for  # noqa: E402
from starlattice.plans.star import star_from_tables  # noqa: E402
from starlattice.session import get_session, scratch_path  # noqa: E402
from starlattice.sinks.writers import write_star  # noqa: E402
from starlattice.sources.readers import read_star  # noqa: E402


def explain_text(df) -> str:
    """``df.explain("formatted")`` captured as text."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    built = star_for(spark, sf_dir)
    root = scratch_path(spark, "plans-warehouse")
    write_star(built, root)
    s = star_from_tables(read_star(spark, root), built.spec)
    plans = {
        "cube (one scan, one shuffle: all grouping sets and the grand total)": O.star_cube(s),
        "revenue_by_month": A.revenue_by_month(s),
        "profit_share (scalar subquery for the total)": A.profit_share(s),
        "top_records (top-N)": A.top_records(s),
        "olap_slice (filter on a month: partition pruning of the fact)":
            O.slice_(O.denormalize(s, s.fact, ("dim_month", "dim_product")), "month_name",
                     SLICE_MONTH),
        "fact numbering (built star: range partition, positions written once)": built.fact,
    }
    out = ["# Physical plans", "",
           f"Generated by `tools/dump_plans.py` at `{sf_dir}`, local[8], 8 shuffle partitions.",
           "Paths under the checkpoint root are shortened to `<ckpt>`.", ""]
    for title, df in plans.items():
        text = explain_text(df)
        text = re.sub(r"file:[^\]\s,]*/starlattice/", "<ckpt>/starlattice/", text)
        text = re.sub(r"-[0-9a-f]{32}", "-<id>", text)
        out += [f"## {title}", "", "```", text.strip(), "```", ""]
    out += shape_table(spark, sf_dir)
    with open(os.path.join(ROOT, "PLANS.md"), "w") as fh:
        fh.write("\n".join(out))


def shape_table(spark, sf_dir: str) -> list[str]:
    """One row per registered query: what its physical plan is made of."""
    from starlattice.plans.registry import queries
    rows = ["## Shape of every registered query", "",
            "Counted in the initial physical plan (AQE may still turn a shuffle join into a "
            "broadcast at run time). `shuffles` excludes broadcasts; `scans` counts Parquet "
            "scans of any table (dimensions included).", "",
            "| query | scans | shuffles | broadcasts | Expand | TakeOrdered | Window | "
            "SortMergeJoin |",
            "|---|---|---|---|---|---|---|---|"]
    for name, fn in sorted(queries().items()):
        try:
            tree = explain_text(fn(spark, sf_dir)).split("\n\n")[0]
        except Exception as exc:  # noqa: BLE001
            rows.append(f"| {name} | error: {str(exc)[:60]} | | | | | | |")
            continue
        lines = tree.splitlines()
        count = lambda key: sum(1 for ln in lines if key in ln)
        shuffles = sum(1 for ln in lines if "Exchange" in ln and "BroadcastExchange" not in ln
                       and "ReusedExchange" not in ln)
        rows.append(f"| {name} | {count('Scan ')} | {shuffles} | {count('BroadcastExchange')} | "
                    f"{count('Expand')} | {count('TakeOrderedAndProject')} | "
                    f"{count('Window')} | {count('SortMergeJoin')} |")
    return rows + [""]


if __name__ == "__main__":
    main()
