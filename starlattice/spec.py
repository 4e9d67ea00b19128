"""Settings shared by every builder and OLAP operator.

A :class:`StarSpec` carries the choices that decide exact results: the
decimal types money, quantities and ratios are kept in, the rounding
rule, the labels used for rolled-up members and the default category.
Everything is a plain value so a spec can be shared by driver code and
shipped inside closures without touching Spark.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# Labels and defaults that must equal the reference's output.
ALL_LABEL = "All"
DEFAULT_CATEGORY = "pickle"
OTHER_LABEL = "Other"
MONTHLY_SHEET_SUFFIX = "_month_sales"


@dataclass(frozen=True)
class StarSpec:
    """Types, rounding and labels of one star schema."""

    money_type: str = "decimal(18,2)"
    # A quantity with more decimals than this raises; nothing is rounded away.
    quantity_type: str = "decimal(18,6)"
    ratio_type: str = "decimal(18,4)"
    parse_type: str = "decimal(38,10)"
    money_places: int = 2
    ratio_places: int = 4
    # "half_up" (SQL ROUND, the default) or "half_even" (the pandas rule).
    rounding: str = "half_up"
    all_label: str = ALL_LABEL
    other_label: str = OTHER_LABEL
    default_category: str = DEFAULT_CATEGORY
    month_key_format: str = "yyyy-MM"
    date_format: str | None = None
    monthly_sheet_suffix: str = MONTHLY_SHEET_SUFFIX
    # Largest estimated in-memory size of a dimension joined by broadcast.
    # Above it the join falls back to a shuffle join.
    broadcast_max_bytes: int = 128 * 1024 * 1024
    # Partitions for distributed numbering; None means spark.sql.shuffle.partitions.
    id_partitions: int | None = None
    extra: dict = field(default_factory=dict, compare=False, hash=False)


DEFAULT_SPEC = StarSpec()
