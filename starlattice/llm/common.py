"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starlattice.session import materialize

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ship_with_tasks(module) -> None:
    """Send a module's functions to Python workers by value, so that executors need no copy of it."""
    cloudpickle.register_pickle_by_value(module)


def text_or_empty(col: str | Column = "text") -> Column:
    """The text as a string; null counts as empty."""
    col = F.col(col) if isinstance(col, str) else col
    return F.coalesce(col.cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. Pure ASCII text takes the fast ``lower``, which then means the same."""
    return (F.when(F.octet_length(text) == F.char_length(text), F.lower(text))
            .otherwise(F.translate(text, UPPER, UPPER.lower())))


def unused(docs: DataFrame, name: str) -> str:
    """A column name that docs does not have."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def is_empty(df: DataFrame) -> bool:
    return not df.limit(1).count()


__all__ = ["ascii_lower", "is_empty", "materialize", "ship_with_tasks", "text_or_empty", "unused"]
