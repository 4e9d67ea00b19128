"""Text cleaning as built-in Column expressions (no UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character Python's str.strip() removes, built from the rule
# str.isspace() over the Basic Multilingual Plane.
WHITESPACE = "".join(ch for ch in map(chr, range(0x10000)) if ch.isspace())


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c) -> Column:
    """Remove leading and trailing white space of any kind (tabs, NBSP, ...)."""
    return F.btrim(_col(c), F.lit(WHITESPACE))


def clean_text(c) -> Column:
    """strip then lower case: the reference's ``.str.strip().str.lower()``."""
    return F.lower(strip_ws(c))


def normalize_name(name: str) -> str:
    """Header normalisation: strip, lower case, blank -> underscore."""
    return name.strip().lower().replace(" ", "_")


def source_tag(sheet, suffix: str) -> Column:
    """Sheet name -> tag: drop the suffix, '_' -> blank, title case."""
    return title_case(F.replace(F.replace(_col(sheet), F.lit(suffix), F.lit("")),
                                F.lit("_"), F.lit(" ")))


def title_case(c) -> Column:
    """Every run of letters capitalised, as ``str.title`` does ('june-b' -> 'June-B')."""
    runs = F.regexp_extract_all(_col(c), F.lit(r"(\p{L}+|\P{L}+)"), F.lit(0))
    return F.array_join(F.transform(runs, lambda r: F.initcap(r)), "")


def path_leaf_dir(path_col) -> Column:
    """Name of the folder that holds a file, %-escapes decoded; a ``key=value`` folder gives value."""
    # a regular expression would try every place of the path, for every row of the file
    path = _col(path_col)
    inside = F.contains(path, F.lit("/")) & ~F.endswith(path, F.lit("/"))
    parent = F.when(inside, F.substring_index(F.substring_index(path, "/", -2), "/", 1)).when(path.isNotNull(), F.lit(""))
    plain = F.try_url_decode(F.replace(parent, F.lit("+"), F.lit("%2B")))  # '+' is no blank in a path
    name = F.when(F.contains(parent, F.lit("%")), F.coalesce(plain, parent)).otherwise(parent)
    return F.substr(name, F.locate("=", name) + F.lit(1))
