"""Operator 3, exact dedup by deterministic block naming.

Each text is cut into blocks of a fixed number of characters. The distinct blocks are sorted and
numbered: a block's number is its name. Adjacent names of a document are then paired, the distinct
pairs sorted and numbered again, and so on until a single name is left. Two texts have equal names
(with equal numbers of blocks) exactly when the texts are equal, whatever hash functions do.

Names are found without moving a block twice. Blocks are grouped under a 128-bit stand-in, and each
group carries its smallest and largest block; if these differ anywhere, two different blocks share
a stand-in and the whole numbering is done again with another seed. So the stand-in takes the block's
place in joins, and the names are free of collisions by check.

Names are ranks in one order over all partitions: blocks by their first ``SORTED_CHARS`` characters, then by
stand-in (which no two blocks share), pairs by their two names. Rows are range-partitioned and sorted by it, and a
partition's ranks begin where the partitions before it end. So names depend on the texts alone, not on how
Spark has dealt them, and a block's whole text is not shuffled again to be sorted.

Defined results: null text counts as empty, and all empty texts are equal. Among equal texts the row
with the largest doc_id stays; a null doc_id is below every number. Repeated rows (same doc_id and
text) are one group, of which exactly one row stays. An empty table gives an empty table. Columns
other than doc_id and text are not read, so their names cannot clash.

DataFrame functions only. Hot texts: the groupings combine map-side, and the joins back are joins
of two written tables, which adaptive execution splits when a name is skewed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starlattice.llm.common import ascii_lower, is_empty, materialize, text_or_empty, unused
from starlattice.operators.numbering import sequential_ids

BLOCK_CHARS = 4096
SORTED_CHARS = 32


def _blocks(docs: DataFrame, block_chars: int) -> DataFrame:
    """One row per block: row id, doc_id and digest (first block only), width in blocks, pos, block."""
    rows = (docs.select(F.col("doc_id"), ascii_lower(text_or_empty()).alias("norm"))
            .withColumn("rid", F.monotonically_increasing_id())
            .withColumn("parts", F.when(F.col("norm") == "", F.array(F.lit("")))
                        .otherwise(F.regexp_extract_all(
                            "norm", F.lit("(?s).{1,%d}" % block_chars), F.lit(0))))
            .select("rid", "doc_id", F.unhex(F.sha2("norm", 256)).alias("sha"),
                    F.size("parts").alias("n"), F.posexplode("parts").alias("pos", "block")))
    first = F.col("pos") == 0
    return rows.select("rid", F.when(first, F.col("doc_id")).alias("doc_id"),
                       F.when(first, F.col("sha")).alias("sha"), "n", "pos", "block")


def _numbered(distinct: DataFrame, order: list[str]) -> DataFrame:
    """Distinct values with their rank in ``order``, from 0, as name."""
    return sequential_ids(distinct, [F.col(c) for c in order], "name", start=0, name="ranked")


def _name_blocks(blocks: DataFrame) -> DataFrame:
    """Level 0: blocks replaced by their names."""
    seed = 0
    while True:
        keyed = (blocks.withColumn("k1", F.xxhash64(F.lit(seed), "block"))
                 .withColumn("k2", F.xxhash64("block", F.lit(seed + 1))))
        groups = (keyed.groupBy("k1", "k2")
                  .agg(F.min("block").alias("lo"), F.max("block").alias("hi")))
        groups = materialize(groups.select("k1", "k2", F.substring("lo", 1, SORTED_CHARS).alias("head"),
                                           (F.col("lo") != F.col("hi")).alias("clash")), "block-groups")
        if is_empty(groups.filter("clash")):
            names = _numbered(groups.drop("clash"), ["head", "k1", "k2"]).select("k1", "k2", "name")
            return materialize(keyed.join(names, ["k1", "k2"])
                               .select("rid", "doc_id", "sha", "n", "pos", "name"), "block-level")
        seed += 2


def _name_pairs(level: DataFrame) -> DataFrame:
    """One level up: (rid, n, width, pos, name) of half the width. A last odd name pairs with -1."""
    even = F.col("pos") % 2 == 0
    pairs = materialize(
        level.groupBy("rid", "n", "width", F.floor(F.col("pos") / 2).alias("at"))
        .agg(F.max(F.when(even, F.col("name"))).alias("a"),
             F.coalesce(F.max(F.when(~even, F.col("name"))), F.lit(-1)).alias("b")), "pairs")
    names = _numbered(materialize(pairs.select("a", "b").distinct(), "distinct-pairs"), ["a", "b"])
    return materialize(
        pairs.join(names, ["a", "b"])
        .select("rid", "n", F.ceil(F.col("width") / 2).alias("width"), F.col("at").alias("pos"), "name"),
        "pair-level")


def document_names(docs: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(rid, doc_id, sha, n, name) per row; equal texts have equal (n, name), others never."""
    blocks = _name_blocks(_blocks(docs, block_chars))
    heads = blocks.filter("pos = 0").select("rid", "doc_id", "sha", "n", "name")
    done = [heads.filter("n = 1")]
    level = blocks.filter("n > 1").select("rid", "n", F.col("n").cast("long").alias("width"),
                                          F.col("pos").cast("long").alias("pos"), "name")
    # widths halve, so the number of rounds is the logarithm of the longest text's blocks
    width = blocks.agg(F.max("n")).first()[0] or 1
    roots = []
    while width > 1:
        level = _name_pairs(level)
        roots.append(level.filter("width = 1").select("rid", "name"))
        level = level.filter("width > 1")
        width = -(-width // 2)
    for part in roots:
        done.append(heads.filter("n > 1").drop("name").join(part, "rid")
                    .select("rid", "doc_id", "sha", "n", "name"))
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return materialize(out, "document-names")


def exact_duplicates(docs: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    names = document_names(docs, block_chars)
    groups = materialize(
        names.groupBy("n", "name")
        .agg(F.max(F.struct("doc_id", "rid")).alias("keep"), F.count(F.lit(1)).alias("group_size")),
        "name-groups")
    return (names.join(groups, ["n", "name"])
            .select("doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size",
                    (F.col("rid") == F.col("keep.rid")).alias("kept"),
                    F.lower(F.hex("sha")).alias("text_sha256")))


def drop_exact_duplicates(docs: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The documents that stay, with all their columns."""
    of_id, of_sha, own = (unused(docs, name) for name in ("__id", "__sha", "__own"))
    kept = (exact_duplicates(docs, block_chars).filter("kept")
            .select(F.col("doc_id").alias(of_id), F.unhex("text_sha256").alias(of_sha)))
    rows = docs.withColumn(own, F.unhex(F.sha2(ascii_lower(text_or_empty()), 256)))
    out = rows.join(kept, rows["doc_id"].eqNullSafe(kept[of_id]) & (rows[own] == kept[of_sha]))
    # repeated rows of one doc_id share a digest; one of them stays
    return out.dropDuplicates([of_id, of_sha]).select(*[out[f"`{c}`"] for c in docs.columns])
