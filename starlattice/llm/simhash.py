"""Operator 6, SimHash near-dedup by a self-join over a binary trie.

Fingerprints: lower-case A-Z, words between white space, shingles of three words with repeats, XXH64
of each (seed 42), and a bit is set where it is set in more than half of the hashes.

Self-join: the distinct fingerprints form a binary trie. Two nodes of the same depth are visited
together with the number of bits in which their paths differ; their children are visited in all
four combinations, and a pair of nodes is dropped as soon as its differing bits exceed the budget.
A pair of fingerprints within the budget of ``k`` bits agrees on at least one of ``k + 1`` slices of
its bits, so the trie is built once per slice, turned so that the slice comes first, and the walk
starts below the nodes of that slice, from each node paired with itself at no error. Spark deals the
starting nodes over the tasks. A node with more than ``node_rows`` fingerprints is split before that,
byte by byte and as often as needed, into the pairs of its descendants within the budget, each of
which is dealt anew. Inside a task the walk runs level by level over arrays: a node is a range of
the sorted fingerprints.

The links that a task finds are kept as a forest (each fingerprint with the first of its group), which
loses no connection and has at most one row per fingerprint. Components come from alternating large
and small stars over written tables.

Defined results: null and empty texts, and texts of white space, have fingerprint zero and link like
any other. Fewer than three words are one shingle. component_id is the smallest doc_id that can be
reached; null doc_ids are left out of that minimum, which is null only when all are. Repeated rows
have equal fingerprints and so one component. An empty table gives an empty table. Only doc_id and
text are read.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starlattice.llm.common import is_empty, materialize, ship_with_tasks, text_or_empty, unused

ship_with_tasks(sys.modules[__name__])

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
NODE_ROWS = 20_000
FRONTIER = 500_000
HASHES_AT_ONCE = 1 << 16


# ---- fingerprints

def fingerprint(text: str, shingle_words: int = SHINGLE_WORDS) -> int:
    from xxhash import xxh64_intdigest

    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: lower() is A-Z only
    if not words:
        return 0
    joined, k = b" ".join(words), min(shingle_words, len(words))
    ends = list(accumulate((len(w) + 1 for w in words), initial=0))
    n = len(words) - k + 1
    ones = np.zeros(64, np.int64)
    for at in range(0, n, HASHES_AT_ONCE):
        upto = min(n, at + HASHES_AT_ONCE)
        hashes = np.array([xxh64_intdigest(joined[a:b - 1], SEED)
                           for a, b in zip(ends[at:upto], ends[at + k:upto + k])], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, text_hash, fp): fp holds the 64 bits as a long."""
    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            fps = np.array([fingerprint(t, shingle_words) for t in batch.column(2).to_pylist()],
                           np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fps)],
                                             ["doc_id", "text_hash", "fp"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_or_empty()).alias("text_hash"),
                       text_or_empty().alias("text"))
    return rows.mapInArrow(batches, "doc_id long, text_hash long, fp long")


# ---- self-join over the trie

def _turned(keys: np.ndarray, by: int) -> np.ndarray:
    return keys if by % 64 == 0 else (keys << np.uint64(by)) | (keys >> np.uint64(64 - by))


def trie_links(keys: np.ndarray, nodes: np.ndarray, depth: int, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (positions in keys) within the budget.

    keys: unsigned, sorted within each side of a node. nodes: rows (a_from, a_to, b_from, b_to) of
    the node pairs to start from, whose paths of ``depth`` bits are known; a node paired with itself
    has equal ranges. The bits by which the two paths differ are counted here.
    """
    found: list[tuple[np.ndarray, np.ndarray]] = []
    own = (nodes[:, 0] == nodes[:, 2])
    first = np.where(own, 0, np.bitwise_count((keys[nodes[:, 0]] ^ keys[nodes[:, 2]]) >> np.uint64(64 - depth)))
    stack = [(depth, nodes, first.astype(np.int8))]
    zeros: dict[int, np.ndarray] = {}
    while stack:
        depth, nodes, differ = stack.pop()
        own = nodes[:, 0] == nodes[:, 2]
        sizes_a, sizes_b = nodes[:, 1] - nodes[:, 0], nodes[:, 3] - nodes[:, 2]
        # two single leaves: the remaining bits at once
        leaf = ~own & (sizes_a == 1) & (sizes_b == 1)
        a, b = nodes[leaf, 0], nodes[leaf, 2]
        near = np.bitwise_count(keys[a] ^ keys[b]) <= budget
        found.append((a[near], b[near]))
        go = ~leaf & (sizes_a > 0) & (sizes_b > 0) & ~(own & (sizes_a < 2)) & (differ <= budget)
        nodes, differ = nodes[go], differ[go]
        if not len(nodes):
            continue
        if depth == 64:  # equal keys below one node
            raise ValueError("keys must be distinct")
        if len(nodes) > FRONTIER:
            half = len(nodes) // 2
            stack += [(depth, nodes[:half], differ[:half]), (depth, nodes[half:], differ[half:])]
            continue
        if depth not in zeros:
            bit = (keys >> np.uint64(63 - depth)) & np.uint64(1)
            zeros[depth] = np.concatenate(([0], np.cumsum(1 - bit.astype(np.int64))))
        z = zeros[depth]
        own = nodes[:, 0] == nodes[:, 2]
        a_mid = nodes[:, 0] + z[nodes[:, 1]] - z[nodes[:, 0]]
        b_mid = nodes[:, 2] + z[nodes[:, 3]] - z[nodes[:, 2]]
        a0, a1 = (nodes[:, 0], a_mid), (a_mid, nodes[:, 1])
        b0, b1 = (nodes[:, 2], b_mid), (b_mid, nodes[:, 3])
        parts = [(a0, b0, 0, slice(None)), (a1, b1, 0, slice(None)), (a0, b1, 1, slice(None)), (a1, b0, 1, ~own)]
        nodes = np.concatenate([np.stack([x[0][s], x[1][s], y[0][s], y[1][s]], axis=1) for x, y, _, s in parts])
        differ = np.concatenate([differ[s] + d for _, _, d, s in parts]).astype(np.int8)
        stack.append((depth + 1, nodes, differ))
    return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n positions, the first position of its connected group."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def _walk(slice_bits: int, budget: int):
    """Tasks get rows (turn, depth, pa, pb, side, key) sorted by these columns; whole nodes in a task."""
    def links(rows: list[np.ndarray]) -> pa.RecordBatch | None:
        turn, depth, at, bt, side, key = rows
        keys = key.view(np.uint64)
        new = np.flatnonzero(np.r_[True, (turn[1:] != turn[:-1]) | (depth[1:] != depth[:-1])
                                   | (at[1:] != at[:-1]) | (bt[1:] != bt[:-1])])
        ends = np.r_[new[1:], len(key)]
        ones = np.r_[0, np.cumsum(side)]
        mid = ends - (ones[ends] - ones[new])  # rows of side 1 follow those of side 0
        alone = at[new] == bt[new]
        nodes = np.stack([new, np.where(alone, ends, mid), np.where(alone, new, mid), ends], axis=1)
        a_all, b_all = [], []
        for d in np.unique(depth[new]):
            a, b = trie_links(keys, nodes[depth[new] == d], int(d), budget)
            a_all.append(a)
            b_all.append(b)
        a, b = np.concatenate(a_all), np.concatenate(b_all)
        if not len(a):
            return None
        label = _forest(len(key), a, b)
        at = np.flatnonzero(label != np.arange(len(key)))
        back = [np.empty(len(at), np.uint64), np.empty(len(at), np.uint64)]
        for t in np.unique(turn[at]):
            mask = turn[at] == t
            back[0][mask] = _turned(keys[at[mask]], 64 - int(t) * slice_bits)
            back[1][mask] = _turned(keys[label[at[mask]]], 64 - int(t) * slice_bits)
        return pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in back], ["u", "v"])

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        for batch in it:
            rows = [batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(6)]
            held = rows if held is None else [np.concatenate(x) for x in zip(held, rows)]
            if not len(held[0]):
                continue
            last = np.ones(len(held[0]), bool)  # the last node may go on in the next batch
            for x in held[:4]:
                last &= x == x[-1]
            cut = len(last) - int(last.sum())
            if cut:
                out = links([x[:cut] for x in held])
                held = [x[cut:] for x in held]
                if out is not None:
                    yield out
        if held is not None and len(held[0]):
            out = links(held)
            if out is not None:
                yield out

    return batches


def near_links(distinct: DataFrame, max_bits: int = MAX_BITS, node_rows: int = NODE_ROWS) -> DataFrame:
    """Links (u, v) between distinct fingerprints (column fp) that connect all within max_bits."""
    slice_bits = 64 // (max_bits + 1)
    turned = [F.struct(F.lit(t).alias("turn"),
                       (F.col("fp") if t == 0 else
                        F.shiftleft("fp", t * slice_bits).bitwiseOR(F.shiftrightunsigned("fp", 64 - t * slice_bits)))
                       .alias("key")) for t in range(max_bits + 1)]
    rows = distinct.select(F.explode(F.array(*turned)).alias("x")).select("x.turn", "x.key")
    prefix = F.shiftrightunsigned("key", 64 - slice_bits)
    rows = rows.select("turn", F.lit(slice_bits).alias("depth"), prefix.alias("pa"), prefix.alias("pb"),
                       F.lit(0).alias("side"), "key")
    node = ["turn", "depth", "pa", "pb"]
    flips = F.array(*[F.lit(m).cast("long") for m in range(256) if m.bit_count() <= max_bits])
    ready: list[DataFrame] = []
    while True:
        rows = materialize(rows, "trie-rows")
        sizes = materialize(rows.groupBy(*node).agg(F.count(F.lit(1)).alias("m"), F.max("side").alias("hi"),
                                                    F.min("side").alias("lo")), "trie-nodes")
        # a node needs two keys, and keys on both sides if its paths differ
        sizes = sizes.filter((F.col("m") > 1) & ((F.col("pa") == F.col("pb")) | (F.col("hi") != F.col("lo"))))
        both = rows.join(sizes.select(*node, "m"), node)
        small = (F.col("m") <= node_rows) | (F.col("depth") > 56)
        ready.append(both.filter(small).select(*rows.columns))
        if is_empty(sizes.filter(~small)):
            break
        # large nodes: one byte further down, to all pairs of children within the budget
        large = both.filter(~small).withColumn("flip", F.explode(flips))
        byte = F.expr("shiftrightunsigned(key, 56 - depth) & 255")
        other = byte.bitwiseXOR(F.col("flip"))
        paths = F.bit_count(F.col("pa").bitwiseXOR(F.col("pb")))
        own = F.col("pa") == F.col("pb")
        mine, theirs = [F.when(F.col("side") == 0, x).otherwise(y) for x, y in
                        ((byte, other), (other, byte))]
        low, high = F.least(byte, other), F.greatest(byte, other)
        down = lambda p, b: F.col(p) * 256 + b
        rows = (large.filter(paths + F.bit_count("flip") <= max_bits)
                .select("turn", (F.col("depth") + 8).alias("depth"),
                        F.when(own, down("pa", low)).otherwise(down("pa", mine)).alias("pa"),
                        F.when(own, down("pb", high)).otherwise(down("pb", theirs)).alias("pb"),
                        F.when(own, (byte > other).cast("int")).otherwise(F.col("side")).alias("side"), "key"))
    todo = ready[0]
    for part in ready[1:]:
        todo = todo.unionByName(part)
    # a long below zero is an unsigned key above the others
    dealt = todo.repartition(*node).sortWithinPartitions(*node, "side", F.col("key") < 0, "key")
    return dealt.mapInArrow(_walk(slice_bits, max_bits), "u long, v long")


# ---- components

def component_roots(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each connected group, for all nodes but the roots."""
    edges = materialize(links.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                        .distinct(), "links")
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = materialize(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "large-star")
        edges = materialize(both.join(low, "u").filter("v > u and v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                            .distinct(), "links")
        low = materialize(edges.groupBy("u").agg(F.min("v").alias("m")), "small-star")
        hang = edges.join(low, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = materialize(hang.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "links")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = tuple(now)


def _labelled(docs: DataFrame, shingle_words: int, max_bits: int, node_rows: int) -> DataFrame:
    """One row per document: doc_id, text_hash, fp, root (one fingerprint for each component), component_id."""
    fps = materialize(fingerprints(docs, shingle_words), "fingerprints")
    classes = materialize(fps.groupBy("fp").agg(F.min("doc_id").alias("rep")), "fingerprint-classes")
    roots = component_roots(near_links(classes.select("fp"), max_bits, node_rows))
    rooted = materialize(classes.join(roots, classes["fp"] == roots["node"], "left")
                         .select("fp", "rep", F.coalesce("root", "fp").alias("root")), "fingerprint-roots")
    lowest = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = materialize(rooted.join(lowest, "root").select("fp", "root", "component_id"), "fingerprint-components")
    return fps.join(named, "fp")


def near_duplicates(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
                    node_rows: int = NODE_ROWS) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id."""
    return (_labelled(docs, shingle_words, max_bits, node_rows)
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))


def drop_near_duplicates(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
                         node_rows: int = NODE_ROWS) -> DataFrame:
    """One document of each component, with all its columns: the one with the smallest doc_id (null after all
    numbers), of several texts under that doc_id the one with the smallest hash, of repeated rows any one."""
    of_id, of_hash = unused(docs, "__id"), unused(docs, "__hash")
    kept = (_labelled(docs, shingle_words, max_bits, node_rows).groupBy("root")
            .agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("first"))
            .select(F.col("first.doc_id").alias(of_id), F.col("first.text_hash").alias(of_hash)))
    out = docs.join(kept, docs["doc_id"].cast("long").eqNullSafe(kept[of_id])
                    & (F.xxhash64(text_or_empty(docs["text"])) == kept[of_hash]))
    return out.dropDuplicates([of_id, of_hash]).select(*[out[f"`{c}`"] for c in docs.columns])
