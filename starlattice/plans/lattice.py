"""A stored lattice of cuboids that answers roll-ups and dices.

A cuboid is the cube's measures, as partial states, by some of its dimensions. The finest one (the base) comes
from one pass over the fact; every coarser one can be had from any finer one, so storing a few saves most
of the work:

* **Sizes.** One pass over the base keeps a HyperLogLog sketch of the distinct members of every subset of the
  dimensions. The estimates only decide what is stored, never a result.
* **Choice.** Greedy, by benefit per byte: a cuboid's benefit is the rows that it saves all cuboids below it,
  against the smallest stored one that could answer them now. The choice stops at the byte budget.
* **Answer.** A roll-up, with or without fixed members, reads the smallest stored cuboid that has all columns it
  groups or filters by; filters reach that cuboid's Parquet scan. The fact is not read.
* **Growth.** New cells are aggregated to each stored cuboid and written beside its older folders; states
  add up on reading. A manifest written last names the folders that count. One writer at a time.

Facts whose keys did not resolve are kept apart by a flag in every cuboid: they count in the grand total only, as in
:func:`starlattice.operators.olap.cube_of_cells`. A NULL member is a member. Subsets number 2^dimensions, so a lattice
takes at most ten dimensions; that bounds the driver's work by the schema, not by the data.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, replace
from itertools import combinations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.measures import Measure, merged_measures
from ..operators.olap import MATCHED, dice
from ..session import job_label
from ..spec import ALL_LABEL

MAX_DIMENSIONS = 10
# 2^14 registers: a relative error of about 0.8 %, 16 KB a sketch
SKETCH_BITS = 14
STATE_BYTES = 16
_MANIFEST = "at bigint, dims array<string>, cuboids array<struct<dims: array<string>, folders: array<string>, rows: bigint>>"


@dataclass(frozen=True)
class Cuboid:
    """A stored cuboid: its dimensions, the folders its states lie in, and their rows."""

    dims: tuple[str, ...]
    folders: tuple[str, ...]
    rows: int


def subsets(dims: Sequence[str]) -> list[tuple[str, ...]]:
    """All subsets of ``dims``, finest first."""
    return [c for k in range(len(dims), -1, -1) for c in combinations(dims, k)]


def cuboid_sizes(base: DataFrame, dims: Sequence[str], states: int) -> dict[tuple[str, ...], tuple[int, int]]:
    """(rows, bytes) of every cuboid, estimated from sketches that one pass over ``base`` fills."""
    every = subsets(dims)
    # the null flag keeps (a, NULL) and (NULL, a) apart: the hash passes over NULLs
    hashed = [F.xxhash64(*[part for d in s for part in (F.col(d), F.col(d).isNull())], F.col(MATCHED)) for s in every]
    rows = [F.hll_sketch_estimate(F.hll_sketch_agg(h, SKETCH_BITS)).alias(f"n{i}") for i, h in enumerate(hashed)]
    width = [F.coalesce(F.avg(F.octet_length(F.col(d).cast("string"))), F.lit(0.0)).alias(f"w{i}")
             for i, d in enumerate(dims)]
    with job_label(base.sparkSession, "cuboid sizes"):
        row = base.agg(*rows, *width).first()
    wide = {d: row[f"w{i}"] + 4 for i, d in enumerate(dims)}
    return {s: (int(row[f"n{i}"]), int(row[f"n{i}"] * (sum(wide[d] for d in s) + states * STATE_BYTES)))
            for i, s in enumerate(every)}


def choose_cuboids(sizes: dict[tuple[str, ...], tuple[int, int]], budget_bytes: int) -> list[tuple[str, ...]]:
    """The base and the cuboids worth most per byte that fit ``budget_bytes`` beside it, finest first."""
    base = max(sizes, key=len)
    cost = {s: sizes[base][0] for s in sizes}
    chosen, left = [base], budget_bytes
    while True:
        best, worth = None, 0.0
        for s, (rows, size) in sizes.items():
            if s in chosen or size > left:
                continue
            benefit = sum(max(0, cost[below] - rows) for below in sizes if set(below) <= set(s))
            if benefit / max(size, 1) > worth:
                best, worth = s, benefit / max(size, 1)
        if best is None:
            return sorted(chosen, key=lambda s: list(sizes).index(s))
        chosen.append(best)
        left -= sizes[best][1]
        for below in sizes:
            if set(below) <= set(best):
                cost[below] = min(cost[below], sizes[best][0])


def merge_states(cells: DataFrame, dims: Sequence[str], measures: Sequence[Measure]) -> DataFrame:
    """``cells`` added up by ``dims`` and the flag; the states keep their types, which sums would widen."""
    types = {f.name: f.dataType for f in cells.schema.fields}
    keys = [k for m in measures for k, _ in m.parts]
    sums = cells.groupBy(*dims, MATCHED).agg(*[F.sum(k).alias(k) for k in keys])
    return sums.select(*dims, MATCHED, *[F.col(k).cast(types[k]).alias(k) for k in keys])


class Lattice:
    """Stored cuboids under ``root``; see :func:`write_lattice` and :func:`open_lattice`."""

    def __init__(self, spark: SparkSession, root: str, dims: Sequence[str], cuboids: Sequence[Cuboid],
                 measures: Sequence[Measure]):
        self.spark, self.root = spark, root.rstrip("/")
        self.dims, self.cuboids, self.measures = list(dims), list(cuboids), list(measures)

    def source(self, columns: Sequence[str]) -> Cuboid:
        """The smallest stored cuboid that has all of ``columns``."""
        unknown = sorted(set(columns) - set(self.dims))
        if unknown:
            raise ValueError(f"not dimensions of this lattice: {', '.join(unknown)}")
        able = [c for c in self.cuboids if set(columns) <= set(c.dims)]
        return min(able, key=lambda c: (c.rows, len(c.dims)))

    def states(self, cuboid: Cuboid) -> DataFrame:
        return self.spark.read.parquet(*[f"{self.root}/{f}" for f in cuboid.folders])

    def answer(self, keep: Sequence[str], members: dict | None = None, labelled: Sequence[str] | None = None,
               all_label: str = ALL_LABEL) -> DataFrame:
        """Measures by ``keep`` over the facts with the given ``members``, from one stored cuboid.

        ``labelled`` names the dimensions of the output (default: the lattice's); those not kept are 'All'.
        Without kept and fixed dimensions it is the grand total over every fact, one row even without any.
        """
        members = members or {}
        cells = self.states(self.source([*keep, *members]))
        if keep or members:
            cells = dice(cells.where(F.col(MATCHED)), members)
        merged = merged_measures(self.measures)
        partials = [p for m in merged for p in m.partials]
        if not keep:  # a count over nothing is 0, a sum is NULL
            partials = [(F.coalesce(F.sum(k), F.lit(0)) if k.endswith("__n") else F.sum(k)).alias(k)
                        for m in merged for k, _ in m.parts]
        out = cells.groupBy(*keep).agg(*partials)
        return out.select(*[F.col(d) if d in keep else F.lit(all_label).alias(d) for d in labelled or self.dims],
                          *[m.final for m in merged])


def _write_cuboids(spark: SparkSession, root: str, wanted: Sequence[tuple[str, ...]], base: DataFrame,
                   measures: Sequence[Measure]) -> list[Cuboid]:
    """Each wanted cuboid, finest first, from the smallest one written before that can give it."""
    folder, done = f"states-{uuid.uuid4().hex}", []
    lattice = Lattice(spark, root, wanted[0], done, measures)
    for i, dims in enumerate(wanted):
        above = lattice.states(lattice.source(dims)) if done else base
        at = f"{folder}/{i}-{'-'.join(dims) or 'total'}"
        with job_label(spark, f"cuboid {', '.join(dims) or 'total'}"):
            merge_states(above, dims, measures).write.mode("errorifexists").parquet(f"{lattice.root}/{at}")
            rows = spark.read.parquet(f"{lattice.root}/{at}").count()  # of the files' footers
        lattice.cuboids.append(Cuboid(tuple(dims), (at,), rows))
    return lattice.cuboids


def _write_manifest(lattice: Lattice) -> Lattice:
    now = time.time_ns()
    texts = lambda xs: F.array(*[F.lit(x) for x in xs]).cast("array<string>")
    cuboids = F.array(*[F.struct(texts(c.dims).alias("dims"), texts(c.folders).alias("folders"),
                                 F.lit(c.rows).cast("bigint").alias("rows")) for c in lattice.cuboids])
    with job_label(lattice.spark, "lattice manifest"):
        lattice.spark.range(1).select(F.lit(now).alias("at"), texts(lattice.dims).alias("dims"), cuboids.alias("cuboids")) \
            .write.mode("errorifexists").json(f"{lattice.root}/manifests/{now}-{uuid.uuid4().hex}")
    return lattice


def write_lattice(spark: SparkSession, root: str, cells: DataFrame, dims: Sequence[str], measures: Sequence[Measure],
                  budget_bytes: int | None = None) -> Lattice:
    """Store the base of ``cells`` and the chosen cuboids under ``root``; the new manifest replaces an older one.

    ``cells`` has ``dims``, the flag ``__matched`` and the partial states of ``measures``. ``budget_bytes`` bounds the
    estimated size of all cuboids beside the base (default: half of the base's).
    """
    dims = list(dims)
    if not 0 < len(dims) <= MAX_DIMENSIONS or len(set(dims)) < len(dims):
        raise ValueError(f"a lattice takes 1 to {MAX_DIMENSIONS} different dimensions")
    done = _write_cuboids(spark, root, [tuple(dims)], cells, measures)
    base = Lattice(spark, root, dims, done, measures)
    sizes = cuboid_sizes(base.states(done[0]), dims, sum(len(m.parts) for m in measures))
    budget = sizes[tuple(dims)][1] // 2 if budget_bytes is None else budget_bytes
    for s in choose_cuboids(sizes, budget)[1:]:
        above = base.states(base.source(s))
        base.cuboids.append(_write_cuboids(spark, root, [s], above, measures)[0])
    return _write_manifest(base)


def open_lattice(spark: SparkSession, root: str, measures: Sequence[Measure]) -> Lattice:
    """The lattice of the newest manifest under ``root``."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/manifests")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        raise FileNotFoundError(f"no lattice was written under {root}")
    r = spark.read.schema(_MANIFEST).json(f"{path.toString()}/*").orderBy(F.desc("at")).first()
    return Lattice(spark, root, r.dims, [Cuboid(tuple(c.dims), tuple(c.folders), c.rows) for c in r.cuboids], measures)


def extend_lattice(lattice: Lattice, cells: DataFrame) -> Lattice:
    """Add new cells to every stored cuboid; older states are neither read nor rewritten."""
    wanted = [c.dims for c in lattice.cuboids]
    added = _write_cuboids(lattice.spark, lattice.root, wanted, cells, lattice.measures)
    grown = [replace(c, folders=c.folders + a.folders, rows=c.rows + a.rows) for c, a in zip(lattice.cuboids, added)]
    return _write_manifest(Lattice(lattice.spark, lattice.root, lattice.dims, grown, lattice.measures))


def refold(lattice: Lattice, budget_bytes: int | None = None) -> Lattice:
    """Fold the folders of all extensions into one each and choose the cuboids anew, from the stored base alone."""
    base = next(c for c in lattice.cuboids if set(c.dims) == set(lattice.dims))
    return write_lattice(lattice.spark, lattice.root, lattice.states(base), lattice.dims, lattice.measures, budget_bytes)


def stored_cuboids(lattice: Lattice) -> DataFrame:
    """What is stored: each cuboid's dimensions and rows."""
    rows = [(", ".join(c.dims), len(c.dims), c.rows) for c in lattice.cuboids]
    return lattice.spark.createDataFrame(rows, "dims string, n_dims int, rows bigint")
