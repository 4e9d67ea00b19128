"""Operator 11, conversation structure repair by the auction shortest-path algorithm.

A conversation should read ``(s?(ua)+)?``: the first letters of its roles, with s, u and a for system, user and
assistant. Edits: Keep a row (0), Rerole it to user or assistant (3), Delete it (4), Insert an empty
user or assistant turn anywhere (3); a truncated row that stays adds 3, and blank and duplicate rows must go.
The cheapest edits are a shortest path through a lattice: node (i, q) stands before row i in state q of the
pattern (0 start, 1 after s, 2 after u, 3 after a), a row leads to (i + 1, q'), an insertion to (i, q').

Auction algorithm (Bertsekas): every node has an integer price, at first a lower bound of its distance to the
end. A path grows from an origin. At its last node, if the best arc (cost plus price of the
far end) exceeds the node's price, the price is raised to it and the path contracts by a node; otherwise the path
extends along that arc. It ends at a node whose price has converged. Origins are taken from the
last row to the first, so each path is short and each price converges to the exact distance. An
arc is tight when cost plus far price equals the near price; every tight path is a cheapest
repair, and the one traced takes the ASCII-least letter (D < I < K < R) at each node.

Distribution: rows are range-partitioned and sorted by conversation, turn, role and a digest of the text, and
numbered once by partition and position (``place``, written). ``piece`` is a block of 4,096 places, so a
conversation of any length falls into bounded pieces. One inside a single piece is solved at once. Of
the others each piece is first reduced to a 4 x 4 matrix of costs between its states; the
matrices of a conversation form a coarse lattice, whose auction gives the prices at the pieces' borders;
every piece then traces from each of its four entry states, and the entries are chained in
order. No task holds more than one piece of rows, or 16 numbers and 4 states a piece of one conversation. Texts take no part in that: they
pass once more through a stream sorted by place, row by row. SHA-256 over a conversation and its
audit are one value each, so that last stream runs through one task per conversation.

Rows alike in conversation, turn and role are ordered by a digest of their text. Defined results: null role or text counts
as one space; null turns come first; null conv_id is a conversation of its own. A duplicate is a row whose role and
text were both seen earlier in the conversation. Repeated rows are duplicates. Empty texts are blank. Very long texts
are held one at a time. An empty table gives an empty table. Only conv_id, turn, role and text are read.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starlattice.llm.common import is_empty, materialize, ship_with_tasks

ship_with_tasks(sys.modules[__name__])

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
PIECE_BITS = 12
NEVER = 1 << 60
#: where a role of s, u or a leads from each state; None where the pattern forbids it
NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
#: the role that an insertion or a new role gives in each state
WANTED = ("u", "u", "a", "u")
ENDS = (0, NEVER, NEVER, 0)
ROLE = {"u": "user", "a": "assistant"}
BLANK, DUPLICATE, CUT = 1, 2, 3


# ---- the lattice

def row_arcs(initial: str, fault: int) -> list[list[tuple[int, int, str]]]:
    """For each state the arcs (cost, next state, letter) over one row."""
    extra = TRUNCATED if fault == CUT else 0
    arcs = []
    for q in range(4):
        mine = [(DELETE, q, "D")]
        if fault not in (BLANK, DUPLICATE):
            if initial in NEXT[q]:
                mine.append((KEEP + extra, NEXT[q][initial], "K"))
            mine.append((REROLE + extra, NEXT[q][WANTED[q]], "R"))
        arcs.append(mine)
    return arcs


def matrix_arcs(matrix: list[int]) -> list[list[tuple[int, int, str]]]:
    return [[(matrix[4 * q + to], to, "") for to in range(4) if matrix[4 * q + to] < NEVER] for q in range(4)]


def prices(units: list, ends) -> list[list[int]]:
    """The price of every node (unit, state): its distance to the end, whose prices are ``ends``. NEVER: no way."""
    after = list(ends)
    closed = _auctions([[] for _ in range(4)], after, after)  # insertions after the last row
    out = [closed]
    for arcs in reversed(units):
        out.append(_auctions(arcs, out[-1], None))
    out.reverse()
    return out


def _auctions(arcs, after: list[int], ends) -> list[int]:
    """Prices of one column of nodes: an auction from each of its states to a node that has converged.

    ``after`` has the converged prices of the next column; ``ends``, at the last column, those of leaving the lattice.
    """
    options = [[(cost + after[to], -1) for cost, to, _ in arcs[q] if after[to] < NEVER] for q in range(4)]
    if ends is not None:
        for q in range(4):
            if ends[q] < NEVER:
                options[q].append((ends[q], -1))
    low = min((value for of in options for value, _ in of), default=NEVER)
    # an insertion leads from 0 and 1 to 2, from 2 to 3 and back; a state without any way out has no price
    way = bool(options[2] or options[3])
    done = [not (way or options[q]) for q in range(4)]
    price = [NEVER if done[q] else low for q in range(4)]  # feasible: no arc is cheaper than the lowest way out
    for origin in range(4):
        path = [origin]
        while not done[path[-1]]:
            q = path[-1]
            to = NEXT[q][WANTED[q]]  # an insertion stays in the column
            best, far = INSERT + price[to], to
            for value, end in options[q]:
                if value < best:
                    best, far = value, end
            if best > price[q]:
                price[q] = best  # contract; the origin itself stays
                if len(path) > 1:
                    path.pop()
            elif far < 0:
                break
            else:
                path.append(far)
        for q in path:  # the prices along a finished path are exact
            done[q] = True
    return price


def trace(units: list, price: list[list[int]], ends, entry: int) -> tuple[list[tuple[int, str]], tuple[int, str], int]:
    """The ASCII-least tight path from a state: (state, letters) of each unit's column, of the end, and the last state."""
    q, out = entry, []
    for i in range(len(units) + 1):
        first, letters = q, ""
        while True:
            here, arcs = price[i][q], []
            to = NEXT[q][WANTED[q]]
            if here == INSERT + price[i][to]:
                arcs.append(("I", to))
            if i == len(units):
                if here == ends[q]:  # the end costs nothing more: no letter is before it
                    return out, (first, letters), q
            else:
                arcs += [(letter, to) for cost, to, letter in units[i][q]
                         if price[i + 1][to] < NEVER and here == cost + price[i + 1][to]]
            letter, q = min(arcs)
            letters += letter
            if letter != "I":
                break
        out.append((first, letters))


def matrix(units: list) -> list[int]:
    """Costs from each state before the units to each state after them."""
    columns = [prices(units, [0 if q == to else NEVER for q in range(4)])[0] for to in range(4)]
    return [columns[to][q] for q in range(4) for to in range(4)]


# ---- rows in order

def _initial(role: Column) -> Column:
    return F.substring(role, 1, 1)


def ordered_rows(turns: DataFrame) -> DataFrame:
    """Rows in order: conv_id, place, piece, turn, role, text, fault (written; ``place`` orders and names them)."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = (turns.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"))
            .withColumn("sha", F.unhex(F.sha2("text", 256)))
            # rows alike in all of these go to any of a few tasks
            .withColumn("salt", F.xxhash64(F.monotonically_increasing_id())))
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "sha", "salt")]
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = materialize(
        rows.repartitionByRange(partitions, *order).sortWithinPartitions(*order)
        .withColumn("place", F.monotonically_increasing_id())
        .select("conv_id", "place", F.shiftright("place", PIECE_BITS).alias("piece"), "turn", "role", "text",
                F.unhex(F.sha2(F.concat_ws("\n", F.hex("sha"), "role"), 256)).alias("same")), "conversation-rows")
    return placed


def _faults(placed: DataFrame) -> DataFrame:
    """conv_id, piece, place, initial, fault of every row, without texts."""
    seen = r"[^\x20\x09-\x0D]"
    flags = placed.select("conv_id", "piece", "place", "same", _initial(F.col("role")).alias("initial"),
                          (~F.col("text").rlike(seen)).alias("blank"),
                          (~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("cut"))
    first = flags.groupBy(F.col("conv_id").alias("of"), F.col("same").alias("as")).agg(F.min("place").alias("first"))
    joined = flags.join(first, flags["conv_id"].eqNullSafe(first["of"]) & (flags["same"] == first["as"]))
    return materialize(joined.select("conv_id", "piece", "place", "initial",
                                     F.when(F.col("blank"), BLANK).when(F.col("place") != F.col("first"), DUPLICATE)
                                     .when(F.col("cut"), CUT).otherwise(0).alias("fault")), "conversation-faults")


def _groups(batches, keys: list[str], columns: list[str]) -> Iterator[tuple[tuple, list[tuple]]]:
    """Runs of rows with equal keys, from rows sorted by them."""
    key, rows = None, []
    for batch in batches:
        lists = [batch.column(c).to_pylist() for c in keys + columns]
        for row in zip(*lists):
            if row[:len(keys)] != key:
                if rows:
                    yield key, rows
                key, rows = row[:len(keys)], []
            rows.append(row[len(keys):])
    if rows:
        yield key, rows


def _batches(rows: Iterator[tuple], schema: pa.Schema, at_once: int = 5_000) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == at_once:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in held], schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in held], schema)


def _edits_schema(conv_type: pa.DataType, entries: bool) -> pa.Schema:
    return pa.schema([("conv_id", conv_type), ("place", pa.int64()), ("state", pa.int32()), ("letters", pa.string())]
                     + [("entry", pa.int32()), ("piece", pa.int64()), ("exit", pa.int32())] * entries)


def _edits(rows: DataFrame) -> DataFrame:
    """(conv_id, place, state, letters) of every row: its state and the edits up to it; the end of a conversation
    has the place of its last row and a half, given as ``tail``."""
    spark = rows.sparkSession
    kind = rows.schema["conv_id"].dataType.simpleString()
    spread = materialize(rows.groupBy("conv_id").agg(F.min("piece").alias("lo"), F.max("piece").alias("hi"))
                         .filter("lo != hi").select(F.col("conv_id").alias("of"), "hi"), "conversations-in-pieces")
    match = rows["conv_id"].eqNullSafe(spread["of"])
    whole = rows.join(spread, match, "left_anti")
    keys = ["conv_id", "piece"]
    sorted_ = lambda df: df.repartition(*keys).sortWithinPartitions(*keys, "place")

    def units_of(group):
        return [row_arcs(initial, fault) for _, initial, fault, *_ in group]

    def at_once(batches):
        def found():
            for (conv, _), group in _groups(batches, keys, ["place", "initial", "fault"]):
                units = units_of(group)
                path, tail, _ = trace(units, prices(units, ENDS), ENDS, 0)
                for (place, *_), (state, letters) in zip(group, path):
                    yield conv, place, state, letters, False
                if tail[1]:
                    yield conv, group[-1][0], tail[0], tail[1], True
        schema = pa.schema([("conv_id", pa_type), ("place", pa.int64()), ("state", pa.int32()), ("letters", pa.string()), ("tail", pa.bool_())])
        yield from _batches(found(), schema)

    pa_type = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]
    shape = f"conv_id {kind}, place long, state int, letters string, tail boolean"
    edits = sorted_(whole).mapInArrow(at_once, shape)
    if is_empty(spread):
        return edits
    parts = materialize(rows.join(F.broadcast(spread) if spread.count() < 10_000 else spread, match).drop("of"), "piece-rows")

    def reduced(batches):
        schema = pa.schema([("conv_id", pa_type), ("piece", pa.int64()), ("costs", pa.list_(pa.int64()))])
        yield from _batches(((conv, piece, matrix(units_of(group)))
                             for (conv, piece), group in _groups(batches, keys, ["place", "initial", "fault"])), schema, 500)

    def borders(batches):
        def found():
            for (conv,), group in _groups(batches, ["conv_id"], ["piece", "costs"]):
                price = prices([matrix_arcs(costs) for _, costs in group], ENDS)
                for i, (piece, _) in enumerate(group):
                    yield conv, piece, price[i + 1], i + 1 == len(group)
        schema = pa.schema([("conv_id", pa_type), ("piece", pa.int64()), ("ends", pa.list_(pa.int64())), ("last", pa.bool_())])
        yield from _batches(found(), schema, 500)

    costs = materialize(sorted_(parts).mapInArrow(reduced, f"conv_id {kind}, piece long, costs array<long>"), "piece-costs")
    ends = materialize(costs.repartition("conv_id").sortWithinPartitions("conv_id", "piece")
                       .mapInArrow(borders, f"conv_id {kind}, piece long, ends array<long>, last boolean"), "piece-borders")
    ends = ends.select(F.col("conv_id").alias("of"), F.col("piece").alias("in"), "ends", "last")
    priced = parts.join(ends, parts["conv_id"].eqNullSafe(ends["of"]) & (parts["piece"] == ends["in"])).drop("of", "in")

    def traced(batches):
        def found():
            for (conv, piece), group in _groups(batches, keys, ["place", "initial", "fault", "ends", "last"]):
                units, out, last = units_of(group), group[0][3], group[0][4]
                price = prices(units, ENDS if last else out)
                for entry in range(4):
                    if price[0][entry] >= NEVER:
                        continue
                    path, tail, exit_ = trace(units, price, ENDS if last else out, entry)
                    for (place, *_), (state, letters) in zip(group, path):
                        yield conv, place, state, letters, False, entry, piece, exit_
                    # insertions at a border are the next piece's: a border's own price is that of the state it has
                    yield conv, group[-1][0], tail[0], tail[1], True, entry, piece, exit_
        schema = pa.schema([("conv_id", pa_type), ("place", pa.int64()), ("state", pa.int32()), ("letters", pa.string()),
                            ("tail", pa.bool_()), ("entry", pa.int32()), ("piece", pa.int64()), ("exit", pa.int32())])
        yield from _batches(found(), schema)

    ways = materialize(sorted_(priced).mapInArrow(traced, f"{shape}, entry int, piece long, exit int"), "piece-ways")

    def chained(batches):
        def found():
            for (conv,), group in _groups(batches, ["conv_id"], ["piece", "entry", "exit"]):
                state, now, done = 0, None, None
                for piece, entry, exit_ in group:
                    if piece != now:
                        now, state = piece, (done if now is not None else 0)
                    if entry == state:
                        done = exit_
                        yield conv, piece, entry
        schema = pa.schema([("conv_id", pa_type), ("piece", pa.int64()), ("entry", pa.int32())])
        yield from _batches(found(), schema)

    maps = ways.filter("tail").select("conv_id", "piece", "entry", "exit")
    taken = materialize(maps.repartition("conv_id").sortWithinPartitions("conv_id", "piece", "entry")
                        .mapInArrow(chained, f"conv_id {kind}, piece long, entry int"), "piece-entries")
    taken = taken.select(F.col("conv_id").alias("of"), F.col("piece").alias("in"), F.col("entry").alias("from"))
    mine = ways.join(taken, ways["conv_id"].eqNullSafe(taken["of"]) & (ways["piece"] == taken["in"])
                     & (ways["entry"] == taken["from"])).filter("not tail or letters != ''")
    return edits.unionByName(mine.select("conv_id", "place", "state", "letters", "tail"))


# ---- results

def _stream(turns: DataFrame, emit, schema: str) -> DataFrame:
    """Every conversation's rows and edits in order, one text at a time, through ``emit(conv, steps)``.

    A step is (edit, role, text, fault, row): an inserted turn has no row, other steps have (turn, initial).
    """
    placed = ordered_rows(turns)
    faults = _faults(placed)
    edits = materialize(_edits(faults), "conversation-edits")
    flags = faults.select(F.col("place").alias("at"), "fault")
    kind = placed.schema["turn"].dataType.simpleString()
    conv = placed.schema["conv_id"].dataType.simpleString()
    both = (placed.join(flags, placed["place"] == flags["at"])
            .select("conv_id", "place", F.lit(1).alias("part"), "turn", "role", "text", "fault",
                    F.lit(None).cast("int").alias("state"), F.lit(None).cast("string").alias("letters"))
            .unionByName(edits.select("conv_id", "place", F.when(F.col("tail"), 2).otherwise(0).alias("part"),
                                      F.lit(None).cast(kind).alias("turn"), F.lit(None).cast("string").alias("role"),
                                      F.lit(None).cast("string").alias("text"), F.lit(None).cast("int").alias("fault"),
                                      "state", "letters")))

    def steps(rows):
        state, letters = 0, ""
        for _, part, turn, role, text, fault, now, edit in rows:
            if part != 1:
                state, letters = now, edit
            if part == 0:
                continue
            for letter in letters:
                wanted = WANTED[state]
                if letter == "I":
                    yield "I", ROLE[wanted], "", 0, None
                else:
                    yield letter, ROLE[wanted] if letter == "R" else role, text, fault, (turn, role[:1])
                if letter != "D":
                    state = NEXT[state][role[:1] if letter == "K" else wanted]

    def run(batches):
        columns = ["conv_id", "place", "part", "turn", "role", "text", "fault", "state", "letters"]

        def rows():
            for batch in batches:
                for at in range(0, batch.num_rows, 64):
                    yield from zip(*[batch.column(c).slice(at, 64).to_pylist() for c in columns])

        flow = rows()
        row = next(flow, None)
        while row is not None:
            conv_id, rest = row[0], []

            def own(first=row, conv_id=conv_id, rest=rest):
                yield first[1:]
                for other in flow:
                    if other[0] != conv_id:
                        rest.append(other)
                        return
                    yield other[1:]

            yield from emit(conv_id, steps(own()))
            row = rest[0] if rest else None

    return (both.repartition("conv_id").sortWithinPartitions("conv_id", "place", "part")
            .mapInArrow(run, schema.format(conv=conv, turn=kind)))


def _arrow(kind: str) -> pa.DataType:
    return {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]


def repaired_turns(turns: DataFrame) -> DataFrame:
    """The repaired conversations, a row per step: conv_id, step, edit (K, R, D or I), role, text, source_turn.

    Rows with edit D are those taken out; without them the rows are the repaired conversation in order of step.
    """
    conv, turn = (_arrow(turns.schema[c].dataType.simpleString()) for c in ("conv_id", "turn"))

    def emit(conv_id, steps):
        schema = pa.schema([("conv_id", conv), ("step", pa.int64()), ("edit", pa.string()), ("role", pa.string()),
                            ("text", pa.string()), ("source_turn", turn)])
        yield from _batches(((conv_id, i, edit, role, text, row and row[0])
                             for i, (edit, role, text, _, row) in enumerate(steps)), schema, 200)

    return _stream(turns, emit, "conv_id {conv}, step long, edit string, role string, text string, source_turn {turn}")


def repair_report(turns: DataFrame) -> DataFrame:
    """One row per conversation that has rows: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256 (of the repaired ``role:text``, newline-joined)."""
    conv = _arrow(turns.schema["conv_id"].dataType.simpleString())

    def emit(conv_id, steps):
        found, illegal, cost, audit, sha = [0, 0, 0, 0], 0, 0, [], hashlib.sha256()
        low = high = last = None
        distinct, before, lines = 0, None, 0
        for edit, role, text, fault, row in steps:
            audit.append(edit)
            cost += {"K": KEEP, "R": REROLE, "D": DELETE, "I": INSERT}[edit] + (TRUNCATED if fault == CUT and edit != "D" else 0)
            if row is not None:
                turn, initial = row
                found[fault] += 1
                illegal += before is not None and before + initial not in ("su", "ua", "au")
                before = initial
                if turn is not None:
                    low = turn if low is None else low
                    distinct += last != turn
                    high = last = turn
            if edit != "D":
                sha.update(("\n" * (lines > 0) + f"{role}:{text}").encode("utf-8", "surrogatepass"))
                lines += 1
        yield pa.RecordBatch.from_pydict({
            "conv_id": pa.array([conv_id], conv), "gaps": pa.array([0 if low is None else high - low + 1 - distinct], pa.int64()),
            **{name: pa.array([found[i]], pa.int64()) for i, name in ((BLANK, "blank"), (DUPLICATE, "duplicate"), (CUT, "truncated"))},
            "illegal": pa.array([illegal], pa.int64()), "cost": pa.array([cost], pa.int64()),
            "audit": pa.array(["".join(audit)], pa.string()), "repaired_sha256": pa.array([sha.hexdigest()], pa.string())})

    return _stream(turns, emit, "conv_id {conv}, gaps long, blank long, duplicate long, truncated long, illegal long, "
                                "cost long, audit string, repaired_sha256 string")


def damaged(turns: DataFrame) -> DataFrame:
    """The contract's damage, by crc32(conv_id:turn) % 20: 0 drops a row, 1 empties its text, 2 removes its ``[.!?]``,
    3 repeats it, 4 sets its role to user. Nulls count as one space."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.pmod(F.crc32(F.concat_ws(":", text("conv_id"), text("turn"))), F.lit(20))
    return (turns.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), kind.alias("kind"))
            .filter("kind != 0")
            .select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
                    F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", ""))
                    .otherwise(F.col("text")).alias("text"),
                    F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))
            .drop("copy"))


def conversation_repairs(turns: DataFrame) -> DataFrame:
    """The report on the damaged table for every original conv_id; without rows: zeros, no edits, the hash of ''."""
    report = repair_report(damaged(turns)).withColumnRenamed("conv_id", "of")
    every = turns.select("conv_id").distinct()
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return (every.join(report, every["conv_id"].eqNullSafe(report["of"]), "left")
            .select("conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in numbers],
                    F.coalesce("audit", F.lit("")).alias("audit"),
                    F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256")))
