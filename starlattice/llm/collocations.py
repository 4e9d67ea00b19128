"""Operator 12, phrase collocation mining with broadcast double-array tries.

Texts are lower-cased (A-Z only), split into pieces at ``. , ; : ! ?`` and line ends, and pieces into
words at spaces and tabs. Per language f(phrase) counts all contiguous occurrences inside pieces. A
phrase of two to ``max_words`` words that occurs ``least`` times or more is a candidate; its score and
the drop rule are in :func:`collocations`.

Texts are read, split and numbered once: a row holds the distinct words of a stretch of text, the stretch as numbers
of these words, and a bit for each word that begins a piece. All later passes read these rows.

Level by level, for phrases of k words:

1. every place whose two phrases of k - 1 words passed the level before is hashed to one of 2^42 counters. Tasks send the
   counters they used as sorted runs, dealt by counter, so each is summed in one place. A counter never falls short of the
   count of a phrase in it, so counters below ``least`` rule their phrases out, and no frequent phrase is lost. There are
   far more counters than places, whatever the corpus, so hardly any other phrase is left;
2. the counters that are left make a filter of 16 bits for each (2^28 bits at most), which is broadcast. Phrases of the
   places that it lets through are made distinct (tasks send sets, dealt by counter), and those of which either part of k - 1 words is
   not frequent go (two semi-joins): that leaves the Apriori-safe candidates;
3. candidates are range-partitioned into shards of about 200,000 phrases. A task packs each shard into a
   double-array trie (language, then two digits a word); shards of 40 MB together are broadcast at a time. A task looks up the
   words of a stretch once for all shards. Each shard takes the positions whose first word begins one of its phrases, so
   a position is walked in about one shard, however many there are; the states of all these positions move
   through the trie at the same time, one level after the other; positions without a transition
   leave. ``bincount`` counts the accepting states; a task sends its counts once, as blocks of an array,
   and these are added up over the tasks.

What is broadcast is bounded: the filter (32 MB), or 40 MB of shards. With more candidates there are more
passes, each over the rows of the languages in its shards. Words of one text never need a
dictionary of the whole corpus: a shard brings the words that it uses.

Defined results: null text is empty, null lang is ``und``. A text without words, an empty table or no
candidate gives no rows. Repeated rows count as often as they occur. Ties are settled by a (descending)
and phrase in UTF-8 byte order. Very long texts are cut between pieces, so memory is bounded
by the longest piece. Only text and lang are read, so other columns cannot clash.
"""

from __future__ import annotations

import io
import sys
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starlattice.llm.common import materialize, ship_with_tasks, text_or_empty

ship_with_tasks(sys.modules[__name__])

LEAST = 10
MAX_WORDS = 3
TOP = 2_000
INSIDE_PERCENT = 50
SHARD_PHRASES = 200_000
#: size of the packed tries that are broadcast at a time
PASS_BYTES = 40 << 20
#: bytes of text handled at once, and entries of a task's tables before they are sent
STRETCH, FLUSH = 2 << 20, 150_000
COUNTER_BITS = 42
#: counters are dealt by their first bits; the others fill 32 bits at most
DEALT_BITS = 10
#: places hashed before a task sorts and sends their counters
RUN = 4 << 20
FILTER_BITS, BITS_EACH = 28, 16
SPREAD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)
#: rows of numbered text are large: few of them are held at a time by their readers
ROW_GROUPS = {"compression": "zstd", "parquet.block.size": 16 << 20, "parquet.block.size.row.check.min": 4, "parquet.block.size.row.check.max": 4,
              "parquet.page.size.row.check.min": 1, "parquet.page.size.row.check.max": 4}
PAGE = 4_096
#: about how many candidates are united at a time
PART_PHRASES = 20_000
RANKED_AT_ONCE = 100_000
DIGIT = 2_048

_FROM = b".,;:!?\n\x0b\x0c\r\tABCDEFGHIJKLMNOPQRSTUVWXYZ"
_TO = b"\n" * 10 + b" abcdefghijklmnopqrstuvwxyz"
NORMAL = bytes.maketrans(_FROM, _TO)
#: stands between pieces and never is a word
BREAK = b"\n"


# ---- texts as arrays of word numbers

def _rows(batches, columns: tuple[str, ...], at_once: int = 256) -> Iterator[tuple]:
    """Rows as tuples, a few of them as Python objects at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, at_once):
            yield from zip(*[batch.column(c).slice(at, at_once).to_pylist() for c in columns])


def stretches(batches) -> Iterator[tuple[str, bytes]]:
    """(lang, normalised text of about ``STRETCH`` bytes); texts are parted by a piece end."""
    waiting: dict[str, list[bytes]] = {}
    held: Counter = Counter()
    total = 0
    for lang, text in _rows(batches, ("lang", "text")):
        data = text.encode("utf-8", "surrogatepass").translate(NORMAL)
        at = 0
        while len(data) - at > STRETCH:  # a very long text is cut at the last piece end within reach
            cut = data.rfind(BREAK, at, at + STRETCH)
            cut = cut if cut >= 0 else data.find(BREAK, at + STRETCH)
            if cut < 0:
                break
            yield lang, data[at:cut]
            at = cut + 1
        rest = data[at:] if at else data
        waiting.setdefault(lang, []).append(rest)
        held[lang] += len(rest) + 1
        total += len(rest) + 1
        if held[lang] >= STRETCH:
            total -= held.pop(lang)
            yield lang, BREAK.join(waiting.pop(lang))
        elif total >= 4 * STRETCH:  # many languages
            for each in list(waiting):
                yield each, BREAK.join(waiting.pop(each))
            held.clear()
            total = 0
    for lang, texts in waiting.items():
        yield lang, BREAK.join(texts)


def numbered(data: bytes) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The distinct words, the text as their numbers, and the number of the piece of each word."""
    raw = np.frombuffer(data, np.uint8)
    ends = raw == 10
    gap = ends | (raw == 32)
    edges = np.flatnonzero(np.diff(gap, prepend=True, append=True))  # a word begins, a word is over, and so on
    starts, over = edges[::2], edges[1::2]
    offsets = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(over - starts, out=offsets[1:])
    words = pa.BinaryArray.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(raw[~gap])])
    coded = words.dictionary_encode()
    _, bounds, text = coded.dictionary.buffers()
    bounds, text = np.frombuffer(bounds, np.int32).tolist()[:len(coded.dictionary) + 1], text.to_pybytes() if text else b""
    return ([text[a:b] for a, b in zip(bounds, bounds[1:])], coded.indices.to_numpy().astype(np.int64),
            np.searchsorted(np.flatnonzero(ends), starts))


def encoded(texts: DataFrame) -> DataFrame:
    """The texts as rows of a stretch each: lang, its distinct words, their numbers in order, a bit where a piece begins."""
    def run(batches):
        for lang, data in stretches(batches):
            words, ids, piece = numbered(data)
            if len(ids):
                yield pa.RecordBatch.from_pydict({
                    "lang": pa.array([lang], pa.string()), "words": pa.array([BREAK.join(words)], pa.binary()),
                    "ids": pa.array([ids.astype(np.uint16 if len(words) <= 1 << 16 else np.uint32).tobytes()], pa.binary()),
                    "begins": pa.array([np.packbits(np.diff(piece, prepend=-1) > 0).tobytes()], pa.binary())})

    return texts.mapInArrow(run, "lang string, words binary, ids binary, begins binary")


def decoded(batches) -> Iterator[tuple[str, list[bytes], np.ndarray, np.ndarray]]:
    """(lang, words, ids, piece) of the rows of :func:`encoded`."""
    for lang, words, ids, begins in _rows(batches, ("lang", "words", "ids", "begins"), 1):
        words = words.split(BREAK)
        ids = np.frombuffer(ids, np.uint16 if len(words) <= 1 << 16 else np.uint32).astype(np.int64)
        yield lang, words, ids, np.cumsum(np.unpackbits(np.frombuffer(begins, np.uint8), count=len(ids)), dtype=np.int64)


def whole(piece: np.ndarray, k: int) -> np.ndarray:
    """Positions at which k words of one piece begin."""
    n = max(0, len(piece) - k + 1)
    return np.flatnonzero(piece[:n] == piece[k - 1:]) if n else np.empty(0, np.int64)


# ---- counters

class Hashes:
    """Counters of the phrases in a stretch of text."""

    def __init__(self, lang: str, words: list[bytes], ids: np.ndarray, bits: int):
        from xxhash import xxh64_intdigest

        self.bits, self.start = bits, xxh64_intdigest(lang.encode("utf-8", "surrogatepass"))
        self.of = np.fromiter(map(xxh64_intdigest, words), np.uint64, len(words))[ids]

    def counters(self, pos: np.ndarray, k: int) -> np.ndarray:
        """The counter of the phrase of k words at each position."""
        out = np.full(len(pos), self.start, np.uint64)
        for j in range(k):
            out = out * np.uint64(31) + self.of[pos + j]
            out = (out ^ (out >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
        return (out >> np.uint64(64 - self.bits)).astype(np.int64)


class Runs:
    """Counters that a task used, each with its count (255 at most), sorted and cut by their first bits."""

    def __init__(self, bits: int):
        self.rest = bits - min(bits, DEALT_BITS)
        self.held, self.size = [], 0

    def add(self, at: np.ndarray) -> bool:
        """Whether it is time to send."""
        self.held.append(at)
        self.size += len(at)
        return self.size >= RUN

    def rows(self):
        if not self.size:
            return
        at = np.sort(np.concatenate(self.held))
        self.held, self.size = [], 0
        first = np.flatnonzero(np.diff(at, prepend=-1))
        counts = np.minimum(np.diff(first, append=len(at)), 255).astype(np.uint8)
        at = at[first]
        dealt = at >> self.rest
        at = (at & ((1 << self.rest) - 1)).astype(np.uint32)
        cuts = np.flatnonzero(np.diff(dealt, prepend=-1))
        until = np.r_[cuts[1:], len(at)]
        for i in range(0, len(cuts), 64):
            some = list(zip(cuts[i:i + 64].tolist(), until[i:i + 64].tolist()))
            yield pa.RecordBatch.from_pydict({
                "dealt": pa.array(dealt[cuts[i:i + 64]], pa.int64()), "at": pa.array([at[a:b].tobytes() for a, b in some], pa.binary()),
                "counts": pa.array([counts[a:b].tobytes() for a, b in some], pa.binary())})


def _enough(runs: DataFrame, least: int) -> DataFrame:
    """(dealt, n, at) of the counters that reached ``least`` over all tasks."""
    def run(batches):
        key, held = None, []

        def sent():
            each = np.sort(np.concatenate(held))
            at, counts = each >> np.uint64(8), (each & np.uint64(255)).astype(np.int64)
            first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
            at = at[first][np.add.reduceat(counts, first) >= min(least, 255)].astype(np.uint32)
            return pa.RecordBatch.from_pydict({"dealt": pa.array([key], pa.int64()), "n": pa.array([len(at)], pa.int64()),
                                               "at": pa.array([at.tobytes()], pa.binary())})

        for dealt, at, counts in _rows(batches, ("dealt", "at", "counts"), 16):
            if dealt != key:
                if held:
                    yield sent()
                key, held = dealt, []
            held.append(np.frombuffer(at, np.uint32).astype(np.uint64) << np.uint64(8) | np.frombuffer(counts, np.uint8))
        if held:
            yield sent()

    return runs.repartition("dealt").sortWithinPartitions("dealt").mapInArrow(run, "dealt long, n long, at binary")


class Likely:
    """Which counters may have reached the threshold: some bits each, in a slice of the filter for each first bits."""

    def __init__(self, bits: int, packed: np.ndarray, slice_bits: int):
        self.rest, self.packed, self.slice_bits = bits - min(bits, DEALT_BITS), packed, slice_bits

    @staticmethod
    def places(at: np.ndarray, slice_bits: int) -> Iterator[np.ndarray]:
        for by in SPREAD:
            yield ((at.astype(np.uint64) + np.uint64(1)) * np.uint64(by) >> np.uint64(64 - slice_bits)).astype(np.int64)

    def has(self, at: np.ndarray) -> np.ndarray:
        found = np.ones(len(at), bool)
        slice_of = (at >> self.rest) << self.slice_bits
        for place in self.places(at & ((1 << self.rest) - 1), self.slice_bits):
            place += slice_of
            found &= (self.packed[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
        return found


def likely_phrases(coded: DataFrame, k: int, least: int, before, bits: int) -> tuple[int, tuple]:
    """How many counters of phrases of k words reached ``least``, and what makes their :class:`Likely`.

    ``before`` is the broadcast filter of the level before, if there is one."""
    def run(batches):
        runs, parts = Runs(bits), Likely(bits, *before.value) if before else None
        for lang, words, ids, piece in decoded(batches):
            hashes, pos = Hashes(lang, words, ids, bits), whole(piece, k)
            if parts:
                part = whole(piece, k - 1)
                passed = np.zeros(len(ids) + 1, bool)
                passed[part] = parts.has(hashes.counters(part, k - 1))
                pos = pos[passed[pos] & passed[pos + 1]]
            if runs.add(hashes.counters(pos, k)):
                yield from runs.rows()
        yield from runs.rows()

    found = materialize(_enough(coded.mapInArrow(run, "dealt long, at binary, counts binary"), least), f"phrase-counters-{k}")
    heavy = found.agg(F.sum("n")).first()[0] or 0
    slices = 1 << min(bits, DEALT_BITS)
    slice_bits = min(FILTER_BITS - slices.bit_length() + 1, max(3, (BITS_EACH * heavy // slices).bit_length()))

    def packed(batches):
        for dealt, at in _rows(batches, ("dealt", "at"), 1):
            own = np.zeros(1 << slice_bits, bool)
            for place in Likely.places(np.frombuffer(at, np.uint32), slice_bits):
                own[place] = True
            yield pa.RecordBatch.from_pydict({"dealt": pa.array([dealt], pa.int64()), "own": pa.array(
                [np.packbits(own, bitorder="little").tobytes()], pa.binary())})

    out = np.zeros((slices, (1 << slice_bits) // 8), np.uint8)
    for row in found.filter("n > 0").select("dealt", "at").mapInArrow(packed, "dealt long, own binary").toLocalIterator():
        out[row["dealt"]] = np.frombuffer(row["own"], np.uint8)
    return heavy, (out.reshape(-1), slice_bits)


# ---- candidates

def _distinct_phrases(coded: DataFrame, k: int, likely, heavy: int, bits: int) -> DataFrame:
    """(lang, phrase) of the phrases of k words whose counter reached the threshold, as ``heavy`` counters did.

    A task sends its phrases as one row for each part of the counters, of which there are as many as keep a part's
    phrases few; the rows of a part are united where they arrive.
    """
    parts = max(int(coded.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-heavy // PART_PHRASES))

    def run(batches):
        found: dict[tuple[str, int], set] = {}
        size, enough = 0, Likely(bits, *likely.value)

        def sent():
            return pa.RecordBatch.from_pydict({
                "lang": pa.array([lang for lang, _ in found], pa.string()), "part": pa.array([p for _, p in found], pa.int64()),
                "phrases": pa.array([BREAK.join(x) for x in found.values()], pa.binary())})

        for lang, words, ids, piece in decoded(batches):
            pos = whole(piece, k)
            if not len(pos):
                continue
            at = Hashes(lang, words, ids, bits).counters(pos, k)
            passed = enough.has(at)
            pos, at = pos[passed], at[passed]
            if not len(pos):
                continue
            code = ids[pos]
            for j in range(1, k):  # numbered anew with every further word, so codes stay small
                code = pd.factorize(code * len(words) + ids[pos + j])[0]
            first = np.empty(int(code.max()) + 1, np.int64)
            first[code] = np.arange(len(pos))
            first = first[np.argsort(at[first] % parts, kind="stable")]
            part, pos = at[first] % parts, pos[first]
            phrases = list(map(b" ".join, zip(*[map(words.__getitem__, ids[pos + j].tolist()) for j in range(k)])))
            cuts = np.flatnonzero(np.diff(part, prepend=-1)).tolist()
            for a, b in zip(cuts, [*cuts[1:], len(phrases)]):
                mine = found.setdefault((lang, int(part[a])), set())
                size -= len(mine)
                mine.update(phrases[a:b])
                size += len(mine)
            if size > 2 * FLUSH:
                yield sent()
                found, size = {}, 0
        if found:
            yield sent()

    def united(batches):
        key, phrases = None, set()

        def sent():
            return pa.RecordBatch.from_pydict({"lang": pa.array([key[0]] * len(phrases), pa.string()),
                                               "phrase": pa.array(list(phrases), pa.binary()).cast(pa.string())})

        for lang, part, some in _rows(batches, ("lang", "part", "phrases"), 16):
            if (lang, part) != key:
                if phrases:
                    yield sent()
                key, phrases = (lang, part), set()
            phrases.update(some.split(BREAK))
        if phrases:
            yield sent()

    sent = coded.mapInArrow(run, "lang string, part long, phrases binary")
    return (sent.repartition("lang", "part").sortWithinPartitions("lang", "part")
            .mapInArrow(united, "lang string, phrase string"))


def _parts(k: int) -> tuple:
    """The first and the last k - 1 words of a phrase of k."""
    return F.substring_index("phrase", " ", k - 1), F.substring_index("phrase", " ", -(k - 1))


def safe_candidates(coded: DataFrame, k: int, frequent: DataFrame, likely, heavy: int, bits: int) -> DataFrame:
    """(lang, phrase) of k words all of whose parts are frequent."""
    found = _distinct_phrases(coded, k, likely, heavy, bits)
    for part in _parts(k):
        own = found.withColumn("part", part)
        known = frequent.select(F.col("lang").alias("l"), F.col("phrase").alias("p"))
        found = own.join(known, (own["lang"] == known["l"]) & (own["part"] == known["p"]), "left_semi").drop("part")
    return materialize(found, f"phrase-candidates-{k}")


# ---- double arrays

def _placed(parent: np.ndarray, digit: np.ndarray, nodes: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Give every node a cell: base of its parent plus its digit, cells unique. Edges are sorted by parent, edge e leads
    to node e + 1. Returns (cell of each node, base of each node, size).

    Nodes with many children are placed first, all of like size at once: each tries a random base, and those
    whose cells are free and their own stay. Only children fill the free cells in order.
    """
    rng = np.random.default_rng(seed)
    edges = len(parent)
    starts = np.flatnonzero(np.r_[True, parent[1:] != parent[:-1]]) if edges else np.empty(0, np.int64)
    owners, counts = parent[starts], np.diff(np.r_[starts, edges])
    size = 2 * edges + 4 * DIGIT
    taken = np.zeros(size, bool)
    taken[0] = True  # the root
    base = np.zeros(nodes, np.int64)
    cell = np.zeros(nodes, np.int64)

    def edges_of(which):
        of = np.repeat(np.arange(len(which)), counts[which])
        first = np.repeat(np.cumsum(counts[which]) - counts[which], counts[which])
        return of, starts[which][of] + np.arange(len(of)) - first

    mark = np.zeros(size, np.int64)
    top = int(counts.max()) if edges else 0
    while top > 1:
        left = np.flatnonzero((counts <= top) & (counts > max(1, top // 2)))
        tries = 0
        while len(left):
            if tries == 60:  # no luck: room of their own behind the others
                more = np.arange(len(left)) * DIGIT + size
                size += len(left) * DIGIT
                taken, mark = np.r_[taken, np.zeros(len(left) * DIGIT, bool)], np.r_[mark, np.zeros(len(left) * DIGIT, np.int64)]
                at = more
            else:
                at = rng.integers(1, size - DIGIT, len(left))
            of, mine = edges_of(left)
            want = at[of] + digit[mine]
            mark[want] = of
            good = np.ones(len(left), bool)
            good[of[taken[want] | (mark[want] != of)]] = False
            stay = good[of]
            taken[want[stay]] = True
            cell[mine[stay] + 1] = want[stay]
            base[owners[left[good]]] = at[good]
            left = left[~good]
            tries += 1
        top //= 2
    single = starts[counts == 1]
    free = DIGIT + np.flatnonzero(~taken[DIGIT:])
    if len(free) < len(single):
        free = np.r_[free, np.arange(size, size + len(single) - len(free))]
    cell[single + 1] = free[:len(single)]
    base[parent[single]] = cell[single + 1] - digit[single]
    return cell, base, max(size, int(cell.max(initial=0)) + 1) + DIGIT


def _marked(lang: str) -> bytes:
    """A language as a trie's first symbol; no word begins with a line end."""
    return BREAK + lang.encode("utf-8", "surrogatepass")


def pack(phrases: list[tuple[str, str]]) -> bytes:
    """A double-array trie of (lang, phrase), all of equally many words, as bytes.

    ``answer`` has a phrase's place in the list at its accepting cell.
    """
    rows = [[_marked(lang), *phrase.encode("utf-8", "surrogatepass").split(b" ")] for lang, phrase in phrases]
    words = {w: i + 1 for i, w in enumerate(sorted({w for row in rows for w in row}))}
    if len(words) >= DIGIT * DIGIT:
        raise ValueError("too many words in one shard")
    symbols = np.array([[words[w] for w in row] for row in rows], np.int64).reshape(len(rows), -1)
    digits = np.stack([symbols // DIGIT, symbols % DIGIT], axis=2).reshape(len(rows), -1)
    node = np.zeros(len(rows), np.int64)  # of each phrase at this depth, the root at first
    parents, labels, nodes = [], [], 1
    for depth in range(digits.shape[1]):
        key, node = np.unique(node * DIGIT + digits[:, depth], return_inverse=True)
        parents.append(key // DIGIT + (nodes - len(parents[-1]) if parents else 0))
        labels.append(key % DIGIT)
        nodes += len(key)
    parent, label = np.concatenate(parents), np.concatenate(labels)
    cell, base, size = _placed(parent, label, nodes)
    ends = cell[node + nodes - len(parents[-1])]  # of the phrases, in their order
    out = io.BytesIO()
    np.savez(out, size=np.array([size]), cell=cell.astype(np.int32), parent=parent.astype(np.int32),
             base=base[:nodes - len(parents[-1])].astype(np.int32), ends=ends.astype(np.int32),
             first=np.unique(symbols[:, 1]).astype(np.int32),
             text=np.frombuffer(b"".join(words), np.uint8), lengths=np.array([len(w) for w in words], np.int32))
    return out.getvalue()


class Trie:
    """A packed shard, ready to walk."""

    def __init__(self, packed: bytes):
        arrays = np.load(io.BytesIO(packed))
        size, cell, ends = int(arrays["size"][0]), arrays["cell"], arrays["ends"]
        self.base, self.check, self.answer = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
        self.base[cell[:len(arrays["base"])]] = arrays["base"]
        self.check[cell[1:]] = cell[arrays["parent"]]
        self.answer[ends] = np.arange(len(ends), dtype=np.int32)
        self.size, self.first = len(ends), arrays["first"]
        text, until = arrays["text"].tobytes(), np.cumsum(arrays["lengths"]).tolist()
        self.numbers = {text[a:b]: i for i, (a, b) in enumerate(zip([0, *until], until), 1)}

    def step(self, state: np.ndarray, digit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The cells reached, and which of the states have such a transition."""
        cell = self.base[state] + digit
        return cell, self.check[cell] == state

    def start(self, lang: str) -> int | None:
        """The state after a language."""
        known = self.numbers.get(_marked(lang))
        if known is None:
            return None
        state = np.zeros(1, np.int64)
        for digit in (known // DIGIT, known % DIGIT):
            state, ok = self.step(state, np.array([digit]))
            if not ok[0]:
                return None
        return int(state[0])

    def walk(self, start: int, symbols: list[np.ndarray]) -> np.ndarray:
        """How often each accepted phrase occurs, by its place in the shard; symbols: of the first words, of the second, and so on."""
        state, left = np.full(len(symbols[0]), start), None
        for now in symbols:
            now = now if left is None else now[left]
            state, alive = self.step(state, now // DIGIT)
            state, now, left = state[alive], now[alive], np.flatnonzero(alive) if left is None else left[alive]
            state, alive = self.step(state, now % DIGIT)
            state, left = state[alive], left[alive]
        return np.bincount(self.answer[state], minlength=self.size)

    def counts(self, lang: str, words: list[bytes], ids: np.ndarray, piece: np.ndarray, k: int) -> np.ndarray | None:
        """The counts of one stretch of text by this shard alone."""
        start = self.start(lang)
        if start is None:
            return None
        symbols = np.fromiter((self.numbers.get(w, 0) for w in words), np.int64, len(words))[ids]
        pos = _known(symbols, piece, k)
        return self.walk(start, [symbols[pos + level] for level in range(k)])


def _known(symbols: np.ndarray, piece: np.ndarray, k: int) -> np.ndarray:
    """Positions at which k words of one piece begin that all have a symbol."""
    pos = whole(piece, k)
    for level in range(k):
        pos = pos[symbols[pos + level] > 0]
    return pos


class Forest:
    """The shards of one pass, whose words are looked up once for all of them."""

    def __init__(self, shards: list[tuple[int, bytes]]):
        self.tries, self.totals, self.numbers = [], [], {}
        members = []
        for shard, packed in shards:
            trie = Trie(packed)
            own = np.fromiter((self.numbers.setdefault(w, len(self.numbers) + 1) for w in trie.numbers), np.int64, len(trie.numbers))
            members.append(own)  # a trie's own numbers count from 1 in this order
            trie.numbers = {w: n for w, n in trie.numbers.items() if w.startswith(BREAK)}
            self.tries.append((shard, trie))
            self.totals.append(np.zeros(trie.size, np.int64))
        self.local, self.first = [], []
        for own, (_, trie) in zip(members, self.tries):
            local, first = np.zeros(len(self.numbers) + 1, np.int32), np.zeros(len(self.numbers) + 1, bool)
            local[own] = np.arange(1, len(own) + 1)
            first[own[trie.first - 1]] = True
            self.local.append(local)
            self.first.append(first)

    def add(self, lang: str, words: list[bytes], ids: np.ndarray, piece: np.ndarray, k: int) -> None:
        starts = [trie.start(lang) for _, trie in self.tries]
        if len(ids) < k or all(start is None for start in starts):
            return
        symbols = np.fromiter((self.numbers.get(w, 0) for w in words), np.int64, len(words))[ids]
        pos = _known(symbols, piece, k)
        begins = symbols[pos]
        for (_, trie), start, total, local, first in zip(self.tries, starts, self.totals, self.local, self.first):
            if start is not None:
                mine = pos[first[begins]]
                if len(mine):
                    total += trie.walk(start, [local[symbols[mine + level]] for level in range(k)])


def _count(coded: DataFrame, k: int, shards) -> DataFrame:
    """(shard, block, counts) of the phrases in a few broadcast shards, per task."""
    def run(batches):
        forest = Forest(shards.value)
        for row in decoded(batches):
            forest.add(*row, k)
        for (shard, _), total in zip(forest.tries, forest.totals):
            rows = np.pad(total, (0, -len(total) % PAGE)).reshape(-1, PAGE)
            used = np.flatnonzero(rows.any(axis=1))
            if len(used):
                yield pa.RecordBatch.from_pydict({
                    "shard": pa.array(np.full(len(used), shard, np.int32)), "block": pa.array(used),
                    "counts": pa.array([zlib.compress(r, 1) for r in rows[used]], pa.binary())})

    return coded.mapInArrow(run, "shard int, block long, counts binary")


def _summed(counted: DataFrame, least: int) -> DataFrame:
    """(shard, id, f) of the phrases counted ``least`` times or more: the tasks' arrays added up, block by block."""
    def run(batches):
        key, total = None, None

        def sent():
            at = np.flatnonzero(total >= least)
            return pa.RecordBatch.from_pydict({"shard": pa.array(np.full(len(at), key[0], np.int32)),
                                               "id": pa.array(at + key[1] * PAGE), "f": pa.array(total[at])})

        for shard, block, counts in _rows(batches, ("shard", "block", "counts")):
            if (shard, block) != key:
                if key:
                    yield sent()
                key, total = (shard, block), np.zeros(PAGE, np.int64)
            total += np.frombuffer(zlib.decompress(counts), np.int64)
        if key:
            yield sent()

    return (counted.repartition("shard", "block").sortWithinPartitions("shard", "block")
            .mapInArrow(run, "shard int, id long, f long"))


def _packed(batches):
    """Rows sorted by shard and id to one row per shard: shard, first_lang, last_lang, phrases, packed."""
    shard, phrases = None, []

    def sent():
        trie = pack(phrases)
        return pa.RecordBatch.from_pydict({
            "shard": pa.array([shard], pa.int32()), "first_lang": pa.array([phrases[0][0]], pa.string()),
            "last_lang": pa.array([phrases[-1][0]], pa.string()), "phrases": pa.array([len(phrases)], pa.int64()),
            "size": pa.array([len(trie)], pa.int64()), "packed": pa.array([trie], pa.binary())})

    for batch in batches:
        for s, lang, phrase in zip(*[batch.column(c).to_pylist() for c in ("shard", "lang", "phrase")]):
            if s != shard and phrases:
                yield sent()
                phrases = []
            shard = s
            phrases.append((lang, phrase))
    if phrases:
        yield sent()


def frequent_phrases(coded: DataFrame, candidates: DataFrame, k: int, least: int, shard_phrases: int, pass_bytes: int) -> DataFrame:
    """(lang, phrase, f) of the candidates of k words with f of ``least`` or more."""
    sc = coded.sparkSession.sparkContext
    rows, size = candidates.agg(F.count(F.lit(1)), F.sum(F.octet_length("phrase") + F.octet_length("lang"))).first()
    shards = max(1, -(-rows // shard_phrases), -(-(size or 0) // (64 * shard_phrases)))
    place = F.monotonically_increasing_id()
    keyed = materialize(candidates.repartitionByRange(shards, "lang", "phrase").sortWithinPartitions("lang", "phrase")
                        .withColumn("place", place)
                        .select("lang", "phrase", F.shiftright("place", 33).cast("int").alias("shard"),
                                F.col("place").bitwiseAND((1 << 33) - 1).alias("id")), f"phrase-shards-{k}")
    tries = materialize(keyed.repartition(shards, "shard").sortWithinPartitions("shard", "id").select("shard", "lang", "phrase")
                        .mapInArrow(_packed, "shard int, first_lang string, last_lang string, phrases long, size long, packed binary"),
                        f"phrase-tries-{k}")
    counted, todo = None, tries.drop("packed").orderBy("shard").collect()
    while todo:  # as many shards as the bound allows, at least one, per pass over the texts of their languages
        some, held = [todo.pop(0)], 0
        while todo and (held := held + some[-1]["size"]) + todo[0]["size"] <= pass_bytes:
            some.append(todo.pop(0))
        packed = tries.filter(F.col("shard").between(some[0]["shard"], some[-1]["shard"])).select("shard", "packed")
        sent = sc.broadcast([(r["shard"], bytes(r["packed"])) for r in packed.collect()])
        mine = coded.filter(F.col("lang").between(some[0]["first_lang"], some[-1]["last_lang"]))
        done = materialize(_count(mine, k, sent), f"phrase-counts-{k}")
        sent.destroy()
        counted = done if counted is None else counted.unionByName(done)
    if counted is None:
        return keyed.select("lang", "phrase", F.col("id").alias("f"))  # no candidates, no rows
    sums = _summed(counted, least)
    return materialize(keyed.join(sums, ["shard", "id"]).select("lang", "phrase", "f"), f"phrases-{k}")


# ---- words

def word_counts(coded: DataFrame) -> DataFrame:
    """(lang, phrase, f) of all words, per task and about a million words."""
    def run(batches):
        held, size = [], 0

        def sent():
            some = pa.concat_tables(held).group_by(["lang", "phrase"]).aggregate([("f", "sum")])
            some = some.select(["lang", "phrase", "f_sum"]).rename_columns(["lang", "phrase", "f"])
            return some.set_column(1, "phrase", some["phrase"].cast(pa.string())).to_batches(max_chunksize=100_000)

        for lang, words, ids, _ in decoded(batches):
            held.append(pa.table({"lang": pa.array([lang] * len(words), pa.string()), "phrase": pa.array(words, pa.binary()),
                                  "f": pa.array(np.bincount(ids, minlength=len(words)), pa.int64())}))
            size += len(words)
            if size > 6 * FLUSH:
                yield from sent()
                held, size = [], 0
        if held:
            yield from sent()

    return coded.mapInArrow(run, "lang string, phrase string, f long")


# ---- the operator

def _scored(levels: dict[int, DataFrame]) -> DataFrame:
    """(lang, phrase, words, a, l, r, score): the cut with the lowest score, of equal ones the first."""
    out = None
    for k, phrases in levels.items():
        if k < 2:
            continue
        cuts = phrases.withColumn("words", F.lit(k)).withColumnRenamed("f", "a")
        for cut in range(1, k):
            for side, n, part in (("l", cut, F.substring_index("phrase", " ", cut)),
                                  ("r", k - cut, F.substring_index("phrase", " ", cut - k))):
                known = levels[n].select(F.col("lang").alias("of"), F.col("phrase").alias("is"), F.col("f").alias(f"{side}{cut}"))
                cuts = cuts.withColumn("part", part)
                cuts = cuts.join(known, (cuts["lang"] == known["of"]) & (cuts["part"] == known["is"])).drop("of", "is", "part")
        wide = [f"cast({c} as decimal(38,0))" for c in ("a", "{}", "{}")]
        options = [F.struct(F.expr(f"(1000000BD * {wide[0]} * a) div ({wide[1].format(f'l{c}')} * {wide[2].format(f'r{c}')})")
                            .cast("long").alias("score"), F.lit(c).alias("cut"),
                            F.col(f"l{c}").alias("l"), F.col(f"r{c}").alias("r")) for c in range(1, k)]
        best = cuts.withColumn("best", F.array_min(F.array(*options)))
        best = best.select("lang", "phrase", "words", "a", "best.l", "best.r", "best.score")
        out = best if out is None else out.unionByName(best)
    return out


def collocations(docs: DataFrame, least: int = LEAST, max_words: int = MAX_WORDS, top: int = TOP,
                 inside_percent: int = INSIDE_PERCENT, shard_phrases: int = SHARD_PHRASES, pass_bytes: int = PASS_BYTES,
                 counter_bits: int = COUNTER_BITS) -> DataFrame:
    """The first ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Cutting a candidate after its first words gives l = f(first part) and r = f(rest); score is
    floor(1000000 * a * a / (l * r)) of the lowest-scoring cut, in decimals of 38 digits (counts up to 10^16).
    A candidate goes when its words lie contiguously inside a longer candidate with
    100 * f(longer) >= ``inside_percent`` * a.
    """
    texts = docs.select(text_or_empty().alias("text"), F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))
    sc = texts.sparkSession.sparkContext
    coded = materialize(encoded(texts), "phrase-texts", **ROW_GROUPS)
    words = materialize(word_counts(coded).groupBy("lang", "phrase").agg(F.sum("f").alias("f")), "phrases-1")
    sizes = words.groupBy(F.col("lang").alias("of")).agg(F.sum("f").alias("n"))
    levels, before = {1: words.filter(F.col("f") >= least)}, None
    for k in range(2, max_words + 1):
        heavy, filter_of = likely_phrases(coded, k, least, before, counter_bits)
        if before:
            before.destroy()
        before = sc.broadcast(filter_of)
        candidates = safe_candidates(coded, k, levels[k - 1], before, heavy, counter_bits)
        levels[k] = frequent_phrases(coded, candidates, k, least, shard_phrases, pass_bytes)
    if before:
        before.destroy()
    scored = materialize(_scored(levels), "phrase-scores")
    # the most frequent longer candidate that holds a phrase
    holders = None
    for k in range(3, max_words + 1):
        for n in range(2, k):
            for first in range(1, k - n + 2):
                piece = F.array_join(F.slice(F.split("phrase", " "), first, n), " ")
                part = levels[k].select(F.col("lang").alias("of"), piece.alias("is"), "f")
                holders = part if holders is None else holders.unionByName(part)
    if holders is not None:
        most = holders.groupBy("of", "is").agg(F.max("f").alias("most"))
        scored = scored.join(most, (scored["lang"] == most["of"]) & (scored["phrase"] == most["is"]), "left").filter(
            F.col("most").isNull() | (F.lit(100) * F.col("most") < F.lit(inside_percent) * F.col("a"))).drop("of", "is", "most")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    # first among a language's phrases of one hash, as often as needed: no task sorts a whole language
    rows = scored.count()
    while rows > max(RANKED_AT_ONCE, 4 * top):
        salts = -(-rows * 2 // max(RANKED_AT_ONCE, 4 * top))
        inside = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase", F.lit(rows)), F.lit(salts))).orderBy(*order)
        scored = scored.withColumn("place", F.row_number().over(inside)).filter(F.col("place") <= top).drop("place")
        rows = salts * top
    ranked = (scored.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
              .filter(F.col("rank") <= top))
    return ranked.join(sizes, ranked["lang"] == sizes["of"]).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
