"""Operator 2, benchmark decontamination with a generalised suffix automaton.

The words of all benchmark items make one suffix automaton. A document's words stream through it and
at each word the length of the longest match that ends there is known. A match of ``window`` words or
more marks its last ``window`` words; an item with fewer words is a window by itself and matches
when the automaton has just read it whole. Marked runs are the spans that exceed the length limit, and
a document is contaminated when they cover more than ``coverage`` of its words.

The automaton is sent to the executors, so its size is bounded: items are cut into pieces (with
``window - 1`` words of overlap, so that no window is lost), pieces are dealt into blocks of about
``block_words`` words by their hash, and the documents stream through one block's automaton after
the other. Nothing is shuffled. Words that no item has end every match, so only runs of known words,
found over arrays, are walked.

Defined results: null and empty texts have no words, no hits and are clean. Items without words have
no windows; a null item_id reads as the empty string; repeated items count once. An empty benchmark
leaves all documents clean. Repeated documents each get their row. Only doc_id, text and item_id are
read.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starlattice.llm.common import materialize, ship_with_tasks, text_or_empty

ship_with_tasks(sys.modules[__name__])

WINDOW = 13
COVERAGE = (1, 20)  # contaminated when hit words are this share of all words, or more
BLOCK_WORDS = 100_000
PIECE_WORDS = 10_000
SEGMENT_BYTES = 4 << 20

# bytes between words become spaces: 0-9, a-z and all bytes of non-ASCII characters stay
TO_WORDS = bytes(b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))
WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().translate(TO_WORDS).split()


class Automaton:
    """Suffix automaton of several word sequences; states know which windows end in them."""

    def __init__(self, window: int):
        self.window = window
        self.ids: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.items: dict[int, set[str]] = {}  # state of a whole window -> items that have it
        self.short: dict[int, dict[int, set[str]]] = {}  # state of short items -> words -> items
        self.short_up: list[int] = []
        self.window_up: list[int] = []
        self.least = window

    def _state(self, length: int, link: int, next_: dict[int, int]) -> int:
        self.next.append(next_)
        self.link.append(link)
        self.length.append(length)
        return len(self.length) - 1

    def _step(self, last: int, c: int) -> int:
        """Appends word c to the sequence that ends in state last."""
        nxt, link, length = self.next, self.link, self.length
        known = nxt[last].get(c)
        if known is not None and length[known] == length[last] + 1:
            return known
        cur = -1 if known is not None else self._state(length[last] + 1, 0, {})
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            if length[q] == length[p] + 1:
                link[cur] = q
            else:
                twin = self._state(length[p] + 1, link[q], dict(nxt[q]))
                while p >= 0 and nxt[p].get(c) == q:
                    nxt[p][c] = twin
                    p = link[p]
                link[q] = twin
                if cur < 0:
                    return twin
                link[cur] = twin
        return cur

    def add(self, words: list[bytes]) -> None:
        last = 0
        for w in words:
            last = self._step(last, self.ids.setdefault(w, len(self.ids)))

    def mark(self, words: list[bytes], item: str, whole: bool) -> None:
        """After all sequences are added: notes the states in which the item's windows end."""
        k = self.window if not whole or len(words) >= self.window else len(words)
        state, size = 0, 0
        for w in words:
            state, size = self.next[state][self.ids[w]], size + 1
            while self.length[self.link[state]] >= k:
                state = self.link[state]
            size = min(size, k)
            if size == k == self.window:
                self.items.setdefault(state, set()).add(item)
        if 0 < k < self.window:
            self.short.setdefault(state, {}).setdefault(k, set()).add(item)
            self.least = min(self.least, k)

    def close(self) -> None:
        """For each state the nearest one up its links (itself included) where a short item ends, and the last
        one up them that still holds a window."""
        order = sorted(range(1, len(self.length)), key=self.length.__getitem__)
        if self.short:
            self.short_up = [-1] * len(self.length)
            for v in order:
                self.short_up[v] = v if v in self.short else self.short_up[self.link[v]]
        self.window_up = [-1] * len(self.length)
        for v in order:
            if self.length[v] >= self.window:
                up = self.link[v]
                self.window_up[v] = self.window_up[up] if self.length[up] >= self.window else v

    def scan(self, words: np.ndarray) -> tuple[list[tuple[int, int]], set[str]]:
        """Marked ranges of word positions, joined, and the items whose windows occur."""
        cuts = np.r_[-1, np.flatnonzero(words < 0), len(words)]
        runs = np.flatnonzero(np.diff(cuts) > self.least)
        nxt, link, length, window = self.next, self.link, self.length, self.window
        spans: list[tuple[int, int]] = []
        items: set[str] = set()
        met: set = set()  # states whose items the document has

        def hit(start: int, end: int) -> None:
            while spans and spans[-1][1] >= start:
                start = min(start, spans[-1][0])
                spans.pop()
            spans.append((start, end))

        for r in runs:
            a, b = int(cuts[r]) + 1, int(cuts[r + 1])
            state, size = 0, 0
            for i, c in enumerate(words[a:b].tolist(), a):
                while state and c not in nxt[state]:
                    state = link[state]
                    size = length[state]
                if c not in nxt[state]:
                    continue
                state, size = nxt[state][c], size + 1
                if size >= window:
                    v = self.window_up[state]
                    if v in self.items:
                        if v not in met:
                            met.add(v)
                            items |= self.items[v]
                        hit(i + 1 - window, i + 1)
                if self.short:
                    v = self.short_up[state]
                    while v > 0:
                        for k, its in self.short[v].items():
                            if v != state or k <= size:
                                if (v, k) not in met:
                                    met.add((v, k))
                                    items |= its
                                hit(i + 1 - k, i + 1)
                        v = self.short_up[link[v]]
        return spans, items


def build(pieces: list[tuple[str, str, bool]], window: int) -> Automaton:
    """pieces: (item, text, whether the piece is the whole item)."""
    automaton = Automaton(window)
    split = [(item, words_of(text), whole) for item, text, whole in pieces]
    for _, words, _ in split:
        automaton.add(words)
    for item, words, whole in split:
        automaton.mark(words, item, whole)
    automaton.close()
    return automaton


def word_ids(text: str, ids: dict[bytes, int]) -> np.ndarray:
    """The document's words as numbers, -1 where no item has the word; long texts go by segments."""
    raw = text.encode("utf-8", "surrogatepass").lower().translate(TO_WORDS)
    parts, at = [], 0
    while at < len(raw):
        end = at + SEGMENT_BYTES
        cut = raw.find(b" ", end) if end < len(raw) else len(raw)
        cut = len(raw) if cut < 0 else cut
        words = raw[at:cut].split()
        parts.append(np.fromiter(map(ids.get, words, repeat(-1)), np.int32, len(words)))
        at = cut
    return np.concatenate(parts) if parts else np.empty(0, np.int32)


def cut_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the marked words and what stands between them."""
    if not spans:
        return text
    places = [m.span() for m in WORD.finditer(text.translate({c: c + 32 for c in range(65, 91)}))]
    kept, at = [], 0
    for a, b in spans:
        kept.append(text[at:places[a][0]])
        at = places[b - 1][1]
    return "".join([*kept, text[at:]])


def _pieces(benchmark: DataFrame, window: int) -> DataFrame:
    def cut(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            rows = []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = words_of(text)
                step = PIECE_WORDS - window + 1
                for at in range(0, max(1, len(words) - window + 1), step):
                    part = words[at:at + PIECE_WORDS]
                    if part:
                        rows.append((item, b" ".join(part).decode("utf-8", "surrogatepass"),
                                     len(words) < window, len(part)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], t) for i, t in
                 enumerate((pa.string(), pa.string(), pa.bool_(), pa.int64()))], ["item", "text", "whole", "words"])

    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
                             text_or_empty().alias("text"))
    return items.mapInArrow(cut, "item string, text string, whole boolean, words long")


STATE = "doc_id long, text_hash long, text string, n_words long, n_hit long, spans array<int>, items array<string>"
ARROW = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.string())]


def _stream(block, last: bool, with_clean_text: bool):
    """One pass of the documents through one automaton; earlier passes' marks are joined in."""
    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(0)
        vars(automaton).update(block.value)
        for batch in it:
            _, _, texts, _, _, old_spans, old_items = [c.to_pylist() for c in batch.columns]
            out: list[list] = [[], [], [], [], []]
            for text, before, had in zip(texts, old_spans, old_items):
                words = word_ids(text or "", automaton.ids)
                spans, items = automaton.scan(words)
                if before:
                    merged: list[tuple[int, int]] = []
                    for a, b in sorted(spans + list(zip(before[::2], before[1::2]))):
                        if merged and merged[-1][1] >= a:
                            merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
                        else:
                            merged.append((a, b))
                    spans = merged
                keep = text if not last else cut_spans(text, spans) if with_clean_text else None
                for column, value in zip(out, (keep, len(words), sum(b - a for a, b in spans),
                                               [x for s in spans for x in s], sorted(items.union(had or ())))):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *[pa.array(v, t) for v, t in zip(out, ARROW[2:])]],
                                             ["doc_id", "text_hash", "text", "n_words", "n_hit", "spans", "items"])
    return batches


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, coverage=COVERAGE,
                   block_words: int = BLOCK_WORDS, with_clean_text: bool = False,
                   with_text_hash: bool = False) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans (pairs of
    word positions, end exclusive) and, if asked for, clean_text without those spans."""
    spark = docs.sparkSession
    pieces = materialize(_pieces(benchmark, window), "benchmark-pieces")
    blocks = max(1, -(-(pieces.agg(F.sum("words")).first()[0] or 0) // block_words))
    of = F.pmod(F.xxhash64("item", "text"), F.lit(blocks))
    state = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_or_empty()).alias("text_hash"),
                        text_or_empty().alias("text"), F.lit(0).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_hit"),
                        F.array().cast("array<int>").alias("spans"), F.array().cast("array<string>").alias("items"))
    for b in range(blocks):
        rows = pieces.filter(of == b).select("item", "text", "whole").distinct().collect()  # about block_words words
        automaton = spark.sparkContext.broadcast(vars(build([tuple(r) for r in rows], window)))
        last = b == blocks - 1
        state = state.mapInArrow(_stream(automaton, last, with_clean_text), STATE)
        if not last:
            state = materialize(state, "decontamination-pass")
    share, whole = coverage
    out = state.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (whole * F.col("n_hit") >= share * F.col("n_words"))).alias("contaminated"),
        "spans", "text_hash", F.col("text").alias("clean_text"))
    return out.drop(*["clean_text"] * (not with_clean_text), *["text_hash"] * (not with_text_hash))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, coverage=COVERAGE) -> DataFrame:
    """The documents that are not contaminated, unchanged, with all their columns.

    The verdict depends on the text alone, so it is joined back by doc_id and a hash of the text.
    """
    bad = materialize(benchmark_hits(docs, benchmark, window, coverage, with_text_hash=True)
                      .filter("contaminated").select(F.col("doc_id").alias("__id"), "text_hash").distinct(), "contaminated")
    return docs.join(bad, docs["doc_id"].cast("long").eqNullSafe(bad["__id"])
                     & (F.xxhash64(text_or_empty(docs["text"])) == bad["text_hash"]), "left_anti")
