"""Operator 5, token counts by rank-synchronous array merging.

Texts are cut at the special tokens, normalised (NFC, lower case) and split into pre-tokens as the
vocabulary file says. Pre-tokens not met before are merged together: their symbols lie in one ragged
array, each round looks up the rank of every adjacent pair, takes the lowest rank within each
sequence and merges all its places at once, and sequences without a known pair leave the array. What is
left of a sequence is its number of tokens. A worker remembers the counts of pre-tokens (up to
``remembered`` of them, then it starts afresh), which changes no result.

The merges are sent to the executors as arrays; their number is fixed by the vocabulary file
(49 thousand here, checked against ``max_merges``). Nothing is shuffled.

Defined results: null counts as empty and has no tokens. Special strings in a text count as the one
special token they name. Repeated rows each get their row; an empty table gives an empty table. Only
doc_id and text are read. Long texts are split in segments of about ``SEGMENT`` characters, at white space.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starlattice.llm.common import ship_with_tasks, text_or_empty

ship_with_tasks(sys.modules[__name__])

LIMIT = 2048
MAX_MERGES = 1_000_000
REMEMBERED = 1_000_000
SEGMENT = 1 << 20
TOGETHER = 1 << 21
ROWS = 1000
# fixed values: the byte-level alphabet writes these bytes as themselves and the others from U+0100 on
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
# fixed values: lower-case letters that the tokenizer's Unicode version has and an older interpreter may lack
NEWER_LOWER = {0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5,
               0xA7DA: 0xA7DB, 0xA7DC: 0x19B, **{c: c + 0x20 for c in range(0x10D50, 0x10D66)},
               **{c: c + 0x1B for c in range(0x16EA0, 0x16EB9)}}
HAS_NEWER = re.compile("[%s]" % "".join(map(chr, NEWER_LOWER)))


WHITE_SPACE = {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}


def normal(text: str) -> str:
    """NFC and lower case, as the vocabulary's normaliser gives them (a test compares all code points).

    Greek capital sigma is lowered alike everywhere; str.lower() has a rule for word ends.
    """
    text = unicodedata.normalize("NFC", text)
    if not text.isascii() and HAS_NEWER.search(text):
        text = text.translate(NEWER_LOWER)
    return text.replace("Σ", "σ").lower()


def load_merges(path: str, max_merges: int = MAX_MERGES) -> dict:
    """From a tokenizer file: sorted pair keys with rank and product, symbols of single bytes, patterns."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
    if len(merges) > max_merges:
        raise ValueError(f"{len(merges)} merges are more than {max_merges}")
    steps = spec["normalizer"].get("normalizers", [spec["normalizer"]])
    # white space is dropped by the split, so replacing it changes no count
    if [s["type"] for s in steps if s != WHITE_SPACE] != ["NFC", "Lowercase"]:
        raise ValueError(f"normaliser not known: {steps}")
    end = spec["model"]["end_of_word_suffix"] or ""
    merges = [m.split(" ") if isinstance(m, str) else m for m in merges]
    key = np.array([vocab[a] << 32 | vocab[b] for a, b in merges], np.int64)
    product = np.array([vocab[a + b] for a, b in merges], np.int64)
    order = np.argsort(key, kind="stable")
    others = iter(range(256, 512))
    shown = {b: chr(b) if b in set(PRINTABLE) else chr(next(others)) for b in range(256)}
    return {"key": key[order], "rank": order.astype(np.int64), "product": product[order],
            "inner": np.array([vocab[shown[b]] for b in range(256)], np.int64),
            "last": np.array([vocab[shown[b] + end] for b in range(256)], np.int64),
            "split": spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"],
            "special": [t["content"] for t in spec["added_tokens"]]}


def merged_sizes(words: list[bytes], m: dict) -> np.ndarray:
    """The number of symbols left of each word (none is empty)."""
    sizes = np.array([len(w) for w in words], np.int64)
    left = sizes.copy()
    raw = np.frombuffer(b"".join(words), np.uint8)
    symbols = m["inner"][raw]
    ends = np.cumsum(sizes) - 1
    symbols[ends] = m["last"][raw[ends]]
    owner = np.repeat(np.arange(len(words)), sizes)
    none = np.iinfo(np.int64).max
    while len(symbols) > 1:
        key = symbols[:-1] << 32 | symbols[1:]
        at = np.minimum(np.searchsorted(m["key"], key), len(m["key"]) - 1)
        known = (m["key"][at] == key) & (owner[:-1] == owner[1:])
        rank = np.append(np.where(known, m["rank"][at], none), none)
        starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        lowest = np.minimum.reduceat(rank, starts)
        per = np.diff(np.r_[starts, len(symbols)])
        best = np.repeat(lowest, per)
        go = (rank == best) & (rank != none)
        # in a run of overlapping places (equal symbols), every other one from the left
        place = np.flatnonzero(go)
        if not len(place):
            break
        fresh = np.r_[True, np.diff(place) > 1]
        begun = np.maximum.accumulate(np.where(fresh, place, 0))
        place = place[(place - begun) % 2 == 0]
        symbols[place] = m["product"][at[place]]
        keep = np.ones(len(symbols), bool)
        keep[place + 1] = False
        np.subtract.at(left, owner[place], 1)
        keep &= np.repeat(lowest != none, per)  # finished sequences leave
        symbols, owner = symbols[keep], owner[keep]
    return left


class Counter:
    """Counts tokens; remembers pre-tokens."""

    def __init__(self, merges: dict, remembered: int = REMEMBERED):
        import regex

        self.merges, self.remembered, self.sizes = merges, remembered, {}
        self.split = regex.compile(merges["split"]).findall
        self.special = regex.compile("|".join(map(regex.escape, merges["special"]))) if merges["special"] else None

    def _learn(self, words: set[str]) -> None:
        if len(self.sizes) > self.remembered:
            self.sizes.clear()
        new = [w for w in words if w not in self.sizes]
        if new:
            raw = [w.encode("utf-8", "surrogatepass") for w in new]
            self.sizes.update(zip(new, merged_sizes(raw, self.merges).tolist()))

    def _parts(self, text: str) -> Iterator[str]:
        text = normal(text)
        at = 0
        while at < len(text):
            end = at + SEGMENT
            while end < len(text) and text[end] not in " \n\t":
                end += 1
            yield text[at:end]
            at = end

    def count(self, texts: list[str]) -> list[int]:
        """Pre-tokens of many texts are learnt together, about ``TOGETHER`` characters at a time."""
        totals, held, chars = [0] * len(texts), [], 0

        def settle() -> None:
            self._learn(set().union(*(words for _, words in held)))
            for i, words in held:
                totals[i] += sum(map(self.sizes.__getitem__, words))
            held.clear()

        for i, text in enumerate(texts):
            pieces = [text]
            if self.special and any(s in text for s in self.merges["special"]):
                pieces = self.special.split(text)
                totals[i] = len(pieces) - 1
            for part in chain.from_iterable(map(self._parts, pieces)):
                held.append((i, self.split(part)))
                chars += len(part)
                if chars > TOGETHER:
                    settle()
                    chars = 0
        settle()
        return totals


def token_counts(docs: DataFrame, vocabulary: str, limit: int = LIMIT, remembered: int = REMEMBERED) -> DataFrame:
    """Per document: doc_id, n_bytes, n_tokens, over_limit. vocabulary: path of the tokenizer file."""
    merges = docs.sparkSession.sparkContext.broadcast(load_merges(vocabulary))

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(merges.value, remembered)
        for batch in it:
            counts: list[int] = []
            for at in range(0, batch.num_rows, ROWS):  # few texts at a time as Python strings
                counts += counter.count(batch.column(1).slice(at, ROWS).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(counts, pa.int64())],
                                             ["doc_id", "n_bytes", "n_tokens"])

    text = text_or_empty()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"),
                       F.octet_length(text).cast("long").alias("n_bytes"))
    return (rows.mapInArrow(batches, "doc_id long, n_bytes long, n_tokens long")
            .withColumn("over_limit", F.col("n_tokens") > limit))
