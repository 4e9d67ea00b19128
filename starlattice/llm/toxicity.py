"""Operator 10, toxicity by multiple-instance learning.

A document is a bag of sentences and only the bag has a label. A sentence's score is
p = 1 - exp(-max(0, softplus(b + w x) - softplus(b))) for its features x, and the document's is the
noisy-or 1 - prod(1 - p): one offending sentence is enough, and sentences without any feature add
nothing however many there are. The weights w are trained from document labels alone, by Adam on the
log-likelihood of the noisy-or; the sentences with p of one half or more are the offending ones.

Features are words and their first letters (``PREFIXES``), so that unseen endings of a known stem count.
All enter that are significantly more frequent in toxic training documents (G-test at ``G_LEAST``); only the
bounded training sample bounds their number.

Training takes a bounded sample: about ``sample_rows`` labelled documents of the training folds, chosen
by a hash of the doc_id, so reruns agree. Where rows of a sampled doc_id have different texts, the one with the
smallest XXH64 is trained on (of equal hashes the first text in order) and its other texts are not. Features are counted by the tasks that hold the sample; only the
active features of its sentences meet in the one task that fits the weights. Scoring covers every
whole text and shuffles nothing. Labels, lang, source and doc_id are no inputs of a score.

Defined results: null counts as empty, an empty text scores 0. Labels that are null are not used; if a
doc_id has several, the highest counts. Rows of a null doc_id are scored and in no fold held out. Without
any labelled document of either kind all scores are 0. Repeated rows score alike. Only doc_id, text and
the labels' doc_id and toxic are read.
"""

from __future__ import annotations

import sys
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starlattice.llm.common import materialize, ship_with_tasks, text_or_empty

ship_with_tasks(sys.modules[__name__])

THRESHOLD = 0.7
SAMPLE_ROWS = 20_000
SAMPLE_GRAIN = 1 << 53  # so fine that the share of any number of labels is met
PREFIXES = (4, 5, 6)
G_LEAST = 30.0
LEAST_DOCS = 5
BIAS = -4.0
STEPS = 300
REMEMBERED = 1_000_000
ENDS = b".!?\n"
# sentence ends become line feeds, other bytes between words become spaces
TO_SENTENCES = bytes(10 if b in ENDS else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))


def plain(text: str) -> bytes:
    return text.lower().encode("utf-8", "surrogatepass").translate(TO_SENTENCES)


def features_of(word: bytes) -> list[bytes]:
    letters = word.decode("utf-8", "replace")
    return [word, *(b"^" + letters[:k].encode() for k in PREFIXES if len(letters) > k)]


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 3 == 1


# ---- training

def _count_features(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = (Counter(), Counter())
    for batch in it:
        for text, toxic in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            counts[toxic].update({f for w in set(plain(text).split()) for f in features_of(w)})
    names = list(counts[0].keys() | counts[1].keys())
    for at in range(0, len(names), 50_000):
        part = names[at:at + 50_000]
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.binary()), pa.array([counts[0][f] for f in part], pa.int64()),
                                          pa.array([counts[1][f] for f in part], pa.int64())], ["feature", "clean", "toxic"])


def significant_features(sample: DataFrame, most: int | None = None) -> list[bytes]:
    """Features significantly more frequent in toxic documents: all (the sample bounds their number), or the first ``most``."""
    total = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n0, n1 = total.get(0, 0), total.get(1, 0)
    if not n0 or not n1:
        return []
    per = (sample.mapInArrow(_count_features, "feature binary, clean long, toxic long")
           .groupBy("feature").agg(F.sum("clean").alias("c"), F.sum("toxic").alias("t"))
           .filter((F.col("t") >= LEAST_DOCS) & (F.col("t") * n0 > F.col("c") * n1)))
    part = lambda seen, expected: F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)
    c, t, n = F.col("c"), F.col("t"), n0 + n1
    have, lack = c + t, n - c - t
    g = 2 * (part(t, have * n1 / n) + part(c, have * n0 / n) + part(n1 - t, lack * n1 / n) + part(n0 - c, lack * n0 / n))
    best = per.withColumn("g", g).filter(F.col("g") >= G_LEAST).orderBy(F.col("g").desc(), "feature")
    best = best if most is None else best.limit(most)
    return [bytes(r["feature"]) for r in best.select("feature").collect()]


def _bags(index):
    """Documents as lists of sentences with active features: flat numbers, -1 ends a sentence."""
    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = index.value
        for batch in it:
            bags = []
            for text in batch.column(1).to_pylist():
                flat: list[int] = []
                for sentence in plain(text).split(b"\n"):
                    active = [number[f] for w in sentence.split() for f in features_of(w) if f in number]
                    if active:
                        flat += [*active, -1]
                bags.append(flat)
            yield pa.RecordBatch.from_arrays([batch.column(2), pa.array(bags, pa.list_(pa.int32()))], ["toxic", "bag"])
    return batches


def fit(toxic: np.ndarray, bags: list[np.ndarray], n_features: int, steps: int = STEPS) -> np.ndarray:
    """Weights that maximise the noisy-or's likelihood of the labels (with a small ridge)."""
    sizes = np.array([len(b) for b in bags])
    flat = np.concatenate([*bags, np.empty(0, np.int32)]).astype(np.int64)
    ends = np.flatnonzero(flat < 0)
    sentence = np.cumsum(flat < 0) - (flat < 0)  # of each entry
    of_doc = np.repeat(np.arange(len(bags)), sizes)[ends]  # of each sentence
    at = flat >= 0
    feature, sentence = flat[at], sentence[at]
    w, m, v = np.full(n_features, 0.5), np.zeros(n_features), np.zeros(n_features)
    base, n_docs = np.logaddexp(0, BIAS), len(bags)
    for step in range(1, steps + 1):
        z = BIAS + np.bincount(sentence, w[feature], len(ends))
        hazard = np.maximum(0, np.logaddexp(0, z) - base)
        total = np.bincount(of_doc, hazard, n_docs)
        pull = np.where(toxic == 1, -1 / np.maximum(np.expm1(np.minimum(total, 50)), 1e-2), 1.0)
        slope = pull[of_doc] / (1 + np.exp(-z))
        g = np.bincount(feature, slope[sentence], n_features) + 0.02 * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return w


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> dict[bytes, float]:
    """Feature weights from about sample_rows labelled documents of the training folds."""
    spark = docs.sparkSession
    marks = (labels.select(F.col("doc_id").cast("long").alias("id"), F.col("toxic").cast("int").alias("toxic"))
             .filter(F.col("id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("id")))
             .groupBy("id").agg(F.max("toxic").alias("toxic")))
    share = sample_rows / max(1, marks.count())
    if share < 1:
        marks = marks.filter(F.pmod(F.xxhash64("id"), F.lit(SAMPLE_GRAIN)) < int(share * SAMPLE_GRAIN))
    # about sample_rows rows of two numbers, whatever the input's size
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), text_or_empty().alias("text"))
    least = F.min(F.struct(F.xxhash64("text").alias("text_hash"), "text"))["text"]
    sample = materialize(rows.join(F.broadcast(materialize(marks, "toxicity-labels")), "id")
                         .groupBy("id", "toxic").agg(least.alias("text")).select("id", "text", "toxic"), "toxicity-sample")
    features = significant_features(sample, None)
    if not features:
        return {}
    index = spark.sparkContext.broadcast({f: i for i, f in enumerate(features)})
    n = len(features)

    def weigh(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        toxic, bags = [], []
        for batch in it:
            toxic += batch.column(0).to_pylist()
            bags += [np.array(b.as_py(), np.int32) for b in batch.column(1)]
        w = fit(np.array(toxic), bags, n)
        yield pa.RecordBatch.from_arrays([pa.array(range(n), pa.int32()), pa.array(w)], ["i", "w"])

    bags = materialize(sample.mapInArrow(_bags(index), "toxic int, bag array<int>"), "toxicity-bags")
    fitted = bags.repartition(1).sortWithinPartitions("toxic", "bag").mapInArrow(weigh, "i int, w double").collect()
    return {features[r["i"]]: r["w"] for r in fitted}


# ---- scoring

class Scorer:
    def __init__(self, weights: dict[bytes, float]):
        self.weights, self.of_word = weights, {}
        self.base = float(np.logaddexp(0, BIAS))

    def word(self, w: bytes) -> float:
        got = self.of_word.get(w)
        if got is None:
            if len(self.of_word) > REMEMBERED:
                self.of_word.clear()
            got = self.of_word[w] = sum(self.weights.get(f, 0.0) for f in features_of(w))
        return got

    def score(self, text: str) -> tuple[float, list[list[int]]]:
        """The document's score and the places (code points) of offending sentences."""
        raw = plain(text)
        if not any(map(self.word, set(raw.split()))):
            return 0.0, []
        total, offending = 0.0, []
        for k, sentence in enumerate(raw.split(b"\n")):
            z = sum(map(self.word, sentence.split()))
            hazard = max(0.0, float(np.logaddexp(0, BIAS + z)) - self.base) if z else 0.0
            total += hazard
            if hazard >= 0.6931:
                offending.append(k)
        places = []
        if offending:
            wanted, start, k = set(offending), 0, 0
            for at, c in enumerate(text + "\n"):
                if c in ".!?\n":
                    if k in wanted:
                        places.append([start, at])
                    start, k = at + 1, k + 1
        return 1.0 - float(np.exp(-total)), places


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted, offending (start and end of each offending
    sentence in code points)."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, sample_rows))

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model.value)
        for batch in it:
            scores, places = [], []
            for text in batch.column(2):
                score, found = scorer.score(text.as_py())
                scores.append(score)
                places.append(found)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(scores, pa.float64()), pa.array(places, pa.list_(pa.list_(pa.int64())))],
                ["doc_id", "text_hash", "score", "offending"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_or_empty()).alias("text_hash"),
                       text_or_empty().alias("text"))
    return (rows.mapInArrow(batches, "doc_id long, text_hash long, score double, offending array<array<long>>")
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                    (F.col("score") >= threshold).cast("int").alias("predicted"), "offending", "text_hash"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that are not rejected, with all their columns. The verdict depends on the text alone,
    and is joined back by doc_id and a hash of the text."""
    bad = materialize(toxicity(docs, labels, threshold).filter("predicted = 1")
                      .select(F.col("doc_id").alias("__id"), "text_hash").distinct(), "toxic")
    return docs.join(bad, docs["doc_id"].cast("long").eqNullSafe(bad["__id"])
                     & (F.xxhash64(text_or_empty(docs["text"])) == bad["text_hash"]), "left_anti")
