"""Operator 13, quality rules by robust multivariate outliers.

Base rules: a text of fewer than 20 words, or with more than 30 % of its words in 8-word windows that
occur twice or more in it, fails. Every other text has a vector of transformed statistics: the log of the
mean word length, and arcsine square roots (which even out the variance of shares) of the shares of
symbols, capitals, other punctuation and digits among its characters, of repeated lines and of repeated words.

Per language and source the centre and scatter of these vectors are estimated by minimum
covariance determinant: of the subsets of h = 75 % of a group's texts, that with the smallest determinant.
Three starts that depend on the data alone (median with median absolute deviations, spatial signs,
all texts) take two concentration steps each: squared Mahalanobis distances, then the
mean and covariance of the h nearest. The start with the smallest determinant goes on until nothing
changes. The result is scaled for consistency with the normal distribution and reweighted over
the texts within the 97.5 % quantile. A text is rejected when its distance passes
``CUT`` times the 99.9 % quantile of chi-square. To each variance the square of ``FLOOR`` is
added (the regularised determinant), so a statistic that is the same in nearly all texts of a group
does not make every small difference an outlier; clean texts are short as well as long, and their shares differ by that much.

On Spark: statistics are whole numbers (1/1024), and their sums and sums of products are exact, whatever the order
of rows. A step is one aggregation by (group, start, distance bin), combined map-side, so a hot source costs
no more than others; the h-th distance is then found among at most 1,500 bins a group, the last bin counted in part.
Groups below ``least_rows`` texts are estimated together per language, and those of a language that is too small over all
languages; if that is still too few, only the base rules decide. All texts enter the estimates.

Defined results: null and empty texts have no words and fail. Null languages and sources are groups of their own.
Repeated rows count each. An empty table gives an empty table. Very long texts are handled one by one. Only
doc_id, text, lang and source are read.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starlattice.llm.common import materialize, ship_with_tasks, text_or_empty

ship_with_tasks(sys.modules[__name__])

LEAST_WORDS, REPEAT_PERCENT, WINDOW = 20, 30, 8
SYMBOLS = b"#*$%&|<>"
LEAST_ROWS = 300
KEPT_SHARE = 0.75
MAX_STEPS = 30
CUT = 1.6
SCALE = 1024
#: added standard deviation of each statistic
FLOOR = (0.08, 0.05, 0.08, 0.06, 0.06, 0.15, 0.15)
BINS = 1_500
STRETCH = 4 << 20

SPACE = b" \t\n\x0b\x0c\r"
CONTINUATION = bytes(range(0x80, 0xC0))
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MARKS = b"!\"'(),-./:;?@[\\]^_`{}~+="
DIGITS = b"0123456789"
P = len(FLOOR)
STATS = [f"x{i}" for i in range(P)]
PRODUCTS = [(i, j) for i in range(P) for j in range(i, P)]


# ---- statistics of a text

def repeated_words(texts: list[bytes], window: int = WINDOW) -> np.ndarray:
    """Per text the words in windows found twice or more in it. Windows are named by doubling, without hashing."""
    split = [t.split() for t in texts]  # bytes: exactly space and \x09-\x0D
    lengths = np.array([len(w) for w in split], np.int64)
    tokens = [w for words in split for w in words]
    n = len(tokens) - window + 1
    if n <= 0:
        return np.zeros(len(texts), np.int64)
    doc = np.repeat(np.arange(len(texts)), lengths)
    index = {w: i for i, w in enumerate(dict.fromkeys(tokens))}
    name, width = np.fromiter(map(index.__getitem__, tokens), np.int64, len(tokens)), 1
    while width < window:
        more = min(width, window - width)  # the second half may overlap the first
        left = name[:len(name) - more]
        name = np.unique(left * (int(name.max()) + 1) + name[more:], return_inverse=True)[1]
        width += more
    inside = np.flatnonzero(doc[:n] == doc[window - 1:])
    _, place, counts = np.unique(doc[inside] * (int(name.max()) + 1) + name[inside], return_inverse=True, return_counts=True)
    starts = inside[counts[place] > 1]
    cover = np.zeros(len(tokens) + 1, np.int64)
    np.add.at(cover, starts, 1)
    np.add.at(cover, starts + window, -1)
    return np.bincount(doc[np.cumsum(cover[:-1]) > 0], minlength=len(texts))


def plain_counts(data: bytes) -> tuple[int, ...]:
    """word_chars, n_symbols, capitals, marks, digits, n_dup_lines, lines with a word."""
    without = lambda drop: len(data) - len(data.translate(None, drop))
    lines = [line for line in data.split(b"\n") if line.strip(SPACE)]
    return (len(data.translate(None, CONTINUATION + SPACE)), without(SYMBOLS), without(CAPITALS), without(MARKS),
            without(DIGITS), len(lines) - len(set(lines)), len(lines))


def vector(n_words: int, n_repeat: int, counts: tuple[int, ...]) -> list[int]:
    chars, symbols, capitals, marks, digits, dup, lines = counts
    arc = lambda part, all_: math.asin(math.sqrt(min(1.0, part / all_))) if all_ else 0.0
    values = [math.log(max(chars, 1) / max(n_words, 1)), *[arc(x, chars) for x in (symbols, capitals, marks, digits)],
              arc(dup, lines), arc(n_repeat, n_words)]
    return [round(v * SCALE) for v in values]


def _statistics(batches):
    schema = pa.schema([(c, pa.int64()) for c in ("doc_id",)] + [("lang", pa.string()), ("source", pa.string())]
                       + [(c, pa.int64()) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
                       + [(c, pa.int32()) for c in STATS])

    def sent(held):
        repeats = repeated_words([t for *_, t in held])
        rows = []
        for (doc, lang, source, data), n_repeat in zip(held, repeats.tolist()):
            counts, n_words = plain_counts(data), len(data.split())
            rows.append((doc, lang, source, n_words, counts[0], counts[1], counts[5], n_repeat, *vector(n_words, n_repeat, counts)))
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    held, size = [], 0
    for batch in batches:
        for row in zip(*[batch.column(c).to_pylist() for c in ("doc_id", "lang", "source", "text")]):
            data = row[3].encode("utf-8", "surrogatepass")
            held.append((*row[:3], data))
            size += len(data)
            if size >= STRETCH or len(held) == 5_000:
                yield sent(held)
                held, size = [], 0
    if held:
        yield sent(held)


def text_statistics(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and the vector x0 to x6."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
                       F.col("source").cast("string").alias("source"), text_or_empty().alias("text"))
    shape = ("doc_id long, lang string, source string, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
             "n_repeat_words long, " + ", ".join(f"{c} int" for c in STATS))
    return rows.mapInArrow(_statistics, shape)


# ---- chi-square

def chi2_cdf(x: float, k: int) -> float:
    """The regularised lower incomplete gamma function, by its series."""
    a, x = k / 2, x / 2
    if x <= 0:
        return 0.0
    term = total = 1 / a
    n = a
    while term > total * 1e-16:
        n += 1
        term *= x / n
        total += term
    return min(1.0, total * math.exp(a * math.log(x) - x - math.lgamma(a)))


def chi2_quantile(q: float, k: int) -> float:
    low, high = 0.0, 1_000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_cdf(mid, k) < q else (low, mid)
    return high


def consistency(share: float) -> float:
    """What a normal scatter estimated from its nearest ``share`` is to be multiplied with."""
    return share / chi2_cdf(chi2_quantile(share, P), P + 2) if share < 1 else 1.0


# ---- estimates

def fitted(n: float, sums: np.ndarray, products: np.ndarray, share: float) -> dict:
    """Centre, inverse scatter and log determinant from weighted sums of whole numbers."""
    mean = sums / n
    scatter = np.zeros((P, P))
    for (i, j), value in zip(PRODUCTS, products):
        scatter[i, j] = scatter[j, i] = value / n - mean[i] * mean[j]
    return shaped(mean / SCALE, scatter / SCALE ** 2, share)


def shaped(mean: np.ndarray, scatter: np.ndarray, share: float) -> dict:
    scatter = scatter * consistency(share) + np.diag(np.square(FLOOR))
    inverse = np.linalg.inv(scatter)
    return {"mean": mean.tolist(), "inverse": [float(inverse[i, j]) for i, j in PRODUCTS],
            "logdet": float(np.linalg.slogdet(scatter)[1])}


def nearest(bins: list[tuple], h: float) -> tuple[float, np.ndarray, np.ndarray]:
    """Weight and sums over the h nearest rows: bins (bin, n, sums...) in order, the last one in part."""
    total, sums = 0.0, np.zeros(P + len(PRODUCTS))
    for _, n, *values in bins:
        part = min(1.0, (h - total) / n)
        total += part * n
        sums = sums + part * np.array(values, np.float64)
        if part < 1 or total >= h:
            break
    return total, sums[:P], sums[P:]


_MODEL = "gid long, start int, mean array<double>, inverse array<double>, logdet double, rows long"
_SCHEMA = pa.schema([("gid", pa.int64()), ("start", pa.int32()), ("mean", pa.list_(pa.float64())),
                     ("inverse", pa.list_(pa.float64())), ("logdet", pa.float64()), ("rows", pa.int64())])


def _distance(mean: str = "mean", inverse: str = "inverse"):
    """The squared Mahalanobis distance as a column."""
    gap = [F.col(x) / F.lit(float(SCALE)) - F.element_at(mean, i + 1) for i, x in enumerate(STATS)]
    terms = [F.lit(1.0 if i == j else 2.0) * F.element_at(inverse, n + 1) * gap[i] * gap[j] for n, (i, j) in enumerate(PRODUCTS)]
    total = sum(terms[1:], terms[0])
    return F.when(total < 0, F.lit(0.0)).otherwise(total)


def _sums():
    return ([F.sum(F.col(x).cast("long")).alias(f"s_{x}") for x in STATS]
            + [F.sum(F.col(STATS[i]).cast("long") * F.col(STATS[j])).alias(f"p_{i}_{j}") for i, j in PRODUCTS])


def _per_group(df: DataFrame, order: list[str], fit) -> DataFrame:
    """``fit(rows)`` of each (gid, start), whose rows come sorted; a group has a bounded number of them."""
    columns = df.columns

    def run(batches):
        key, rows = None, []

        def sent():
            model = fit(rows)
            model |= {"gid": key[0], "start": key[1]}
            return pa.RecordBatch.from_pylist([{c: model[c] for c in _SCHEMA.names}], _SCHEMA)

        for batch in batches:
            for row in zip(*[batch.column(c).to_pylist() for c in columns]):
                if row[:2] != key:
                    if rows:
                        yield sent()
                    key, rows = row[:2], []
                rows.append(row[2:])
        if rows:
            yield sent()

    return df.repartition("gid", "start").sortWithinPartitions("gid", "start", *order).mapInArrow(run, _MODEL)


def _step(rows: DataFrame, models: DataFrame, share: float) -> DataFrame:
    """One concentration step for every (group, start)."""
    near = rows.join(models.select("gid", "start", "mean", "inverse"), "gid").withColumn("d2", _distance())
    bins = near.withColumn("bin", F.least(F.lit(BINS - 1), F.floor(32 * F.log2(1 + 16 * F.col("d2")))).cast("int"))
    binned = bins.groupBy("gid", "start", "bin").agg(F.count(F.lit(1)).alias("n"), *_sums())

    def fit(found):
        n = sum(r[1] for r in found)
        return fitted(*nearest(found, share * n), share) | {"rows": n}

    return materialize(_per_group(binned, ["bin"], fit), "quality-step")


def _starts(rows: DataFrame) -> DataFrame:
    """Three estimates that depend on the data alone, from exact medians and sums."""
    values = rows.select("gid", F.posexplode(F.array(*[F.col(x) for x in STATS])).alias("at", "value"))
    seen = values.groupBy("gid", "at", "value").agg(F.count(F.lit(1)).alias("n"))

    def middle(table: DataFrame, keys: list[str], value: str) -> DataFrame:
        """The lower median of counted values."""
        run = F.sum("n").over(Window.partitionBy(*keys).orderBy(value))
        whole = F.sum("n").over(Window.partitionBy(*keys))
        placed = table.withColumn("run", run).withColumn("whole", whole)
        return placed.filter(F.col("run") * 2 >= F.col("whole")).groupBy(*keys).agg(F.min(value).alias("middle"))

    seen = materialize(seen, "quality-values")
    medians = materialize(middle(seen, ["gid", "at"], "value"), "quality-medians")
    gaps = seen.join(medians, ["gid", "at"]).select("gid", "at", F.abs(F.col("value") - F.col("middle")).alias("gap"), "n")
    spread = middle(gaps.groupBy("gid", "at", "gap").agg(F.sum("n").alias("n")), ["gid", "at"], "gap")
    both = materialize(medians.join(spread.withColumnRenamed("middle", "mad"), ["gid", "at"])
                       .groupBy("gid").agg(F.sort_array(F.collect_list(F.struct("at", "middle", "mad"))).alias("m")), "quality-scales")
    own = rows.join(both.select("gid", *[F.col("m")[i]["middle"].alias(f"m{i}") for i in range(P)],
                                *[F.greatest(F.col("m")[i]["mad"] / SCALE, F.lit(FLOOR[i])).alias(f"d{i}") for i in range(P)]), "gid")
    # spatial signs: directions from the median, in whole numbers of 1 / 1024 of their length
    gap = [(F.col(x) - F.col(f"m{i}")) / F.lit(float(SCALE)) / F.col(f"d{i}") for i, x in enumerate(STATS)]
    length = F.sqrt(sum([g * g for g in gap[1:]], gap[0] * gap[0]))
    signs = own.select("gid", *[F.when(length > 0, F.round(g / length * SCALE)).otherwise(0.0).cast("int").alias(f"u{i}")
                                for i, g in enumerate(gap)])
    turned = signs.groupBy("gid").agg(*[F.sum(F.col(f"u{i}").cast("long") * F.col(f"u{j}")).alias(f"u_{i}_{j}") for i, j in PRODUCTS])
    totals = rows.groupBy("gid").agg(F.count(F.lit(1)).alias("n"), *_sums())
    table = (totals.join(turned, "gid").join(both, "gid")
             .withColumn("start", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2)))))
    columns = ["gid", "start", "n", *[f"s_{x}" for x in STATS], *[f"p_{i}_{j}" for i, j in PRODUCTS],
               *[f"u_{i}_{j}" for i, j in PRODUCTS], F.col("m")["middle"].alias("middle"), F.col("m")["mad"].alias("mad"),
               F.col("start").alias("which")]

    def fit(found):
        n, *values, middles, mads, which = found[0]
        sums, products = np.array(values[:P], np.float64), np.array(values[P:P + len(PRODUCTS)], np.float64)
        middle_, scale = np.array(middles) / SCALE, np.maximum(1.4826 * np.array(mads) / SCALE, FLOOR)
        if which == 2:
            return fitted(n, sums, products, 1.0) | {"rows": n}
        scatter = np.diag(scale ** 2)
        if which == 1:
            turn = np.zeros((P, P))
            for (i, j), value in zip(PRODUCTS, values[P + len(PRODUCTS):]):
                turn[i, j] = turn[j, i] = value / n / SCALE ** 2
            root = np.sqrt(np.maximum(np.diag(turn), 1e-9))
            scatter = np.outer(scale, scale) * turn / np.outer(root, root)
        return shaped(middle_, scatter, 1.0) | {"rows": n}

    return materialize(_per_group(table.select(*columns), ["n"], fit), "quality-starts")


def minimum_determinants(rows: DataFrame, share: float = KEPT_SHARE, max_steps: int = MAX_STEPS) -> DataFrame:
    """Per gid: mean, inverse, logdet (minimum covariance determinant, reweighted) of rows (gid, x0 to x6)."""
    models = _starts(rows)
    for _ in range(2):
        models = _step(rows, models, share)
    best = models.groupBy("gid").agg(F.min_by(F.struct(*_SCHEMA.names), F.struct("logdet", "start")).alias("b")).select("b.*")
    best = materialize(best, "quality-best")
    done = None
    for _ in range(max_steps):
        new = _step(rows, best, share)
        old = best.select(F.col("gid").alias("of"), F.col("mean").alias("m"), F.col("inverse").alias("i"))
        judged = materialize(new.join(old, F.col("gid") == F.col("of"))
                             .withColumn("same", (F.col("m") == F.col("mean")) & (F.col("i") == F.col("inverse"))).drop("of", "m", "i"),
                             "quality-judged")
        ended = judged.filter("same").drop("same")
        done = ended if done is None else done.unionByName(ended)
        best = judged.filter("not same").drop("same")
        if not best.count():
            break
    done = best if done is None else done.unionByName(best)
    near = rows.join(done.select("gid", "start", "mean", "inverse"), "gid").filter(_distance() <= F.lit(chi2_quantile(0.975, P)))
    sums = near.groupBy("gid", "start").agg(F.count(F.lit(1)).alias("n"), *_sums())

    def fit(found):
        n, *values = found[0]
        return fitted(n, np.array(values[:P], np.float64), np.array(values[P:], np.float64), 0.975) | {"rows": n}

    return materialize(_per_group(sums, ["n"], fit), "quality-models")


def quality(docs: DataFrame, least_rows: int = LEAST_ROWS, share: float = KEPT_SHARE, cut: float = CUT) -> DataFrame:
    """One row per document: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept,
    distance (squared, null where no estimate applies)."""
    failed = (F.col("n_words") < LEAST_WORDS) | (F.col("n_repeat_words") * 100 > F.lit(REPEAT_PERCENT) * F.col("n_words"))
    stats = materialize(text_statistics(docs).withColumn("base_failed", failed), "quality-statistics")
    good = stats.filter("not base_failed")
    sizes = materialize(good.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n")), "quality-sizes")
    own = F.col("n") >= least_rows
    small = sizes.filter(~own).groupBy("lang").agg(F.sum("n").alias("of_lang")).select(F.col("lang").alias("l"), "of_lang")
    named = sizes.join(small, sizes["lang"].eqNullSafe(small["l"]), "left").withColumn(
        "level", F.when(own, 2).when(F.col("of_lang") >= least_rows, 1).otherwise(0))
    named = named.select("lang", "source", "n", "level", F.when(F.col("level") > 0, F.col("lang")).alias("g_lang"),
                         F.when(F.col("level") > 1, F.col("source")).alias("g_source"))
    keys = ["level", "g_lang", "g_source"]
    groups = materialize(named.groupBy(*keys).agg(F.sum("n").alias("rows")).filter(F.col("rows") >= least_rows)
                         .withColumn("gid", F.monotonically_increasing_id()), "quality-groups")
    right = groups.select(*[F.col(c).alias(f"r_{c}") for c in keys], "gid")
    match = [named[c].eqNullSafe(right[f"r_{c}"]) for c in keys]
    member = materialize(named.join(right, match[0] & match[1] & match[2]).select(
        F.col("lang").alias("of_lang"), F.col("source").alias("of_source"), "gid"), "quality-members")
    grouped = stats.join(member, stats["lang"].eqNullSafe(member["of_lang"]) & stats["source"].eqNullSafe(member["of_source"]), "left")
    rows = materialize(grouped.filter("not base_failed and gid is not null").select("gid", *STATS), "quality-vectors")
    models = minimum_determinants(rows, share).select(F.col("gid").alias("model"), "mean", "inverse")
    limit = cut * chi2_quantile(0.999, P)
    out = grouped.join(models, grouped["gid"] == models["model"], "left").withColumn("distance", F.round(_distance(), 6))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                      (~F.col("base_failed") & (F.col("distance").isNull() | (F.col("distance") <= limit))).alias("kept"), "distance")
