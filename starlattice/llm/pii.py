"""Operator 1, personal data by weak supervision.

Candidates are the base patterns' matches, valid or not, and looser ones (phone numbers without a country
code, e-mail addresses with "at" and "dot" spelled out). Four labelers vote +1, -1 or 0 on each:

- pattern: a base match that passes its checks +1, one that fails them -1, a loose match 0
- gazetteer: lists of top-level domains, card prefixes, country codes and reserved addresses
- context: words before the candidate that announce its kind (+1) or another number (-1)
- boundary: whether the candidate stands by itself (+1) or in the middle of a word or number (-1)

The votes of all candidates, counted by kind and pattern of votes (at most 4 x 3^4 rows, whatever the input),
go through expectation-maximisation, which estimates for each labeler and kind how often it votes so on true
and on false candidates. The posteriors train the final classifier, a logistic regression over kind and
votes, whose scores go back to the candidates. Base spans that pass their checks stay in any case; a
further candidate is added when the classifier gives it ``least`` or more and it overlaps no base span.

DataFrame functions only. A match's place follows from the lengths of the matches and of the texts between
them, as ``split`` and ``regexp_extract_all`` give them. Patterns are written so that no input makes them
slow or deep: runs are possessive and start where a run can start, and separators inside runs (dots of
a domain, spaces and hyphens of a card number) are first replaced by a mark of one character. Candidates
are rows, not arrays, so a text with very many of them stays within memory. Emails, ips, cards and phones in the
result count base spans.

Defined results: null counts as empty. Repeated rows each get their row; an empty table gives an empty table.
Only doc_id and text are read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starlattice.llm.common import materialize, text_or_empty

KINDS = ("email", "ip", "card", "phone")
LEAST = 0.9
ROUNDS = 50

# fixed values: the labelers' lists
TLDS = ["com", "org", "net", "edu", "gov", "int", "info", "io", "co", "de", "fr", "es", "uk", "eu", "us", "it", "nl",
        "ch", "at", "be", "pl", "ru", "cn", "jp", "in", "br", "ca", "au", "mx", "ar", "se", "no", "dk", "fi", "pt", "ie"]
CALLING = r"^\+(1|7|20|27|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[2-9][0-9]{2})"
CARDS = r"^(4|5[1-5]|2[2-7]|3[47]|6(011|5)|35)"
RESERVED = r"^(0|10|127|22[4-9]|2[3-5][0-9])\.|^192\.168\.|^172\.(1[6-9]|2[0-9]|3[01])\.|^169\.254\."
CUES = {"email": r"(?i)(e-?mail|contact|write|reach|mailto|address|correo|courriel)",
        "ip": r"(?i)(\bip\b|address|host|server|client|ping|adresse)",
        "card": r"(?i)(card|visa|credit|debit|payment|karte|carte|tarjeta)",
        "phone": r"(?i)(phone|tel|call|mobile|fax|contact|telefon|appel|llam)"}
AGAINST = r"(?i)(version|isbn|order|invoice|serial|\bid\b|\bno\.|build|figure|page|release)"
CONTEXT = 40

_LOCAL = "A-Za-z0-9._%+/-"
#: kind, prepared text, pattern, guard; the base patterns, see module text
BASE = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++/[A-Za-z0-9/-]++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9][0-9x]{11,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?[\[(]at[\])]\x20?[A-Za-z0-9-]++\x20?(?:[\[(]dot[\])]|\.)\x20?[A-Za-z]{2,}",
    "phone": r"(?<![0-9+(.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
}


def _marked(text: Column, mark: str, free: str, pattern: str) -> Column:
    """Separators that the pattern finds become ``mark``, which texts hold as ``free`` from here on."""
    return F.regexp_replace(F.translate(text, mark, free), pattern, mark)


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Sum of the digits, every second one from the right doubled (and 9 less if that is over 9)."""
    n = F.char_length(digits)
    total = F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda acc, i: acc + F.element_at(
        F.when((n - i) % 2 == 0, F.array(*[F.lit(d) for d in range(10)]))
        .otherwise(F.array(*[F.lit(d * 2 - 9 * (d > 4)) for d in range(10)])),
        F.substr(digits, i, F.lit(1)).cast("int") + 1))
    return (n > 0) & (total % 10 == 0)


def _passes(kind: str, match: Column) -> Column:
    """A base match's own checks."""
    if kind == "ip":
        parts = F.transform(F.split(match, r"\."), lambda p: F.regexp_replace(p, "^0+", ""))
        return F.forall(parts, lambda p: (p == "") | ((F.char_length(p) <= 3) & (F.substring(p, 1, 3).try_cast("int") <= 255)))
    digits = _digits(match)
    if kind == "card":
        return F.when(F.char_length(digits).between(12, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.char_length(digits).between(9, 15)
    return F.lit(True)


def _listed(kind: str, match: Column) -> Column:
    """The gazetteer's vote."""
    digits = _digits(match)
    if kind == "email":
        return F.when(F.lower(F.regexp_extract(match, "[A-Za-z0-9-]+$", 0)).isin(TLDS), 1).otherwise(-1)
    if kind == "ip":
        return F.when(match.rlike(RESERVED), -1).otherwise(1)
    if kind == "card":
        return F.when(digits.rlike(CARDS), 1).otherwise(-1)
    return (F.when(match.startswith("+"), F.when(match.rlike(CALLING), 1).otherwise(-1))
            .otherwise(F.when(digits.rlike("^[2-9]"), 0).otherwise(-1)))


def _sources(text: Column) -> list[tuple[str, bool, Column, str, Column]]:
    """(kind, base, prepared text, pattern, guard): texts without the guard are not searched further."""
    dotted = _marked(text, "/", "!", r"(?<=[A-Za-z0-9-])\.(?=[A-Za-z0-9-])")
    joined = _marked(text, "x", "y", r"(?<=[0-9])[\x20-](?=[0-9])")
    return [("email", True, dotted, BASE["email"], F.contains(text, F.lit("@"))),
            ("ip", True, text, BASE["ip"], F.rlike(text, F.lit(r"[0-9]\.[0-9]++\.[0-9]"))),
            ("card", True, joined, BASE["card"], F.rlike(text, F.lit(r"[0-9][0-9\x20-]{10}[0-9\x20-]"))),
            ("phone", True, text, BASE["phone"], F.rlike(text, F.lit(r"\+[0-9]"))),
            ("email", False, text, LOOSE["email"], F.rlike(text, F.lit(r"[\[(]at[\])]"))),
            ("phone", False, text, LOOSE["phone"], F.rlike(text, F.lit(r"[0-9]{3}[\x20.-][0-9]{4}")))]


FOUND = "array<struct<source:int,n:int,gap:int,before:string,after:string,match:string>>"


def _found(source: int, prepared: Column, pattern: str, guard: Column) -> Column:
    """The matches of one source with the length and the end of the text before each."""
    gaps, matches = F.split(prepared, pattern, -1), F.regexp_extract_all(prepared, F.lit(pattern), F.lit(0))
    rows = F.transform(F.arrays_zip(gaps.alias("g"), F.slice(gaps, F.lit(2), F.size(gaps)).alias("next"), matches.alias("m")),
                       lambda x, i: F.struct(
                           F.lit(source).alias("source"), i.alias("n"), F.char_length(x["g"]).alias("gap"),
                           F.substr(x["g"], F.greatest(F.lit(1), F.char_length(x["g"]) - (CONTEXT - 1))).alias("before"),
                           F.substring(x["next"], 1, 1).alias("after"), x["m"].alias("match")))
    return F.when(guard, F.filter(rows, lambda x: x["match"].isNotNull())).otherwise(F.array().cast(FOUND))


def candidates(docs: DataFrame) -> DataFrame:
    """(rid, doc_id, kind, base, start, end, votes v1..v4): one row per candidate; a document without any has one
    row with null kind. kind is a place in KINDS; base marks base spans that pass their checks."""
    rows = docs.select("doc_id", text_or_empty().alias("text")).withColumn("rid", F.monotonically_increasing_id())
    sources = _sources(F.col("text"))
    found = F.concat(*[_found(i, prepared, pattern, guard) for i, (_, _, prepared, pattern, guard) in enumerate(sources)])
    rows = rows.select("rid", "doc_id", F.explode_outer(found).alias("x")).select("rid", "doc_id", "x.*")
    rows = rows.repartition("rid")
    order = Window.partitionBy("rid", "source").orderBy("n")
    length = F.char_length("match")
    start = (F.sum("gap").over(order.rowsBetween(Window.unboundedPreceding, 0))
             + F.coalesce(F.sum(length).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    rows = rows.withColumn("start", start).withColumn("end", F.col("start") + length)

    def choose(of) -> Column:
        out = None
        for i, (kind, is_base, _, _, _) in enumerate(sources):
            value = of(kind, is_base)
            out = F.when(F.col("source") == i, value) if out is None else out.when(F.col("source") == i, value)
        return out

    # marks back to what they stand for
    match = F.when(F.col("source") == 0, F.translate("match", "/", ".")).otherwise(F.col("match"))
    rows = rows.withColumn("match", match)
    m = F.col("match")
    rows = (rows.withColumn("kind", choose(lambda k, b: F.lit(KINDS.index(k))))
            .withColumn("base", choose(lambda k, b: _passes(k, m) if b else F.lit(False)))
            .withColumn("v1", choose(lambda k, b: F.when(F.col("base"), 1).otherwise(-1) if b else F.lit(0)))
            .withColumn("v2", choose(lambda k, b: _listed(k, m)))
            .withColumn("v3", choose(lambda k, b: F.when(F.col("before").rlike(CUES[k]), 1)
                                     .when(F.col("before").rlike(AGAINST), -1).otherwise(0)))
            .withColumn("v4", F.when(F.col("before").rlike(r"[\p{L}0-9]$") | F.col("after").rlike(r"[\p{L}0-9]"), -1).otherwise(1)))
    return rows.select("rid", "doc_id", "kind", "base", "start", "end", "v1", "v2", "v3", "v4")


# ---- the label model and the classifier, over at most 4 x 3^4 rows of counts

def label_posteriors(counts: list[tuple[int, tuple[int, ...], int]], rounds: int = ROUNDS) -> list[float]:
    """Expectation-maximisation over (kind, votes, number): the probability that such a candidate is true.
    Starts from the majority of the votes; estimates are smoothed by one vote of each kind, leaning to
    labelers that are right more often than not."""
    posterior = [1 / (1 + math.exp(-2 * sum(votes))) for _, votes, _ in counts]
    labelers = range(len(counts[0][1])) if counts else ()
    for _ in range(rounds):
        prior = {k: (1.0, 2.0) for k in range(len(KINDS))}
        says = {(j, v, y): 1.0 + (v == (1 if y else -1)) for j in labelers for v in (-1, 0, 1) for y in (0, 1)}
        for (kind, votes, n), p in zip(counts, posterior):
            yes, all_ = prior[kind]
            prior[kind] = (yes + n * p, all_ + n)
            for j, v in enumerate(votes):
                says[j, v, 1] += n * p
                says[j, v, 0] += n * (1 - p)
        total = {(j, y): sum(says[j, v, y] for v in (-1, 0, 1)) for j in labelers for y in (0, 1)}
        posterior = []
        for kind, votes, _ in counts:
            rate = prior[kind][0] / prior[kind][1]
            odds = math.log(rate / (1 - rate)) + sum(
                math.log(says[j, v, 1] / total[j, 1]) - math.log(says[j, v, 0] / total[j, 0]) for j, v in enumerate(votes))
            posterior.append(1 / (1 + math.exp(-max(-30.0, min(30.0, odds)))))
    return posterior


def span_classifier(counts: list[tuple[int, tuple[int, ...], int]], posterior: list[float], steps: int = 500):
    """Logistic regression on kind and votes, trained on the posteriors; gives a score for (kind, votes)."""
    keys = lambda kind, votes: [("kind", kind), *[(j, v) for j, v in enumerate(votes)]]
    w: dict = {}
    everything = sum(n for _, _, n in counts) or 1
    score = lambda kind, votes: 1 / (1 + math.exp(-max(-30.0, min(30.0, sum(w.get(k, 0.0) for k in keys(kind, votes))))))
    for _ in range(steps):
        slope: dict = {}
        for (kind, votes, n), p in zip(counts, posterior):
            miss = n / everything * (p - score(kind, votes))
            for k in keys(kind, votes):
                slope[k] = slope.get(k, 0.0) + miss
        for k, g in slope.items():
            w[k] = w.get(k, 0.0) + 2.0 * (g - 1e-5 * w.get(k, 0.0))
    return score


def personal_data(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """Per row: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans."""
    votes = ["v1", "v2", "v3", "v4"]
    rows = materialize(candidates(docs), "personal-data-candidates")
    seen = rows.filter("kind is not null").groupBy("kind", *votes).agg(F.count(F.lit(1)).alias("n"))
    counts = sorted((r["kind"], tuple(r[v] for v in votes), r["n"]) for r in seen.collect())
    score = span_classifier(counts, label_posteriors(counts))
    wanted = [F.lit(f"{k}:{':'.join(map(str, v))}") for k, v, _ in counts if score(k, v) >= least]
    chosen = F.concat_ws(":", "kind", *votes).isin(wanted) if wanted else F.lit(False)
    # a further candidate must lie clear of the base spans around it
    inside = Window.partitionBy("rid").orderBy("start", "end")
    until = F.max(F.when(F.col("base"), F.col("end"))).over(inside.rowsBetween(Window.unboundedPreceding, -1))
    later = F.min(F.when(F.col("base"), F.col("start"))).over(inside.rowsBetween(1, Window.unboundedFollowing))
    clear = (F.coalesce(until, F.lit(0)) <= F.col("start")) & (F.coalesce(later, F.col("end")) >= F.col("end"))
    rows = rows.repartition("rid").withColumn("extra", ~F.col("base") & chosen & clear)
    span = F.struct("start", "kind", "end")
    per = rows.groupBy("rid", "doc_id").agg(
        *[F.count_if(F.col("base") & (F.col("kind") == i)).alias(f"n_{k}") for i, k in enumerate(KINDS)],
        F.array_sort(F.collect_list(F.when(F.col("base"), span))).alias("base"),
        F.array_sort(F.collect_list(F.when(F.col("base") | F.col("extra"), span))).alias("all"))
    names = F.array(*[F.lit(k) for k in KINDS])
    shown = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")
    return per.select("doc_id", *[f"n_{k}" for k in KINDS], F.sha2(shown("base"), 256).alias("base_sha256"),
                      shown("all").alias("spans"))
