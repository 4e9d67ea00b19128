"""Operator 4, secret scans with an incremental blob ledger.

Every text is a blob, addressed by the SHA-256 of its content. A ledger holds, for each blob, the
versioned rules that have scanned it and what they found. A run scans only pairs of blob and rule
version that the ledger has not seen, appends them, and joins the findings back to all rows that
carry the blob. So copies, unchanged files of a later crawl and old versions of a file are scanned
once, and a new rule version is the only thing that makes an old blob be read again. A run's part of
the ledger is written as one table, so a run that fails leaves nothing half seen.

Base rules are assign, access and hex; further rules (PEM private keys, GitHub tokens, JSON web
tokens) add spans.

Defined results: null counts as empty. Repeated rows share a blob and each get its findings. An empty
table gives an empty table. Only doc_id and text are read. A blob with a third of all rows is
scanned once; the join back is between small written rows, and adaptive execution splits it.
"""

from __future__ import annotations

import re
import sys
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starlattice.llm.common import materialize, ship_with_tasks, text_or_empty
from starlattice.session import scratch_path

ship_with_tasks(sys.modules[__name__])


def _assign(text: str) -> Iterator[tuple[int, int]]:
    low = text.lower()
    if any(k in low for k in ("password", "passwd", "secret", "token", "apikey", "api_key")):
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= 6:
                yield m.span()


def _least(pattern: str, must: str, least: int = 0):
    found = re.compile(pattern)
    return lambda text: (m.span() for m in (found.finditer(text) if must in text else ()) if m.end() - m.start() >= least)


# fixed values: the base rules' patterns and lengths
ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
#: kind, version, spans in a text; in the order in which spans at the same start are listed
RULES = [
    ("assign", 1, _assign),
    ("access", 1, _least(r"AKIA[A-Z0-9]+", "AKIA", 20)),
    ("hex", 1, _least(r"[0-9a-f]{24,}", "")),
    ("pem", 1, _least(r"-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY-----[A-Za-z0-9+/=\s]*(?:-----END (?:[A-Z0-9]+ )*PRIVATE KEY-----)?",
                      "PRIVATE KEY-----")),
    ("github", 1, _least(r"gh[opsur]_[A-Za-z0-9]{36,}", "gh")),
    ("jwt", 2, _least(r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", "eyJ")),
]
BASE = ("assign", "access", "hex")
LEDGER = "blob binary, rules array<string>, findings array<struct<start:int,place:int,end:int,rule:string>>"


def scan_text(text: str, rules: set[str]) -> list[dict]:
    return [{"start": a, "place": place, "end": b, "rule": f"{kind}@{version}"}
            for place, (kind, version, spans) in enumerate(RULES) if f"{kind}@{version}" in rules
            for a, b in spans(text)]


def _scan(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("start", pa.int32()), ("place", pa.int32()), ("end", pa.int32()), ("rule", pa.string())]))
    for batch in it:
        found = [scan_text(t, set(r)) for t, r in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(found, kind)],
                                         ["blob", "rules", "findings"])


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(LEDGER).parquet(f"{path}/*")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)


def scan_unseen(docs: DataFrame, ledger: str, run: str) -> int:
    """Scans the unseen pairs, appends them to the ledger as part ``run``; the number of blobs scanned."""
    spark = docs.sparkSession
    now = F.array(*[F.lit(f"{kind}@{version}") for kind, version, _ in RULES])
    seen = (read_ledger(spark, ledger).groupBy(F.col("blob").alias("seen_blob"))
            .agg(F.flatten(F.collect_list("rules")).alias("seen_rules")))
    text = text_or_empty()
    blobs = docs.select(F.unhex(F.sha2(text, 256)).alias("blob"), text.alias("text"))
    if seen.limit(1).count():
        blobs = (blobs.join(seen, blobs["blob"] == seen["seen_blob"], "left")
                 .withColumn("rules", F.array_except(now, F.coalesce("seen_rules", F.array().cast("array<string>")))))
    else:
        blobs = blobs.withColumn("rules", now)
    todo = blobs.filter(F.size("rules") > 0).dropDuplicates(["blob"]).select("blob", "text", "rules")
    part = f"{ledger}/run={run}"
    todo.mapInArrow(_scan, LEDGER).write.parquet(part)
    return spark.read.parquet(part).count()


def secrets(docs: DataFrame, ledger: str | None = None, run: str | None = None) -> DataFrame:
    """Per row: doc_id, n_assign, n_access, n_hex, base_sha256, spans. Without a ledger, a new one is begun; without the
    name of a run, a name of its own is given, so a run that died can be repeated."""
    spark = docs.sparkSession
    ledger = ledger or scratch_path(spark, "secret-ledger")
    scan_unseen(docs, ledger, run or uuid.uuid4().hex)
    now = [f"{kind}@{version}" for kind, version, _ in RULES]
    found = (read_ledger(spark, ledger).filter(F.size("findings") > 0)
             .groupBy("blob").agg(F.flatten(F.collect_list("findings")).alias("f"))
             .select("blob", F.array_sort(F.filter("f", lambda x: x["rule"].isin(now))).alias("f")))
    found = materialize(found, "secret-findings").withColumnRenamed("blob", "found_blob")
    rows = docs.select("doc_id", F.unhex(F.sha2(text_or_empty(), 256)).alias("blob"))
    rows = rows.join(found, rows["blob"] == found["found_blob"], "left")
    kind = lambda x: F.substring_index(x["rule"], "@", 1)
    f = F.coalesce("f", F.array().cast("array<struct<start:int,place:int,end:int,rule:string>>"))
    shown = lambda spans: F.array_join(F.transform(
        spans, lambda x: F.concat_ws(":", kind(x), x["start"].cast("string"), x["end"].cast("string"))), ",")
    rows = rows.withColumn("f", f)
    of = lambda k: F.size(F.filter("f", lambda x: kind(x) == k)).cast("long")
    return rows.select(
        "doc_id", *[of(k).alias(f"n_{k}") for k in BASE],
        F.sha2(shown(F.filter("f", lambda x: kind(x).isin(*BASE))), 256).alias("base_sha256"),
        shown(F.col("f")).alias("spans"))
