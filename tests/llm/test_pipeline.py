"""The pipeline's stages, as written, against plain versions chained in the same order."""

from __future__ import annotations

import math
import random

import pytest

import corpus_pipeline
from starlattice.llm import toxicity

from . import plain

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def planted():
    """Rows (doc_id, text), labels and benchmark items; what one stage drops changes what the next one keeps."""
    rnd = random.Random(23)
    vocab = [a + b for a in ("ka", "lo", "mi", "nu", "re", "te", "su", "po") for b in ("ta", "so", "ri", "na", "vek", "dol")]
    line = lambda n: " ".join(rnd.choice(vocab) for _ in range(n))
    insult = lambda: f"{line(6)}. you {rnd.choice(['blorgface', 'blorgheads', 'blorgish'])} {line(2)}. {line(5)}"
    rows = [(i, line(rnd.randrange(15, 40))) for i in range(150)]
    rows += [(200 + i, insult()) for i in range(60)]
    labels = [(d, int("blorg" in t)) for d, t in rows]
    item = line(30)
    base, unlabelled = line(400).split(), []
    # near copies: the first is toxic, so the second, which it would have stood for, stays
    for d in (300, 301, 302):
        w = base[:]
        w[10 * (d - 299)] = vocab[d % 7] + "x"
        unlabelled.append((d, " ".join(w)))
    unlabelled[0] = (300, unlabelled[0][1] + ". blorgface")
    # near copies whose smallest doc_id is contaminated, so that none of them stays
    near = f"{line(200)} {item} {line(200)}"
    copies = [f"{near} {w}" for w in vocab]
    unlabelled += [(310, near), (311, next(c for c in copies if 0 < (plain.fingerprint(c) ^ plain.fingerprint(near)).bit_count() <= 2))]
    # equal texts: the largest doc_id stays
    same = line(20)
    unlabelled += [(320, same), (321, same.upper()), (322, same), (330, line(4) + " " + item[:90]), (331, f"{item} {line(3)}"),
                   (340, None), (341, ""), (350, "blorgish"), (351, "you blorgheads. " + item), (None, line(25))]
    rows += unlabelled
    return rows, labels + [(None, 1), (301, None)], [("i1", item), ("i2", "short one"), (None, None)]


def toxic_score(text, weights):
    """1 - product over sentences of 1 - p."""
    soft = lambda z: math.log1p(math.exp(z))
    clean = 1.0
    for sentence in toxicity.plain(text or "").split(b"\n"):
        z = sum(weights.get(f, 0.0) for w in sentence.split() for f in toxicity.features_of(w))
        clean *= math.exp(-max(0.0, soft(toxicity.BIAS + z) - soft(toxicity.BIAS)))
    return 1 - clean


def test_every_stage_of_the_pipeline(spark, tmp_path, monkeypatch):
    rows, labels, items = planted()
    sources = ["b", "a", None, "é"]
    full = [(d, t, "en", sources[i % 4] if i % 3 else "b", i) for i, (d, t) in enumerate(rows)]
    tables = {"documents": spark.createDataFrame(full, COLUMNS), "labels": spark.createDataFrame(labels, "doc_id long, toxic int"),
              "benchmark": spark.createDataFrame(items, "item_id string, text string")}
    for name, table in tables.items():
        table.repartition(3).write.parquet(f"{tmp_path}/{name}.parquet")
    written, real = [], corpus_pipeline.scratch_path
    monkeypatch.setattr(corpus_pipeline, "scratch_path", lambda s, name: written.append((name, real(s, name))) or written[-1][1])
    mix = corpus_pipeline.run(spark, str(tmp_path))
    assert [name for name, _ in written] == [f"pipeline-{name}" for name, _ in corpus_pipeline.STAGES]
    stages = [spark.read.parquet(path) for _, path in written]
    got = [sorted(map(tuple, s.select(tables["documents"].columns).collect()), key=repr) for s in stages[:-1]]
    short = lambda rows: [(r[0], r[1]) for r in rows]

    weights = toxicity.train(tables["documents"], tables["labels"])
    left = [r for r in full if toxic_score(r[1], weights) < toxicity.THRESHOLD]
    assert left == [r for r in full if "blorg" not in (r[1] or "")]
    assert got[0] == sorted(left, key=repr)

    left = [r for r, (*_, kept, _) in zip(left, plain.op3(short(left))) if kept or r[0] is None]
    assert got[1] == sorted(left, key=repr)

    root = plain.op6_roots(short(left))
    low = {}
    for r in sorted(left, key=lambda r: (r[0] is None, r[0] or 0)):
        low.setdefault(root[plain.fingerprint(r[1])], r)
    left = [r for r in left if r in low.values()]
    assert got[2] == sorted(left, key=repr)

    left = [r for r, hit in zip(left, plain.op2(short(left), items)) if not hit[-1]]
    assert got[3] == sorted(left, key=repr)

    ids = [{r[0] for r in stage} for stage in got]
    assert 300 not in ids[0] and {320, 321, 322} & ids[1] == {322} and {301, 302} & ids[2] == {301}
    assert 310 in ids[2] and 311 not in ids[2] and not {310, 311, 331} & ids[3]

    expected = plain.op8([(r[0], r[1], r[3]) for r in left])
    mixed = sorted((tuple(r) for r in mix.collect()), key=repr)
    assert mix.columns == ["doc_id", "source", "size", "source_size", "target", "virtual_finish", "taken"]
    near = lambda row: tuple(pytest.approx(x) if isinstance(x, float) else x for x in row)
    assert [*mixed] == [near(r) for r in sorted((r for r in expected if r[-1] > 0), key=repr)]
