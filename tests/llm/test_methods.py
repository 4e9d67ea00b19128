"""Names by rank, linear scans, the library's lower case, repeated ledger runs, unbounded addresses and features."""

from __future__ import annotations

import json
import random
import time

import pytest

from starlattice.llm import decontam, exact_dedup, pii, secrets, tokens, toxicity
from starlattice.session import scratch_path

from . import plain


def test_exact_names_do_not_depend_on_partitions(spark):
    """A name is a rank: the same over any dealing of rows and any number of partitions."""
    rnd = random.Random(5)
    texts = ["".join(rnd.choice("ab") for _ in range(rnd.randrange(0, 40))) for _ in range(400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    before, got = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for parts in (2, 7):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            names = exact_dedup.document_names(docs.repartition(parts), 5).collect()
            got.append(sorted((r["doc_id"], r["n"], r["name"]) for r in names))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got[0] == got[1]
    # names of one block are ranks of the distinct blocks in sorted order
    blocks = sorted({t[i:i + 5] for t in texts for i in range(0, max(1, len(t)), 5)})
    assert {texts[d]: name for d, n, name in got[0] if n == 1} == {t: blocks.index(t) for t in texts if len(t) <= 5}


def per_word(item: bytes, doc: bytes) -> float:
    automaton = decontam.build([("a", item.decode(), False)], decontam.WINDOW)
    words = decontam.word_ids(doc.decode(), automaton.ids)
    best = min((lambda t: (automaton.scan(words), time.perf_counter() - t)[1])(time.perf_counter()) for _ in range(3))
    return best / len(words)


def test_items_of_equal_words_cost_no_more_a_word():
    doc = b"x " * 20_000
    assert per_word(b"x " * 9_000, doc) < 5 * per_word(b"x " * 100, doc) + 1e-6


def test_many_items_of_one_word_cost_no_more_a_word():
    pieces = [(str(i), "x", True) for i in range(5_000)]
    automaton = decontam.build(pieces, decontam.WINDOW)
    began = time.perf_counter()
    spans, items = automaton.scan(decontam.word_ids("x " * 5_000, automaton.ids))
    assert spans == [(0, 5_000)] and len(items) == 5_000
    assert time.perf_counter() - began < 2


def test_repeating_items_equal_brute_force(spark):
    rnd = random.Random(11)
    word = lambda: rnd.choice("ab")
    items = [(i, " ".join(word() for _ in range(rnd.choice([1, 2, 5, 12, 13, 14, 40])))) for i in range(40)] + [(99, "a " * 60), (98, "a a a")]
    docs = [(i, " ".join(rnd.choice(["a", "b", "c"][:2 + (i % 2)]) for _ in range(rnd.randrange(0, 80)))) for i in range(80)] + [(500, "a " * 90)]
    out = decontam.benchmark_hits(spark.createDataFrame(docs, "doc_id long, text string"),
                                  spark.createDataFrame(items, "item_id long, text string"))
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert sorted(map(tuple, out.select(*columns).collect())) == sorted(map(tuple, plain.op2(docs, items)))


def test_lower_case_equals_the_library_over_all_code_points():
    from tokenizers import normalizers

    library = normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()])
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    assert [hex(ord(c)) for c in points if library.normalize_str(c) != tokens.normal(c)] == []
    for text in ("ΑΣ ΣΑΣ", "aꟋz İ", "É́", "\U00010d50\U00016eb8"):
        assert library.normalize_str(text) == tokens.normal(text)


def test_token_counts_of_newer_letters(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    texts = [chr(c) + " x" + chr(c) for c in tokens.NEWER_LOWER]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["n_tokens"] for r in tokens.token_counts(docs, path).collect()}
    assert got == {i: len(library.encode(t, add_special_tokens=False).ids) for i, t in enumerate(texts)}


def test_unknown_normalisers_are_refused(tmp_path):
    import public_tokenizers

    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        spec = json.load(f)
    spec["normalizer"] = {"type": "NFKC"}
    path = tmp_path / "other.json"
    path.write_text(json.dumps(spec))
    with pytest.raises(ValueError, match="normaliser not known"):
        tokens.load_merges(str(path))


def test_a_ledger_takes_run_after_run(spark):
    docs = spark.createDataFrame([(1, "token=abcdef"), (2, None)], "doc_id long, text string")
    ledger = scratch_path(spark, "ledger-test")
    first, second = [sorted(map(tuple, secrets.secrets(docs, ledger).collect())) for _ in range(2)]
    assert first == second and len(first) == 2
    # every pair of blob and rule was scanned by the first run
    assert secrets.read_ledger(spark, ledger).count() == 2


def test_long_addresses_are_candidates(spark):
    long = "contact: " + "a" * 100 + " [at] " + "b" * 80 + " [dot] com"
    short = "contact: " + "a" * 10 + " [at] " + "b" * 8 + " [dot] com"
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([long, short] * 20)], "doc_id long, text string")
    spans = {r["doc_id"] % 2: r["spans"] for r in pii.personal_data(docs).collect()}
    assert bool(spans[0]) == bool(spans[1])


def test_no_significant_feature_is_left_out(spark):
    """More than 4,096 telling words all become features."""
    rnd = random.Random(2)
    words = [f"{chr(97 + i % 26)}{i}" for i in range(5_000)]
    rows = []
    for i in range(160):
        toxic = i % 2
        rows.append((str(i), " ".join(words) if toxic else " ".join(f"q{rnd.randrange(9)}" for _ in range(20)), toxic))
    sample = spark.createDataFrame(rows, "id string, text string, toxic int")
    found = toxicity.significant_features(sample)
    assert {w.encode() for w in words} <= set(found)
