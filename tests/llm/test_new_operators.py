"""Operators 11 to 13 against plain versions."""

from __future__ import annotations

import random

import numpy as np
import pytest

from pyspark.sql import functions as F

from starlattice.llm import collocations as C
from starlattice.llm import quality as Q
from starlattice.llm import repair as R

from . import plain

DOCS = "doc_id long, text string, lang string, source string, n string, words int, phrase string, f int"


def phrase_rows():
    rnd = random.Random(5)
    vocab = ["a", "b", "B", "c.", "d,", "é", "É", "世", "x\x0by", "w v", "n\x00n", "long" * 50]
    rows = []
    for i in range(300):
        seps = [" ", " ", " ", "\t", "  ", "\n", "! ", " \n "]
        text = "".join(rnd.choice(vocab) + rnd.choice(seps) for _ in range(rnd.randrange(60)))
        rows.append((i, text, rnd.choice(["en", "en", "fr", None, "und", "e\nn", ""])))
    rows += [(1000, None, "en"), (1001, "", None), (1002, " \t\n.", "zz"), (1003, "tie one. tie two. " * 12, "ties"),
             (1004, "new york city. " * 11 + "new york. " * 12, "ties"), (5, "a a a a a a a a a a a a a a", "rep"), (5, "a b " * 4000, "rep")]
    return [(d, t, lang, "s", "x", 1, "y", 2) for d, t, lang in rows]


@pytest.mark.parametrize("shape", ["one", "many"])
def test_collocations(spark, shape, monkeypatch):
    if shape == "many":  # tiny counters, shards, passes, stretches and ranking steps
        monkeypatch.setattr(C, "STRETCH", 200)
        monkeypatch.setattr(C, "FLUSH", 40)
        monkeypatch.setattr(C, "RANKED_AT_ONCE", 10)
    rows = phrase_rows()
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    least, top = (3, 7) if shape == "many" else (10, 2000)
    more = dict(shard_phrases=60, pass_bytes=800_000, counter_bits=8) if shape == "many" else dict(counter_bits=18)
    got = sorted(tuple(r) for r in C.collocations(docs, least=least, top=top, **more).collect())
    assert got == plain.collocations([(r[2], r[1]) for r in rows], least, 3, top)
    assert got


def test_collocations_of_longer_phrases_and_none(spark):
    rows = phrase_rows()
    docs = spark.createDataFrame(rows, DOCS)
    got = sorted(tuple(r) for r in C.collocations(docs, least=4, max_words=4, counter_bits=14).collect())
    assert got == plain.collocations([(r[2], r[1]) for r in rows], 4, 4)
    assert C.collocations(docs.limit(0), counter_bits=10).collect() == []
    assert C.collocations(docs.filter("doc_id in (1000, 1001, 1002)"), counter_bits=10).collect() == []


def test_shards_of_a_pass_look_words_up_once_and_share_the_positions(monkeypatch):
    rng = random.Random(5)
    data = b"\n".join(b" ".join(b"w%d" % rng.randrange(60) for _ in range(rng.randrange(12))) for _ in range(400))
    words, ids, piece = C.numbered(data)
    places = C.whole(piece, 2)
    phrases = sorted({("en", f"{words[ids[p]].decode()} {words[ids[p + 1]].decode()}") for p in places.tolist() if rng.random() < 0.7})
    packed = [(n, C.pack(phrases[at:at + 100])) for n, at in enumerate(range(0, len(phrases), 100))]
    alone = [C.Trie(p).counts("en", words, ids, piece, 2) for _, p in packed]
    walked, walk = [], C.Trie.walk
    monkeypatch.setattr(C.Trie, "walk", lambda self, start, symbols: walked.append(len(symbols[0])) or walk(self, start, symbols))
    forest = C.Forest(packed)
    for _ in range(2):
        forest.add("en", words, ids, piece, 2)
        forest.add("xx", words, ids, piece, 2)
    assert len(packed) > 8 and [n for n, _ in forest.tries] == list(range(len(packed)))
    assert all((2 * a == t).all() for a, t in zip(alone, forest.totals))
    assert sum(walked) < 2 * 2 * len(places)  # a position in about one shard, however many there are


def test_texts_are_numbered_once_and_rare_phrases_are_no_candidates(spark, monkeypatch):
    rng = random.Random(6)
    rows = [(" ".join(f"w{rng.randrange(300)}" for _ in range(200)), "en") for _ in range(300)]
    docs = spark.createDataFrame(rows + [("Often seen, often seen words", "en")] * 40, "text string, lang string").repartition(4)
    kept, write = {}, C.materialize
    monkeypatch.setattr(C, "materialize", lambda df, name, **options: kept.setdefault(name, write(df, name, **options)))
    frequent = lambda k: kept[f"phrases-{k}"].count()
    C.collocations(docs, least=12).collect()
    assert kept["phrase-texts"].columns == ["lang", "words", "ids", "begins"]
    for k in (2, 3):  # about 60,000 rare triples
        assert 0 < frequent(k) <= kept[f"phrase-candidates-{k}"].count() <= frequent(k) * 1.05 + 3
    read = list(C.decoded(kept["phrase-texts"].toArrow().to_batches()))
    own = [(w[n], p) for _, w, i, piece in read for n, p in zip(i.tolist(), piece.tolist())]
    assert sum(w == b"often" for w, _ in own) == 80 and sum(len(i) for _, _, i, _ in read) == 300 * 200 + 40 * 5


def test_double_array_holds_exactly_its_phrases():
    rnd = random.Random(3)
    phrases = sorted({(rnd.choice(["en", "fr"]), f"w{rnd.randrange(300)} w{int(rnd.paretovariate(0.5)) % 5000}") for _ in range(20000)})
    trie = C.Trie(C.pack(phrases))
    text = [f"w{rnd.randrange(350)}" for _ in range(30000)]
    words, ids, piece = C.numbered(" ".join(text).encode())
    counts = trie.counts("fr", words, ids, piece, 2)
    place = {p: i for i, p in enumerate(phrases)}
    expected = np.zeros(len(phrases), np.int64)
    for pair in zip(text, text[1:]):
        at = place.get(("fr", " ".join(pair)))
        if at is not None:
            expected[at] += 1
    assert expected.sum() and (counts == expected).all()
    assert trie.counts("xx", words, ids, piece, 2) is None


TURNS = "conv_id long, turn long, role string, text string, kind string, sha string, copy int, place long, of int"


def turn_rows():
    rnd = random.Random(11)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "u"]
    texts = ["Hi.", "yes!", "no", "Why? ", "a.b", "", " \t", None, "so\n", "é。", "long. " * 3000]
    rows = []
    for conv in range(250):
        for turn in range(rnd.randrange(9)):
            rows.append((conv, rnd.choice([turn, turn, turn, None, turn * 3 - 4]), rnd.choice(roles), rnd.choice(texts)))
    for turn in range(700):
        rows.append((900, turn, rnd.choice(roles[:5]), rnd.choice(texts[:5]) + str(rnd.randrange(90)) + "."))
    rows += [(901, 1, "user", "same.")] * 40 + [(None, 1, "user", "A."), (None, 2, "assistant", "B."), (902, 0, "user", "x")]
    return [(*r, "k", "s", 1, 2, 3) for r in rows]


@pytest.mark.parametrize("bits", [12, 1])
def test_repairs(spark, bits, monkeypatch):
    monkeypatch.setattr(R, "PIECE_BITS", bits)  # pieces of two rows: nearly every conversation is chained
    rows = turn_rows()
    turns = spark.createDataFrame(rows, TURNS).repartition(5)
    got = sorted((tuple(r) for r in R.conversation_repairs(turns).collect()), key=repr)
    assert got == sorted(plain.repairs([r[:4] for r in rows]), key=repr)


def test_repairs_of_nothing_and_repaired_turns(spark):
    turns = spark.createDataFrame(turn_rows(), TURNS)
    assert R.conversation_repairs(turns.limit(0)).collect() == []
    steps = R.repaired_turns(turns).collect()
    by_conv = {}
    for r in sorted(steps, key=lambda r: (r["conv_id"] is None, r["conv_id"] or 0, r["step"])):
        by_conv.setdefault(r["conv_id"], []).append(r)
    import re
    for conv in by_conv.values():
        assert re.fullmatch("(s?(ua)+)?", "".join((r["role"] or "")[:1] for r in conv if r["edit"] != "D"))
    assert sum(r["edit"] != "I" for r in steps) == turns.count()


def test_auction_prices_are_distances():
    rnd = random.Random(2)
    for _ in range(300):
        units = [R.row_arcs(rnd.choice("suat"), rnd.randrange(4)) for _ in range(rnd.randrange(8))]
        price = R.prices(units, R.ENDS)
        best = list(R.ENDS)
        columns = [None] * len(units) + [best]
        for i in range(len(units), -1, -1):
            now = list(R.ENDS) if i == len(units) else [min(c + columns[i + 1][to] for c, to, _ in units[i][q]) for q in range(4)]
            for _ in range(4):
                now = [min(now[q], 3 + now[R.NEXT[q][R.WANTED[q]]]) for q in range(4)]
            columns[i] = now
        assert price == columns
        cut = rnd.randrange(len(units) + 1)
        parts = [R.matrix_arcs(R.matrix(x)) for x in (units[:cut], units[cut:])]
        assert R.prices(parts, R.ENDS)[0] == columns[0]


def quality_rows():
    rnd = random.Random(9)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randrange(2, 9)))
    rows = []
    for i in range(1500):
        n = rnd.randrange(25, 200)
        lines = [" ".join(word() for _ in range(10)).capitalize() + "." for _ in range(n // 10 + 2)]
        rows.append((i, "\n".join(lines), ["en", "fr", None][i % 3], ["a", "b", None, "c"][i % 4 if i % 9 else 0], False))
    for i in range(1500, 1530):
        bad = [" ".join(word() + "###" for _ in range(60)), " ".join(word().upper() + "!!" for _ in range(60)),
               " | ".join(word() for _ in range(60))]
        rows.append((i, bad[i % 3], "en", "a", True))
    line = " ".join(word() for _ in range(12))
    rows += [(2000, None, "en", "a", False), (2001, "", None, None, False), (2002, "few words", "en", "a", False),
             (2003, (line + "\n") * 9, "en", "a", False), (2004, "é 世 " * 4000, "xx", "y", False), (2004, " \t\n\n", "xx", "y", False),
             (None, " ".join(word() for _ in range(9000)), "zz", "only", False), (7, line + " " + line[:40] + "\n \n \n" + line, "en", "a", False)]
    return rows


def quality_table(spark):
    return (spark.createDataFrame([r[:4] for r in quality_rows()], "doc_id long, text string, lang string, source string")
            .withColumns({c: F.lit("clash") for c in ("gid", "start", "n", "x0", "mean", "n_words", "kept", "level")}))


def test_quality_base_columns_and_verdicts(spark):
    rows = quality_rows()
    out = Q.quality(quality_table(spark).repartition(4), least_rows=100).collect()
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    got = sorted((tuple(r[c] for c in columns) for r in out), key=repr)
    assert got == sorted((plain.quality_base(r[0], r[1]) for r in rows), key=repr)
    assert all(r["kept"] is False for r in out if r["base_failed"])
    bad = {r[0] for r in rows if r[4]}
    assert all(not r["kept"] for r in out if r["doc_id"] in bad)
    clean = [r["kept"] for r in out if r["doc_id"] is not None and r["doc_id"] < 1500 and r["doc_id"] != 7]
    assert sum(clean) == len(clean)
    again = Q.quality(quality_table(spark).repartition(2), least_rows=100).collect()
    assert sorted(map(tuple, again), key=repr) == sorted(map(tuple, out), key=repr)  # whatever the partitions
    # distances against concentration steps over whole arrays, one group at a time
    expected = plain.quality_distances(Q, [(r[0], r[1], r[2], r[3]) for r in rows], 100)
    near = {r["doc_id"]: r["distance"] for r in out if not r["base_failed"] and r["doc_id"] != 7}
    for doc, distance in expected.items():
        if doc != 7 and distance is not None:
            assert near[doc] == pytest.approx(distance, rel=0.15, abs=0.5)
        elif doc != 7:
            assert near[doc] is None


def test_quality_of_nothing(spark):
    docs = quality_table(spark)
    assert Q.quality(docs.limit(0)).collect() == []
    few = Q.quality(docs.filter("doc_id in (1, 2, 2000, 2001)")).collect()
    assert {r["doc_id"]: r["kept"] for r in few} == {1: True, 2: True, 2000: False, 2001: False}
