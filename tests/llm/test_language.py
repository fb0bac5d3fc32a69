"""Language identification and language-model scores against plain versions and on held-out rows."""

from __future__ import annotations

import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from skylattice.llm import langid
from tests_llm_data import SF


@pytest.fixture(scope="module")
def table(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


def test_held_out_accuracy(table):
    truth = {r.doc_id: r.lang for r in table.select("doc_id", "lang").collect()}
    got = langid.train_and_predict(table).collect()
    assert len(got) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) > 0.97 * len(held)


def test_forward_sums_all_segmentations(table):
    model = langid.fit(table, langid.default_vocabulary())
    forward = langid._Forward(model)
    sp = langid._processor(model.vocabulary)
    pieces = {sp.id_to_piece(k): k for k in range(sp.get_piece_size()) if not (sp.is_byte(k) or sp.is_control(k) or sp.is_unknown(k))}

    def plain(word):
        s = "▁" + word
        f = [np.zeros(len(model.languages))]  # logarithms, summed without scaling
        for e in range(1, len(s) + 1):
            ways = [f[b] + np.log(model.pieces[k]) for b in range(max(0, e - 40), e) for k in [pieces.get(s[b:e], forward.unknown if e - b == 1 else None)] if k is not None]
            f.append(np.logaddexp.reduce(ways, axis=0))
        return f[-1]

    words = ["the", "a", "entlichkeit", "naïve", "東京x", "zzzzqqqq" * 9, "über", "1,2.3", "international" * 3, "x" * 62, "x" * 63, "x" * 64, "x" * 65, "in" * 40]
    words += ["".join(np.random.default_rng(k).choice(["the", "an", "der", "🎉", "q", "international", "東"], 400)) for k in (79, 80, 81)] + ["ab" * 6000, "東京" * 300]
    got = forward.words([w.encode() for w in words])
    for w, row in zip(words, got, strict=True):
        assert np.allclose(row[:-1], plain(w), rtol=1e-9)
        assert row[-1] == any(map(str.isalpha, w))


def test_undetermined_and_odd_rows(spark, odd, empty, table):
    model = langid.fit(table, langid.default_vocabulary())
    rows = [(1, None), (2, ""), (3, "123 .. 45"), (4, "the house is on the hill with that"), (None, "und der ist nicht ein")]
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    assert got[1] == got[2] == got[3] == ("und", 0.0) and got[4][0] == "en" and got[None][0] == "de"
    assert langid.predict(odd, model).count() == odd.count()
    assert langid.predict(empty, model).count() == 0
    nothing = langid.fit(empty, langid.default_vocabulary())
    assert {r.lang_pred for r in langid.predict(odd, nothing).collect()} == {"und"}
    counts = {r.lang: r.n for r in table.where("lang IS NOT NULL").groupBy("lang").agg(F.count("text").alias("n")).collect()}
    most = sorted(sorted(counts, key=lambda x: (-counts[x], x))[:2])
    assert langid.fit(table, langid.default_vocabulary(), max_languages=2).languages == most  # more labels than that: the largest ones


def test_many_labels_and_ties(spark):
    rows = [(k, "same words here", f"l{k % 300:03d}") for k in range(300)]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), langid.default_vocabulary())
    assert model.languages == [f"l{k:03d}" for k in range(200)]
    got = langid.predict(spark.createDataFrame([(1, "same words"), (1, "same words")], "doc_id long, text string"), model).collect()
    assert [r.lang_pred for r in got] == ["l000"] * 2  # the first by name where all are alike


def test_recognition_goes_by_the_score(spark, table, empty):
    model = langid.fit(table, langid.default_vocabulary())
    docs = spark.createDataFrame([(1, "the house is on the hill with that", None), (2, "und der ist nicht ein", "xx"), (3, "123", "en"), (4, None, "en"), (5, "q", None)], "doc_id long, text string, lang string")
    scores = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(docs, model).collect()}
    assert {r.doc_id: r.lang for r in langid.recognised(docs, model, 0.9).collect()} == {k: {1: "en", 2: "xx", 5: scores[5][0]}[k] for k in (1, 2, 5) if scores[k][1] >= 0.9}
    assert scores[5][1] < 1 and 5 not in {r.doc_id for r in langid.recognised(docs, model, 1.0).collect()}
    nothing = langid.fit(empty, langid.default_vocabulary())
    assert {r.doc_id for r in langid.recognised(docs, nothing).collect()} == {1, 2, 5}  # nothing to judge by but letters


def plain_model(rows, order):
    """The same model with dictionaries and one step per token."""
    from collections import Counter

    from skylattice.llm import lm

    def tokens(text):
        return [None] * (order - 1) + ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in _split(text)] + [None]

    def out(doc_id):
        return doc_id is None or zlib.crc32(str(doc_id).encode()) % 7 == 2

    grams, docs = [Counter() for _ in range(order + 1)], 0
    for ts in (tokens(t) for d, t in rows if not out(d)):
        docs += 1
        for k in range(1, order + 1):
            grams[k].update(tuple(ts[e - k : e]) for e in range(order, len(ts) + 1))
    n, v = sum(grams[1].values()), len(grams[1])
    got = {}
    for d, t in rows:
        ts = tokens(t)
        base = score = 0.0
        for e in range(order, len(ts) + 1):
            p = (grams[1][tuple(ts[e - 1 : e])] + 1) / (n + v + 1)
            base += math.log10(p)
            for k in range(2, order + 1):
                history = docs if e == order else grams[k - 1][tuple(ts[e - k : e - 1])]
                p = (grams[k][tuple(ts[e - k : e])] + lm.PRIOR[k - 1] * p) / (history + lm.PRIOR[k - 1])
            score += math.log10(p)
        got.setdefault(d, []).append((out(d), len(ts) - order + 1, sum((w,) in grams[1] for w in ts[order - 1 :]), n, base, score))
    return got


def _split(text):
    import re

    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


@pytest.mark.parametrize("order,block", [(2, 4 << 20), (2, 3000), (3, 3000), (1, 4 << 20)])
def test_scores_equal_the_plain_automaton(spark, odd, monkeypatch, order, block):
    from skylattice.llm import lm

    for docs in (odd, spark.read.parquet(f"{SF}/documents.parquet")):
        rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        want = plain_model(rows, order)
        monkeypatch.setattr(lm, "BLOCK_BYTES", block)
        got = lm.train_and_score(docs, order=order).collect()
        assert len(got) == len(rows)
        for r in got:
            assert any(tuple(r)[1:5] == w[:4] and math.isclose(r.base_score, w[4], rel_tol=1e-9, abs_tol=1e-9) and math.isclose(r.score, w[5], rel_tol=1e-9, abs_tol=1e-9) for w in want[r.doc_id])


def test_longer_histories_help_on_unseen_rows(table):
    from skylattice.llm import lm

    held = [[r for r in lm.train_and_score(table, order=k).collect() if r.held_out] for k in (1, 2, 3)]
    sums = [sum(r.score for r in rows) for rows in held]
    assert sums[0] < sums[1] < sums[2] and math.isclose(sums[0], sum(r.base_score for r in held[0]), rel_tol=1e-9)


def test_a_state_adds_up_to_one():
    """Over all tokens of the vocabulary and the unseen one, after each history."""
    from skylattice.llm import lm

    vocabulary, unigrams, bigrams = 4, np.array([5, 3, 2, 7, 0]), np.array([[2, 1, 0, 2, 0], [0, 0, 0, 0, 0]])
    for n, after in ((5, bigrams[0]), (0, bigrams[1])):
        model = lm.Automaton([unigrams, after], int(unigrams.sum()), vocabulary)
        every = np.arange(5)
        assert math.isclose((10 ** model.walk([every, every], [np.zeros(0), np.full(5, n)])).sum(), 1, rel_tol=1e-12)


def test_scores_of_nothing_and_of_repeats(spark, empty):
    from skylattice.llm import lm

    assert lm.train_and_score(empty).count() == 0
    rows = spark.createDataFrame([(None, "a b"), (None, None)], "doc_id long, text string")
    assert {(r.held_out, r.base_score) for r in lm.train_and_score(rows).collect()} == {(True, 0.0)}
    d = next(k for k in range(40) if zlib.crc32(str(k).encode()) % 7 != 2)
    rows = spark.createDataFrame([(d, "a b"), (d, "a b"), (d, "b")], "doc_id long, text string")
    got = sorted((r.n_tokens, r.train_tokens, round(r.score, 9)) for r in lm.train_and_score(rows).collect())
    assert len(got) == 3 and got[1] == got[2] and got[0][:2] == (2, 8)
