"""The ledger against plain measurements, policies and ablations against counting."""

from __future__ import annotations

import re
from collections import Counter

from skylattice.llm import quality
from tests_llm_data import SF


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
    times = Counter(windows)
    inside = {k + j for k, w in enumerate(windows) if times[w] > 1 for j in range(8)}
    m = {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(inside),
        "n_lines": len(lines),
        "n_capitals": sum("A" <= c <= "Z" for c in text),
        "n_letters": sum("A" <= c <= "Z" or "a" <= c <= "z" for c in text),
    }
    rules = [
        m["n_words"] < 20,
        100 * m["n_repeat_words"] > 30 * m["n_words"],
        10 * m["n_symbols"] > m["n_words"],
        2 * m["n_dup_lines"] > m["n_lines"],
        m["word_chars"] < 2 * m["n_words"] or m["word_chars"] > 15 * m["n_words"],
        m["n_words"] >= 20 and 10 * m["n_capitals"] > 6 * m["n_letters"],
    ]
    return m, sum(1 << k for k, bad in enumerate(rules) if bad)


def ledger_of(docs):
    return [(r.doc_id, {k: r[k] for k in quality.MEASURES}, r.failed) for r in quality.ledger(docs).collect()]


def test_ledger_equals_plain(spark, odd):
    for docs in (odd, spark.read.parquet(f"{SF}/documents.parquet")):
        texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
        got = ledger_of(docs)
        assert len(got) == len(texts)
        for doc_id, measures, failed in got:
            assert (measures, failed) == plain(texts[doc_id]), doc_id


def test_repeats_and_windows(spark):
    eight = "a b c d e f g h"
    texts = [None, "", " \n ", f"{eight} {eight}", f"{eight}\n{eight}\n{eight} x", "w " * 8, "w " * 9, "w " * 500, "A b " * 30, f"{eight} i {eight}", "x\n\nx\n \nx\t\nx"]
    rows = [(k, t) for k, t in enumerate(texts)] + [(3, texts[3]), (None, texts[4]), (7, "other")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = sorted(((d, tuple(m.values()), f) for d, m, f in ledger_of(docs)), key=str)
    assert got == sorted(((d, tuple(plain(t)[0].values()), plain(t)[1]) for d, t in rows), key=str)


def test_windows_do_not_cross_documents(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g h"), (2, "a b c d e f g h"), (3, "z a b c d e f g h")], "doc_id long, text string").coalesce(1)
    assert {m["n_repeat_words"] for _, m, _ in ledger_of(docs)} == {0}


def test_policies_and_ablations_equal_counting(spark):
    entries = quality.ledger(spark.read.parquet(f"{SF}/documents.parquet"))
    failed = [r.failed for r in entries.collect()]
    for version, rules in quality.POLICIES.items():
        bits = {rule: 1 << list(quality.RULES).index(rule) for rule in rules}
        every = sum(bits.values())
        want = {(rule, sum(f & b > 0 for f in failed), sum(f & every == b for f in failed), sum(f & every & ~b == 0 for f in failed)) for rule, b in bits.items()}
        assert {tuple(r) for r in quality.ablations(entries, version).collect()} == want
        assert quality.apply_policy(entries, version).where("kept").count() == sum(f & every == 0 for f in failed)


def test_ledger_of_nothing(empty):
    assert quality.ledger(empty).count() == 0
