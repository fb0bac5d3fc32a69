"""Exact duplicates and near duplicates against plain versions."""

from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from skylattice.llm import dedup_exact
from tests_llm_data import SF


def plain_groups(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((doc_id, len(text or "")))
    out = []
    for norm, members in groups.items():
        keep = min(members, key=lambda m: (-m[1], m[0] is None, m[0] or 0))[0]
        sha = hashlib.sha256(norm.encode()).hexdigest()
        out += [(d, keep, len(members), d == keep, sha) for d, _ in members]
    return sorted(out, key=str)


def block_texts():
    rnd = random.Random(2)
    made = ["".join(rnd.choice("ab") for _ in range(rnd.choice([0, 1, 7, 8, 9, 16, 31, 64, 200]))) for _ in range(80)]
    spaced = ["".join(c + rnd.choice(["", " ", "\n"]) for c in t) for t in made]
    tails = ["a" * 40 + "b", "a" * 40 + "c", "b" + "a" * 40, "a" * 32, "a" * 33, "é" * 30, "é" * 31]
    return made + spaced + tails + made[:20]


@pytest.mark.parametrize("bits", [64, 3, 1])
def test_exact_equals_plain_whatever_the_hash(spark, bits):
    rows = [(k, t) for k, t in enumerate(block_texts())] + [(5000, None), (5001, ""), (5002, " \n"), (7, block_texts()[7]), (None, "xyz"), (None, "xyz")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    weak = dedup_exact.hash64 if bits == 64 else (lambda c: F.pmod(F.xxhash64(c), F.lit(1 << bits)).cast("long"))
    got = dedup_exact.deduplicate(docs, block_bytes=8, fingerprint=weak).collect()
    assert sorted([tuple(r) for r in got], key=str) == plain_groups(rows)


def test_exact_on_tables(spark, odd, empty):
    for docs in (odd, spark.read.parquet(f"{SF}/documents.parquet")):
        rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        assert sorted([tuple(r) for r in dedup_exact.deduplicate(docs).collect()], key=str) == plain_groups(rows)
    assert dedup_exact.deduplicate(empty).count() == 0


def plain_sets(rows):
    out = {}
    for doc_id, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
        out[doc_id] = {tuple(words[k : k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())
    return out


def plain_components(sets):
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    where = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            where[x].append(d)
    pairs = {(a, b) for ds in where.values() for a in ds for b in ds if a < b}
    for a, b in pairs:
        both = len(sets[a] & sets[b])
        if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {d: find(d) for d in sets}


def families():
    """Copies with growing numbers of changed words, a large family around one text, and shared passages."""
    rnd = random.Random(8)

    def prose(n):
        return [f"w{rnd.randint(0, 4000)}" for _ in range(n)]

    texts, passage = [], prose(60)
    for _ in range(12):
        base = prose(rnd.choice([20, 60, 150]))
        for changes in (0, 0, 1, 1, 2, 3, 4, 6):
            t = list(base)
            for _ in range(changes):
                t[rnd.randrange(len(t))] = f"x{rnd.randint(0, 9999)}"
            texts.append(" ".join(t))
    base = prose(150)
    for _ in range(150):
        t = list(base)
        for _ in range(rnd.randint(1, 4)):
            t[rnd.randrange(len(t))] = f"y{rnd.randint(0, 9999)}"
        texts.append(" ".join(t))
    texts += [" ".join(prose(40) + passage + prose(40)) for _ in range(30)]
    texts += ["a b c d", "A  b c D", "a b c", "", " \n", None, "one", "ONE"]
    rnd.shuffle(texts)
    return texts


@pytest.mark.parametrize("block", [1024, 16])
def test_near_equals_plain(spark, monkeypatch, block):
    from skylattice.llm import dedup_near

    monkeypatch.setattr(dedup_near, "BLOCK", block)
    rows = list(enumerate(families()))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    sets = plain_sets(rows)
    want = plain_components(sets)
    got = {r.doc_id: r for r in dedup_near.link(docs).collect()}
    assert got.keys() == want.keys()
    for d in want:
        assert (got[d].n_shingles, got[d].component_id, got[d].kept) == (len(sets[d]), want[d], want[d] == d)


def test_near_on_tables(spark, odd, empty):
    from skylattice.llm import dedup_near

    for docs in (odd, spark.read.parquet(f"{SF}/documents.parquet")):
        rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        want = plain_components(plain_sets(rows))
        assert {r.doc_id: r.component_id for r in dedup_near.link(docs).collect()} == want
    assert dedup_near.link(empty).count() == 0
    loose = spark.createDataFrame([(None, "a b c d e f"), (None, "a b c d e f"), (4, "a b c d e f"), (4, "a b c d e f")], "doc_id long, text string")
    assert sorted(tuple(r)[:4] for r in dedup_near.link(loose).collect() if r.doc_id) == [(4, 2, 4, True)] * 2
    assert dedup_near.link(loose).count() == 4


def test_components_of_hubs_and_chains(spark):
    from skylattice.llm import _graph
    from skylattice.llm._shared import Scratch

    rnd = random.Random(4)
    edges = [(5000, k) for k in range(4000, 4300)] + [(7, k) for k in range(3000, 3300)] + [(3100, 4100)]
    edges += [(k, k + 1) for k in range(100, 160)] + [(rnd.randint(200, 400), rnd.randint(200, 400)) for _ in range(150)]
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    with Scratch(spark, "graph") as scratch:
        got = {r.u: r.v for r in _graph.components(scratch, spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: find(x) for x in root if find(x) != x}
