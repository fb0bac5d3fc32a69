"""The pipeline against plain versions of its stages."""

from __future__ import annotations

import re
from collections import defaultdict

import corpus_pipeline
from test_dedup import plain_components, plain_groups, plain_sets
from test_detect import plain_pii
from tests_llm_data import SF


def test_stages_do_what_plain_versions_do(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(f"file://{tmp_path}/{name}")
        docs = spark.read.parquet(f"file://{tmp_path}/{name}")
        if name != "pack":
            assert docs.columns == list(corpus_pipeline.COLUMNS)
            seen[name] = {r.doc_id: r.text for r in docs.collect()}
    left = {d: t for d, t in texts.items() if any(map(str.isalpha, t or ""))}
    assert seen["language_id"] == left
    left = {d: left[d] for d, _, _, kept, _ in plain_groups(list(left.items())) if kept}
    assert seen["exact_dedup"] == left
    root = plain_components(plain_sets(list(left.items())))
    left = {d: t for d, t in left.items() if root[d] == d}
    assert seen["near_dedup"] == left
    assert seen["redact_pii"].keys() == left.keys()
    for d, t in left.items():
        if spans := plain_pii(t):
            assert not plain_pii(seen["redact_pii"][d])
            assert all(t[a:b] not in seen["redact_pii"][d] for a, _, b, _ in spans if b - a > 6)
        elif "[" not in seen["redact_pii"][d]:
            assert seen["redact_pii"][d] == t
    pieces = defaultdict(int)
    for r in docs.collect():
        pieces[r.doc_id] += r.length
        assert r.length <= r.doc_tokens
    assert pieces.keys() == left.keys()


def test_pipeline_of_odd_rows_and_of_nothing(spark, odd, empty):
    for rows in (odd, empty):
        docs = rows.drop("n_words")
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF)
        got = docs.collect()
        assert bool(got) == bool(rows.count())
    shown = {r.doc_id: r.text for r in odd.collect()}
    assert all(re.search(r"\w", shown[r.doc_id] or "") for r in corpus_pipeline.language_id(spark, odd, SF).collect())
