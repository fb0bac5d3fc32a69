"""Token store, packing and byte-level BPE against whole-text encoding by the libraries."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from skylattice.llm import _pieces, _text, bpe, packing, token_store
from tests_llm_data import SF


def library(name):
    t = Tokenizer.from_file(public_tokenizers.path(name))
    return lambda text: t.encode(text, add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def table(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.mark.parametrize("which", ["odd", "table"])
def test_store_equals_library(spark, odd, tmp_path, which):
    docs = odd if which == "odd" else table(spark)
    path = public_tokenizers.path("byte_bpe_50k.json")
    folder = token_store.write(docs, f"file://{tmp_path}/s", path)
    encode = library("byte_bpe_50k.json")
    want = {r.doc_id: [*encode(r.text or ""), 2] for r in docs.select("doc_id", "text").collect()}
    start = 0
    got = {r.doc_id: r for r in token_store.digests(token_store.read(spark, folder)).collect()}
    assert len(got) == len(want)
    for k in sorted(want):
        assert (got[k].start, got[k].n_tokens, got[k].ids_crc32) == (start, len(want[k]), crc(want[k]))
        start += len(want[k])
    some = sorted(want)[5]
    assert [r.ids for r in token_store.read(spark, folder, some, some).collect()] == [want[some]]


def test_store_of_nothing_and_repeats(spark, empty, odd, tmp_path):
    path = public_tokenizers.path("byte_bpe_50k.json")
    assert token_store.digests(token_store.read(spark, token_store.write(empty, f"file://{tmp_path}/e", path))).count() == 0
    rows = spark.createDataFrame([(None, "a"), (3, "b"), (3, "b"), (None, None)], "doc_id long, text string")
    got = token_store.digests(token_store.read(spark, token_store.write(rows, f"file://{tmp_path}/r", path))).collect()
    assert sorted((r.doc_id is not None, r.start) for r in got)[2:] == [(True, 3), (True, 5)]
    assert sorted(r.n_tokens for r in got) == [1, 2, 2, 2]


@pytest.mark.parametrize("which", ["odd", "table"])
def test_packing_is_whole_and_tight(spark, odd, which):
    docs = odd if which == "odd" else table(spark)
    encode = library("word_bpe_49k.json")
    want = {r.doc_id: [*encode(r.text or ""), 1] for r in docs.select("doc_id", "text").collect()}
    pieces, windows = defaultdict(list), defaultdict(list)
    for r in packing.pack(docs, public_tokenizers.path("word_bpe_49k.json")).collect():
        pieces[r.doc_id].append(r)
        windows[r.sequence_id].append(r)
    assert pieces.keys() == want.keys()
    for k, rows in pieces.items():
        at = 0
        for r in sorted(rows, key=lambda r: r.start):
            assert r.start == at and r.length > 0 and r.doc_tokens == len(want[k])
            assert r.ids_crc32 == crc(want[k][at : at + r.length])
            at += r.length
        assert at == len(want[k])
    used = 0
    for rows in windows.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
        used += at
    if which == "table":
        assert used / (2048 * len(windows)) > 0.96


def test_packing_of_nothing(empty):
    assert packing.pack(empty, public_tokenizers.path("word_bpe_49k.json")).count() == 0


def test_word_chunks_are_folded_and_cut_at_marks(monkeypatch):
    asked = []
    encoder, each = _pieces.ChunkEncoder(public_tokenizers.path("word_bpe_49k.json"), False), _pieces.ChunkEncoder._each
    monkeypatch.setattr(_pieces.ChunkEncoder, "_each", lambda self, keys: asked.extend(keys) or each(self, keys))
    texts = ["Ether ether, (ether) ETHER. don't DON'T", "Aber. aber \u00c9ther \u00e9ther"]
    got, n = encoder.encode(np.frombuffer("".join(texts).encode(), np.uint8), np.cumsum([0, *[len(x.encode()) for x in texts]]))
    encode = library("word_bpe_49k.json")
    assert got.tolist() == [k for x in texts for k in encode(x)] and n.tolist() == [len(encode(x)) for x in texts]
    assert sorted(asked) == sorted(x.encode() for x in ["ether", ",", "(", ")", ".", "don", "'t", "aber", "\u00c9ther", "\u00e9ther"])


@pytest.mark.parametrize("seed", range(4))
def test_folded_chunks_equal_library(seed):
    rng = random.Random(seed)
    parts = list("abHIKTSZ'!.,(<|>-_#019 \n\t\u0301\u0331\u0307\u0345\u00a0\u0085\u0130\u017f\u212a\u00df\u00c5\u0958\u0915\u1100\u1161\u2028\u4e2d\U0001f600")
    parts += ["'s", "'LL", "'re", "''s", "H\u0331", "J\u030c", "I\u0307", "ether", "Ether", "<|startoftext|>", "<|STARTOFTEXT|>", "<|endOFtext|>"]
    encoder, encode = _pieces.ChunkEncoder(public_tokenizers.path("word_bpe_49k.json"), False), library("word_bpe_49k.json")
    for special in (True, False):
        texts = ["".join(rng.choices(parts if special else parts[:-3], k=rng.randint(0, 30))) for _ in range(400)]
        got, n = encoder.encode(np.frombuffer("".join(texts).encode(), np.uint8), np.cumsum([0, *[len(x.encode()) for x in texts]]))
        for text, ids in zip(texts, np.split(got, np.cumsum(n)[:-1]), strict=True):
            assert ids.tolist() == encode(text), text


def test_differencing_is_near_equal_and_whole():
    rnd = random.Random(3)
    for _ in range(40):
        sizes = [rnd.randint(1, 512) for _ in range(rnd.randint(1, 300))]
        windows = packing.assign(sizes)
        assert sorted(k for w in windows for k in w) == list(range(len(sizes)))
        fill = [sum(sizes[k] for k in w) for w in windows]
        assert max(fill) <= 2048 and len(windows) <= -(-sum(sizes) // 2048) + 2
        if len(sizes) > 20 * len(windows):
            assert max(fill) - min(fill) < 100
    assert packing.assign([]) == [] and packing.assign([2048, 2048, 1]) != []


def plain_merges(ranks, piece):
    parts = [piece[k : k + 1] for k in range(len(piece))]
    while len(parts) > 1:
        best = min((ranks.get(a + b, 1 << 30), k) for k, (a, b) in enumerate(zip(parts, parts[1:])))
        if best[0] == 1 << 30:
            break
        parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
    return [ranks[p] for p in parts]


def test_rank_queue_equals_plain_merging():
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    own = bpe.Bpe(ranks, public_tokenizers.PATTERN)
    rnd = random.Random(1)
    for _ in range(1500):
        piece = "".join(rnd.choice(rnd.choice(["ab", "aeiouth", "the in er", "é東🎉\n"])) for _ in range(rnd.randint(1, 40))).encode()
        assert own.encode_piece(piece) == plain_merges(ranks, piece), piece
        assert not any(own.queue.mid) and not any(own.queue.low) and not own.queue.buckets
    assert len(own.encode_piece(b"ab" * 200_000)) > 0


@pytest.mark.parametrize("which", ["odd", "table"])
def test_bpe_equals_library(spark, odd, which):
    docs = odd if which == "odd" else table(spark)
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(path), special_tokens={})
    texts = {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}
    got = {r.doc_id: r for r in bpe.digests(docs, path).collect()}
    assert got.keys() == texts.keys()
    for k, text in texts.items():
        ids = own.encode_ordinary(text)
        assert got[k].n_tokens == len(ids)
        assert got[k].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[k].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    back = bpe.decode(bpe.encode(docs, path), path).select("doc_id", "decoded").collect()
    assert {r.doc_id: bytes(r.decoded).decode() for r in back} == texts


def test_bpe_classes_equal_library_on_every_code_point():
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ranks = bpe.load_ranks(path)
    own, theirs = bpe.Bpe(ranks, public_tokenizers.PATTERN), tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    odd = []
    for c in [*range(0x3000), 0x3000, 0xFEFF, *range(0xFF00, 0xFFF0), *range(0x1D400, 0x1D420), *range(0x1F300, 0x1F320)]:
        text = f"a {chr(c)}b  {chr(c)} 1{chr(c)}"
        if own.encode(text) != theirs.encode_ordinary(text):
            odd.append(hex(c))
    assert not odd


def test_memo_keeps_what_is_used_and_stays_bounded():
    memo = _text.Memo(3)
    for k in range(5):
        memo.put(k, np.array([k, k]))
    found = memo.many([0, 1, 2, 3, 4, 9])
    assert all(v is None or int(v[0]) == k for k, v in zip([0, 1, 2, 3, 4, 9], found, strict=True))  # an entry may be gone, never wrong
    assert found[3] is not None and found[4] is not None and found[5] is None
    assert len(memo.new) <= 3 and len(memo.old) <= 3
    for k in range(10, 20):
        memo.put(k, k)
        assert memo.get(10) == 10  # what is used stays


def test_digest_decodes_the_ids_not_the_text():
    import hashlib

    import public_tokenizers
    import pyarrow as pa

    from skylattice.llm import bpe

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoder, memo = bpe._worker(path)
    try:
        memo.put(b"hello", " ".join(map(str, encoder.encode("world"))).encode())
        rows = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text": ["hello there", None]})
        got = next(bpe._run(path, True)(iter([rows])))["decoded_sha256"].to_pylist()
    finally:
        _text._held.clear()
    assert got == [hashlib.sha256(x).hexdigest() for x in (b"world there", b"")]
