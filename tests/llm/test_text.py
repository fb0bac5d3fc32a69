"""Words, chunks and their identity: strings made to defeat polynomial hashes, texts beyond any window, odd spaces."""

from __future__ import annotations

import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from skylattice.llm import _pieces, _text, bpe, dedup_near, langid, lm, packing, quality, token_store


def thue_morse(n: int) -> tuple[str, str]:
    a, b = "a", "b"
    while len(a) < n:
        a, b = a + b, b + a
    return a, b


def columns(texts):
    return _text.buffer(pa.array(texts, pa.string()))


def test_spans_equal_plain_ones_whatever_the_window(monkeypatch):
    rnd = random.Random(1)
    bits = ["a", "b", " ", "\n", "x" * 70, "é", "\u00a0", " ", "東", "  ", "ab.c", "\u3000", "\x1c"]
    for _ in range(300):
        texts = ["".join(rnd.choice(bits) for _ in range(rnd.choice([0, 3, 50, 400]))) for _ in range(rnd.randint(0, 5))]
        data, offsets = columns(texts)
        raw, whole = data.tobytes(), _text.chunks(data, offsets)
        monkeypatch.setattr(_text, "_WINDOW", rnd.choice([1, 2, 7, 50]))
        doc, starts, ends = _text.words(data, offsets)
        want = [(i, w.encode()) for i, t in enumerate(texts) for w in re.findall(r"[^\x20\x09-\x0D]+", t)]
        assert [(d, raw[a:b]) for d, a, b in zip(doc, starts, ends, strict=True)] == want
        first, group = _text.distinct(data, starts, ends)
        assert [raw[starts[first[k]] : ends[first[k]]] for k in group] == [w for _, w in want] and len(first) == len({w for _, w in want})
        assert all(np.array_equal(a, b) for a, b in zip(whole, _text.chunks(data, offsets), strict=True))
        assert b"".join(raw[a:b] for a, b in zip(whole[1], whole[2], strict=True)) == raw
        monkeypatch.undo()


def test_bytes_decide_where_hashes_agree(monkeypatch):
    texts = ["one two three one", "a" * 100 + " " + "b" * 100 + " one " + "a" * 100, "abcdefgh1 abcdefgh2 abcdefgh1"]
    data, offsets = columns(texts)
    _, starts, ends = _text.words(data, offsets)
    raw = data.tobytes()
    monkeypatch.setattr(_text, "hashes", lambda d, s, e: np.zeros(len(s), np.uint64))
    first, group = _text.distinct(data, starts, ends)
    assert [raw[starts[first[k]] : ends[first[k]]] for k in group] == [w.encode() for t in texts for w in t.split()]


def test_strings_that_defeat_polynomials(spark):
    for n in (16, 64, 1024, 4096):
        a, b = thue_morse(n)
        docs = spark.createDataFrame([(k, t) for k, t in zip([k for k in range(1, 40) if zlib.crc32(str(k).encode()) % 7 != 2], (f"{a}\n{b}", f"{b} {a}", a, b))], "doc_id long, text string")
        texts = {r.doc_id: r.text for r in docs.collect()}
        path = public_tokenizers.path("byte_bpe_50k.json")
        library = Tokenizer.from_file(path)
        for name, spaces, want in (("byte_bpe_50k.json", True, library), ("word_bpe_49k.json", False, Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")))):
            ids, counts = _pieces.encoder(public_tokenizers.path(name), spaces).encode(*columns(list(texts.values())))
            assert ids.tolist() == [x for t in texts.values() for x in want.encode(t, add_special_tokens=False).ids]
        ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
        back = bpe.decode(bpe.encode(docs, ranks), ranks).collect()
        assert {r.doc_id: bytes(r.decoded).decode() for r in back} == texts
        assert {r.doc_id: r.n_dup_lines for r in quality.ledger(docs).collect()} == dict.fromkeys(texts, 0)
        assert {r.doc_id: r.component_id for r in dedup_near.link(docs).collect()} == {k: k for k in texts}
        learnt = docs.where(~langid.held_out(F.col("doc_id"), 7, 2)).count()
        scored = lm.train_and_score(docs).collect()
        assert learnt == 4 and {r.train_tokens for r in scored} == {10}
        # a and b are three times each, the end four times, three different tokens
        assert {round(r.base_score, 9) for r in scored if r.n_tokens == 2} == {round(float(np.log10(4 / 14) + np.log10(5 / 14)), 9)}


def long_text(shift: int, size: int = 3_000_000) -> str:
    unit = "x" + " " * 8 + "\u00a0" * 3 + " \u3000" * 4 + "word, and\tmore " + "é" * 5
    return "y" * shift + unit * (size // len(unit.encode()))


@pytest.mark.parametrize("name,spaces", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_long_texts_encode_as_the_library_does(name, spaces):
    library = Tokenizer.from_file(public_tokenizers.path(name))
    own = _pieces.encoder(public_tokenizers.path(name), spaces)
    for shift in range(25):
        text = long_text(shift, 3_000_000 if shift < 3 else 300_000)
        ids, counts = own.encode(*columns(["before", text, "after"]))
        want = library.encode(text, add_special_tokens=False).ids
        assert ids[counts[0] : counts[0] + counts[1]].tolist() == want, shift


def test_long_texts_encode_as_the_other_library_does():
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    theirs = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(path), special_tokens={})
    for shift in range(25):
        text = long_text(shift, 3_000_000 if shift < 3 else 300_000)
        rows = pa.RecordBatch.from_pydict({"doc_id": [1], "text": [text]})
        (batch,) = bpe._run(path, False)(iter([rows]))
        assert batch["ids"][0].as_py() == theirs.encode_ordinary(text), shift


def test_long_texts_in_the_other_operators(spark):
    text = long_text(3)
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    docs = spark.createDataFrame([(1, text), (2, text + "z"), (3, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in quality.ledger(docs).collect()}
    assert got[1].n_words == len(words) and got[1].word_chars == sum(map(len, words)) and got[3].n_words == 0
    assert {r.doc_id: r.n_tokens for r in lm.train_and_score(docs).collect()} == {1: len(words) + 1, 2: len(words) + 1, 3: 1}
    assert {r.doc_id: r.component_id for r in dedup_near.link(docs).collect()} == {1: 1, 2: 1, 3: 3}
    pieces = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json")).where("doc_id = 1").collect()
    assert sum(r.length for r in pieces) == len(Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")).encode(text, add_special_tokens=False).ids) + 1


def test_special_tokens_in_texts_are_what_the_library_makes_of_them():
    texts = ["a <|endoftext|> b", "plain text", "<|startoftext|>x<|endoftext|", "|endoftext|>", "<|endof", "text|> <|endoftext|><|endoftext|>", "", "<|ENDOFTEXT|>"]
    for name, spaces in (("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)):
        library = Tokenizer.from_file(public_tokenizers.path(name))
        ids, counts = _pieces.encoder(public_tokenizers.path(name), spaces).encode(*columns(texts))
        want = [library.encode(t, add_special_tokens=False).ids for t in texts]
        assert counts.tolist() == list(map(len, want)) and ids.tolist() == [x for w in want for x in w]


def test_store_has_stripes_indexes_and_filters_and_prunes(spark, tmp_path):
    """The files' footers hold what the store claims, and a reader skips stripes by them."""
    import pyarrow.orc as orc

    rows = spark.range(4000).select((F.col("id") * 3).alias("doc_id"), F.concat(F.lit("text number "), F.col("id").cast("string")).alias("text"))
    folder = f"{tmp_path}/store"
    token_store.write(rows, f"file://{folder}", public_tokenizers.path("byte_bpe_50k.json"))
    files = sorted(str(p) for p in __import__("pathlib").Path(folder).glob("*.orc"))
    seen = []
    for path in files:
        f = orc.ORCFile(path)
        ids = f.read(columns=["doc_id"])["doc_id"].to_pylist()
        assert f.compression == "ZSTD" and f.row_index_stride == 10000 and f.nstripes >= 1 and ids == sorted(ids)
        assert f.stripe_statistics_length > 0 and f.file_version == "0.12"  # the version with run-length encoding 2
        tail = open(path, "rb").read()
        assert zlib.crc32(tail)  # readable whole
        seen.append((min(ids), max(ids)))
    assert all(a[1] < b[0] for a, b in zip(sorted(seen), sorted(seen)[1:]))  # files hold disjoint ranges
    kinds = [s.getKind().name() for s in _streams(spark, files[0])]
    assert "ROW_INDEX" in kinds and "BLOOM_FILTER_UTF8" in kinds
    some = token_store.read(spark, f"file://{folder}", 300, 300)
    assert "PushedFilters: [IsNotNull(doc_id), GreaterThanOrEqual(doc_id,300), LessThanOrEqual(doc_id,300)]" in some._jdf.queryExecution().executedPlan().toString() + some._jdf.queryExecution().explainString(some._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert [r.doc_id for r in some.collect()] == [300]


def _streams(spark, path):
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    reader = jvm.org.apache.orc.OrcFile.createReader(jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.orc.OrcFile.readerOptions(conf))
    inside = reader.rows()
    return list(inside.readStripeFooter(reader.getStripes().get(0)).getStreamsList())
