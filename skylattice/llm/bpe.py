"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

Each merge rank has a bucket of linked-list positions; three levels of 64-bit words say which buckets hold any, so that
find-first-set on three words gives the lowest rank. A merge leaves its neighbours' old entries behind; an entry whose
pair has changed since is stale and is skipped. A pre-token of n bytes takes O(n log n) at worst, however long it is.

Defined results: a null or empty text has no ids; rows are independent, so repeated rows and rows that share a doc_id repeat
their results, and a row with a null doc_id keeps it; a text of any length is one unit of work, cut nowhere; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skylattice.llm import _text
from skylattice.llm._shared import documents


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class RankQueue:
    """Positions by rank: buckets, and bitmaps of three levels over the ranks whose buckets hold any.

    `spots` gives a rank's word and bit at each level, so that marking it takes three ORs.
    """

    def __init__(self, ranks: int) -> None:
        self.low = [0] * (ranks // 64 + 1)
        self.mid = [0] * (ranks // 4096 + 1)
        self.buckets: dict[int, list[int]] = {}
        self.spots = [(r >> 6, 1 << (r & 63), r >> 12, 1 << (r >> 6 & 63), 1 << (r >> 12)) for r in range(ranks)]


class Bpe:
    """Encoder and decoder of one vocabulary; `pattern` splits a text into pre-tokens."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.shown = {str(rank).encode(): token for token, rank in ranks.items()}
        # \s is White_Space for the original pattern's engine; that of `regex` has four controls more
        self.split = regex.compile(pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")).findall
        self.queue = RankQueue(max(ranks.values()) + 1)

    def encode_piece(self, piece: bytes) -> list[int]:
        """The ids of one pre-token."""
        find = self.ranks.get
        if (whole := find(piece)) is not None:
            return [whole]
        n = len(piece)
        after, before, pair = list(range(1, n + 1)), list(range(-1, n - 1)), [-1] * n
        low, mid, buckets, spots = self.queue.low, self.queue.mid, self.queue.buckets, self.queue.spots
        top = 0
        for k in range(n - 1):
            rank = find(piece[k : k + 2])
            if rank is not None:
                pair[k] = rank
                if rank in buckets:
                    buckets[rank].append(k)  # positions rise, so the bucket stays a heap
                else:
                    buckets[rank] = [k]
                    a, x, b, y, z = spots[rank]
                    low[a] |= x
                    mid[b] |= y
                    top |= z
        while top:
            # find-first-set, level by level
            b = (top & -top).bit_length() - 1
            bits = mid[b]
            a = (b << 6) + (bits & -bits).bit_length() - 1
            bits = low[a]
            rank = (a << 6) + (bits & -bits).bit_length() - 1
            bucket = buckets[rank]
            if len(bucket) > 1:
                k = heappop(bucket)
            else:
                k = bucket[0]
                del buckets[rank]
                low[a] = bits = bits & (bits - 1)
                if not bits:
                    mid[b] = bits = mid[b] & (mid[b] - 1)
                    if not bits:
                        top &= top - 1
            if pair[k] != rank:
                continue  # stale
            gone = after[k]
            end = after[gone]
            after[k] = end
            pair[gone] = pair[k] = -1
            left = before[k]
            fresh = []
            if end < n:
                before[end] = k
                new = find(piece[k : after[end]])
                if new is not None:
                    pair[k] = new
                    fresh.append((new, k))
            if left >= 0:
                new = find(piece[left:end])
                if new is None:
                    pair[left] = -1
                else:
                    pair[left] = new
                    fresh.append((new, left))
            for new, k in fresh:
                if new in buckets:
                    heappush(buckets[new], k)
                else:
                    buckets[new] = [k]
                    a, x, b, y, z = spots[new]
                    low[a] |= x
                    mid[b] |= y
                    top |= z
        ids, k = [], 0
        while k < n:
            ids.append(find(piece[k : after[k]]))
            k = after[k]
        return ids

    def encode(self, text: str) -> list[int]:
        return [x for piece in self.split(text) for x in self.encode_piece(piece.encode())]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))

    def decode_shown(self, ids: bytes) -> bytes:
        """As decode(), of decimals joined by spaces."""
        return b"".join(map(self.shown.__getitem__, ids.split()))


#: Bytes of text handled at once: chunks repeat, so a larger slice has fewer to look up.
_SLICE = 6 << 20


def _worker(path: str) -> tuple[Bpe, _text.Memo]:
    """Of a worker process: the encoder, and chunks' ids as decimals joined by spaces."""
    return _text.held(("bpe", path), lambda: (Bpe(load_ranks(path), public_tokenizers.PATTERN), _text.Memo(450_000)))


def _chunks(rows: pa.RecordBatch, path: str) -> tuple[list[tuple[int, int]], np.ndarray, list[bytes]]:
    """Each document's first and last in the list of chunks, each chunk as a number, and of the numbers the ids.

    No pre-token goes on past a whitespace that follows a non-whitespace, or from a letter to a mark, so a text's ids
    are its chunks' ids in order.
    """
    bpe, memo = _worker(path)
    data, offsets = _text.buffer(rows["text"])
    doc, starts, ends = _text.chunks(data, offsets)
    first, number = _text.distinct(data, starts, ends)
    raw = data.tobytes()
    keys = [raw[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)]
    shown = memo.many(keys)
    for k in [k for k, v in enumerate(shown) if v is None]:
        shown[k] = " ".join(map(str, bpe.encode(keys[k].decode()))).encode()
        if len(keys[k]) <= 64:
            memo.put(keys[k], shown[k])
    at = np.searchsorted(doc, np.arange(rows.num_rows + 1)).tolist()
    return list(zip(at[:-1], at[1:], strict=True)), number, shown


def _run(path: str, digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = _worker(path)[0].decode_shown
        for batch in batches:
            for rows in _text.slices(batch, limit=_SLICE):
                bounds, number, shown = _chunks(rows, path)
                numbers = number.tolist()
                lists = [b" ".join(map(shown.__getitem__, numbers[a:b])) for a, b in bounds]
                counts = pa.array([x.count(b" ") + 1 if x else 0 for x in lists], pa.int64())
                if not digest:
                    ids = [np.fromstring(x, np.int32, sep=" ") if x else np.zeros(0, np.int32) for x in lists]
                    yield pa.RecordBatch.from_arrays([rows["doc_id"], counts, pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "n_tokens", "ids"])
                    continue
                ids_sha = [hashlib.sha256(x).hexdigest() for x in lists]
                text_sha = [hashlib.sha256(decode(x)).hexdigest() for x in lists]
                yield pa.RecordBatch.from_arrays([rows["doc_id"], counts, pa.array(ids_sha), pa.array(text_sha)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return run


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))


def encode(docs: DataFrame, ranks: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens and ids of every text. One pass, no shuffle."""
    return _rows(docs, id_col, text_col).mapInArrow(_run(ranks, False), "doc_id long, n_tokens long, ids array<int>")


def decode(encoded: DataFrame, ranks: str, ids_col: str = "ids") -> DataFrame:
    """`encoded` with the bytes its ids stand for, as `decoded`; null ids give null."""

    @F.pandas_udf("binary")
    def bytes_of(ids):
        bpe, _ = _worker(ranks)
        return ids.map(lambda x: None if x is None else bpe.decode(x))

    return encoded.withColumn("decoded", bytes_of(F.col(ids_col)))


def digests(docs: DataFrame, ranks: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, and the hashes of the ids as text and of the bytes they decode to."""
    return _rows(docs, id_col, text_col).mapInArrow(_run(ranks, True), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken"))
