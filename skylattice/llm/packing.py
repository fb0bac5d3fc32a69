"""Packing token sequences into fixed windows by multiway differencing.

Documents are encoded and cut: whole windows come off a long document as they are, the rest is cut into near-equal parts
of at most a quarter of a window. The parts of a batch of documents are dealt over k windows by Karmarkar-Karp
differencing: the two partial partitions with the largest imbalances are merged, the largest subsets of one meeting the
smallest of the other, until one partition is left. k starts at the least number that could do and rises while the
fullest window exceeds its capacity. Batches lie within a partition, so there is no shuffle and a lost task is redone
alone; batches are bounded in tokens, so memory does not follow the input.

Defined results: a null or empty text is its end id alone; repeated rows and rows that share a doc_id are packed each on its
own; a text of any length is encoded whole; an empty table gives no pieces; other columns are not read; rows with a null doc_id
are packed like the others.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skylattice.llm import _text
from skylattice.llm._pieces import SLICE_BYTES, encoder, with_end
from skylattice.llm._shared import documents

CAPACITY = 2048
END_ID = 1
#: Windows' worth of tokens that are dealt together.
BATCH_WINDOWS = 160
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def _merge(a: list, b: list, windows: int) -> list:
    """Two partial partitions as one: (size, parts) subsets, largest first; subsets without parts are left out."""
    over = len(a) + len(b) - windows
    if over <= 0:
        merged = a + b
    else:  # opposing order: the smallest of one and the largest of the other; subsets beyond the other's stay as they are
        full = windows - len(b)
        met = [(x[0] + y[0], (x[1], y[1])) for x, y in zip(a[full:], reversed(b[windows - len(a) :]), strict=True)]
        merged = a[:full] + met + b[: windows - len(a)]
    merged.sort(key=itemgetter(0), reverse=True)
    return merged


def differencing(sizes: list[int], windows: int) -> list[tuple[int, object]]:
    """Karmarkar-Karp for `windows` subsets: (size, nested pairs of item numbers), largest first, empty ones left out."""
    heap = [(-size, k, [(size, k)]) for k, size in enumerate(sizes)]
    heapq.heapify(heap)
    order = len(heap)
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[2], heapq.heappop(heap)[2]
        both = _merge(a, b, windows)
        heapq.heappush(heap, (both[-1][0] * (len(both) == windows) - both[0][0], order, both))
        order += 1
    return heap[0][2] if heap else []


def _items(tree: object) -> list[int]:
    found, left = [], [tree]
    while left:
        x = left.pop()
        if isinstance(x, tuple):
            left.extend(x)
        else:
            found.append(x)
    return sorted(found)


def assign(sizes: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """The items of each window; no window exceeds `capacity`. The number of windows rises until that holds."""
    windows = -(-sum(sizes) // capacity)
    while windows:
        parts = differencing(sizes, windows)
        if parts[0][0] <= capacity:
            return [_items(tree) for _, tree in parts]
        windows += 1
    return []


def cuts(length: int, capacity: int = CAPACITY) -> tuple[int, list[int]]:
    """Whole windows at the front of a document, and the sizes of the parts of the rest."""
    whole, rest = divmod(length, capacity)
    parts = -(-rest // (capacity // 4))
    return whole, [rest * (k + 1) // parts - rest * k // parts for k in range(parts)]


def _pack(path: str, end: int, capacity: int, batch_windows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, sequence = encoder(path, False).encode, TaskContext.get().partitionId() << 40
        held: list[tuple] = []  # pieces that wait for windows: doc_id, start, length, crc, doc_tokens
        tokens = 0

        def table(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows, strict=True)], [x.split()[0] for x in SCHEMA.split(", ")])

        def deal() -> Iterator[tuple]:
            nonlocal sequence
            for window in assign([p[2] for p in held], capacity):
                at = 0
                for k in window:
                    yield (*held[k], sequence, at)
                    at += held[k][2]
                sequence += 1
            held.clear()

        for batch in batches:
            for rows in _text.slices(batch, limit=SLICE_BYTES):
                ids, offsets = with_end(*encode(*_text.buffer(rows["text"])), end)
                raw = memoryview(ids.astype("<u4")).cast("B")
                out: list[tuple] = []
                for doc_id, a, b in zip(rows["doc_id"].to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                    whole, rest = cuts(b - a, capacity)
                    at = a
                    for k, size in enumerate([capacity] * whole + rest):
                        piece = (doc_id, at - a, size, zlib.crc32(raw[4 * at : 4 * (at + size)]), b - a)
                        at += size
                        if k < whole:
                            out.append((*piece, sequence, 0))
                            sequence += 1
                        else:
                            held.append(piece)
                            tokens += size
                    if tokens >= batch_windows * capacity:
                        out += deal()
                        tokens = 0
                if out:
                    yield table(out)
        if held:
            yield table(list(deal()))

    return run


def pack(docs: DataFrame, tokenizer: str, end: int = END_ID, capacity: int = CAPACITY, batch_windows: int = BATCH_WINDOWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece; sequence_id is unique over all partitions. `capacity` is at least 4."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_pack(tokenizer, end, capacity, batch_windows), SCHEMA)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
