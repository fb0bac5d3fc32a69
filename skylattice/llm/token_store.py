"""Token ids in ORC: integer run-length encoded stripes with row indexes and Bloom filters on the document ids.

`write` deals documents by ranges of doc_id, encodes each range in order and writes it as one file, so files and
stripes hold disjoint, ascending id ranges: readers prune by the stripes' statistics, the row index and the Bloom
filter, and read stripes in parallel. Every row knows its file's number and its place in it; the ids before a
document follow from the files' sums, which need the `n_tokens` stream alone.

Defined results: a null or empty text is the end id alone; rows with a null doc_id come first; rows that share a doc_id
are all kept, side by side; a text of any length is encoded whole; an empty table gives a store without rows; other columns
are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skylattice.llm import _text
from skylattice.llm._pieces import SLICE_BYTES, encoder, with_end
from skylattice.llm._shared import documents, new_folder

END_ID = 2
SCHEMA = "doc_id long, part int, place long, n_tokens int, ids array<int>"
OPTIONS = {
    "compression": "zstd",
    "orc.stripe.size": str(64 << 20),
    "orc.row.index.stride": "10000",
    "orc.create.index": "true",
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
}


def _encode(path: str, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, place = encoder(path, True).encode, TaskContext.get().partitionId(), 0
        for batch in batches:
            for rows in _text.slices(batch, limit=SLICE_BYTES):
                ids, offsets = with_end(*encode(*_text.buffer(rows["text"])), end)
                n = rows.num_rows
                lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays(
                    [rows["doc_id"], pa.array(np.full(n, part, np.int32)), pa.array(np.arange(place, place + n)), pa.array(np.diff(offsets).astype(np.int32)), lists],
                    ["doc_id", "part", "place", "n_tokens", "ids"],
                )
                place += n

    return run


def write(docs: DataFrame, folder: str, tokenizer: str, end: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> str:
    """Encodes the texts and writes the store to `folder`; its one shuffle deals the documents by id ranges."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id").mapInArrow(_encode(tokenizer, end), SCHEMA).write.options(**OPTIONS).orc(folder)
    return folder


def read(spark: SparkSession, folder: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """The store's rows, of the ids from `first` to `last`: other stripes and row groups are skipped by their metadata."""
    rows = spark.read.schema(SCHEMA).orc(folder)
    if first is not None:
        rows = rows.where(F.col("doc_id") >= first)
    return rows if last is None else rows.where(F.col("doc_id") <= last)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch["ids"]
        offsets = ids.offsets.to_numpy()
        raw = memoryview(np.ascontiguousarray(ids.values.to_numpy().astype("<u4"))).cast("B")
        crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], batch["part"], batch["place"], batch["n_tokens"].cast(pa.int64()), pa.array(crc, pa.int64())], ["doc_id", "part", "place", "n_tokens", "ids_crc32"]
        )


def digests(rows: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of a store's rows. The running sum works within files; files add their sums."""
    each = rows.mapInArrow(_digest, "doc_id long, part int, place long, n_tokens long, ids_crc32 long")
    files = rows.groupBy("part").agg(F.sum("n_tokens").alias("size"))
    before = files.select("part", (F.sum("size").over(Window.orderBy("part")) - F.col("size")).alias("before"))
    inside = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("place")) - F.col("n_tokens")
    return each.withColumn("inside", inside).join(before, "part").select("doc_id", (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = write(documents(spark, sf_dir), new_folder(spark, "tokens"), public_tokenizers.path("byte_bpe_50k.json"))
    return digests(read(spark, folder))
