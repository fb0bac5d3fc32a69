"""Language-model scores by a weighted backoff automaton over the corpus's own n-grams.

States are the pairs of tokens, the tokens and the empty history that the training rows have. A state's arcs are the tokens
seen after it; a token that has no arc takes the failure arc, whose weight stands for the state's unseen tokens, to the state
without the first token. Counts are smoothed by Dirichlet priors, so that a state's probabilities add up to one:

    p(w | u v) = (n(u v w) + B * p(w | v)) / (n(u v) + B),   failure weight B / (n(u v) + B)

and the root's arcs are all tokens, add-one smoothed. A text is read from left to right; the state after a token is the
longest history that the automaton has, so all places of a text can follow their arcs at the same time.

All n-grams of all training rows count, whatever the size of the corpus, and nothing that grows with it is broadcast or
collected. Texts are read once and written as blocks of token numbers, which are read again from there. Every block sends its different n-grams with its own
counts, sorted and packed by hash range, to the task that adds that range up; back come only the totals that differ from the
block's own count. A frequent n-gram has one entry in each block at most, so no task meets a hot key. Each block is then
scored by itself with the arcs that it needs.

Tokens and n-grams are told apart by 64-bit hashes of their bytes.

Defined results: a null or empty text is the end token alone; a null doc_id counts as held out; rows are scored each on
its own, repeated rows and rows that share a doc_id have a result each; a text of any length is read whole; without training
rows every token has the probability 1 / (0 + 1); an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skylattice.llm import _text
from skylattice.llm._shared import Scratch, cut, documents
from skylattice.llm.langid import held_out

#: The most tokens of an n-gram, unless a caller says otherwise.
ORDER = 2
#: B of the formula, by the number of tokens in the history.
PRIOR = (0.0, 300.0, 100.0)
#: Bytes of text in a block.
BLOCK_BYTES = 4 << 20
#: The hash of the end token; before a text's first token the history is the end.
END = np.uint64(0x5851F42D4C957F2D)
_FACTOR = np.uint64(0x9E3779B97F4A7C15)

_BLOCK = "block long, keys binary, ids binary, lengths binary, doc_ids array<long>, held array<boolean>"
_BLOCK_SCHEMA = pa.schema([("block", pa.int64()), ("keys", pa.binary()), ("ids", pa.binary()), ("lengths", pa.binary()), ("doc_ids", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_()))])
#: The n-grams of one order and range of a block.
_SENT = "block long, kind int, bucket int, keys binary, counts binary"
_SENT_SCHEMA = pa.schema([("block", pa.int64()), ("kind", pa.int32()), ("bucket", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])
#: What comes back for it: places in its range, and the totals there.
_BACK = "block long, kind int, bucket int, places binary, totals binary"
_BACK_SCHEMA = pa.schema([("block", pa.int64()), ("kind", pa.int32()), ("bucket", pa.int32()), ("places", pa.binary()), ("totals", pa.binary())])


def _packed(values: np.ndarray) -> bytes:
    """All first bytes of the numbers, then all second ones and so on: sorted and small numbers compress well that way."""
    return values.view(np.uint8).reshape(len(values), -1).T.tobytes()


def _unpacked(raw: bytes, kind: type) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def _tokens(rows: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all tokens, a document's end included, in order, and how many each document has."""
    data, offsets = _text.buffer(rows["text"])
    data = _text.LOWER[data]
    doc, starts, ends = _text.words(data, offsets)
    counts = _text.per_document(doc, rows.num_rows) + 1
    out = np.full(len(doc) + rows.num_rows, END)
    keep = np.ones(len(out), bool)
    keep[np.cumsum(counts) - 1] = False
    out[keep] = _text.hashes(data, starts, ends)
    return out, counts


def _grams(tokens: np.ndarray, lengths: np.ndarray, most: int) -> list[np.ndarray]:
    """For each order the hash of the n-gram that ends at each place; before a document's first token all is the end."""
    place = np.arange(len(tokens)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out, before = [tokens], tokens
    for order in range(2, most + 1):
        before = np.where(place >= order - 1, np.concatenate([np.full(order - 1, END), tokens])[: len(tokens)], END)
        out.append(_text.mix(out[-1] * _FACTOR + before + np.uint64(order)))
    return out


def _sorted(keys: np.ndarray, learn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different keys in order, their occurrences in training rows, and each one's place among them."""
    found, place = np.unique(keys, return_inverse=True)
    return found, np.bincount(place, weights=learn, minlength=len(found)).astype(np.uint32), place


def _ranges(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket's sorted keys begin, and the end."""
    edges = np.array([(k << 64) // buckets for k in range(1, buckets)], np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]])


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    block = TaskContext.get().partitionId() << 32
    for given in batches:
        for rows in _text.slices(given, limit=BLOCK_BYTES):
            tokens, lengths = _tokens(rows)
            keys, ids = np.unique(tokens, return_inverse=True)
            row = {"block": block, "keys": _packed(keys), "ids": _packed(ids.astype(np.int32)), "lengths": _packed(lengths), "doc_ids": rows["doc_id"].to_pylist(), "held": rows["held_out"].to_pylist()}
            yield pa.RecordBatch.from_pylist([row], _BLOCK_SCHEMA)
            block += 1


def _opened(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a block: its different tokens, all tokens, how many each document has, and which tokens are to be learnt."""
    keys, lengths = _unpacked(row["keys"], np.uint64), _unpacked(row["lengths"], np.int64)
    return keys, keys[_unpacked(row["ids"], np.int32)], lengths, np.repeat(~np.array(row["held"], bool), lengths)


def _send(buckets: int, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            _, tokens, lengths, learn = _opened(row)
            for order, keys in enumerate(_grams(tokens, lengths, most), 1):
                found, counts, _ = _sorted(keys, learn)
                at = _ranges(found, buckets).tolist()
                sent = [{"block": row["block"], "kind": order, "bucket": k, "keys": _packed(found[a:b]), "counts": _packed(counts[a:b])} for k, (a, b) in enumerate(zip(at[:-1], at[1:], strict=True)) if b > a]
                yield pa.RecordBatch.from_pylist(sent, _SENT_SCHEMA)

    return run


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield {name: batch.column(n)[k].as_py() for n, name in enumerate(batch.schema.names)}


def _groups(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[list[dict]]:
    """The rows with the same values of `names`, which follow each other."""
    held: list[dict] = []
    for row in _rows(batches):
        if held and any(held[0][x] != row[x] for x in names):
            yield held
            held = []
        held.append(row)
    if held:
        yield held


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of one range and order: for each block the totals that its own counts do not give, by their places in its range.

    A last row holds the sums of the range: how many different n-grams, and how many occurrences.
    """
    for rows in _groups(batches, "bucket", "kind"):
        where = {"kind": rows[0]["kind"], "bucket": rows[0]["bucket"]}
        counts = [_unpacked(r["counts"], np.uint32) for r in rows]
        _, place = np.unique(np.concatenate([_unpacked(r.pop("keys"), np.uint64) for r in rows]), return_inverse=True)
        total = np.bincount(place, weights=np.concatenate(counts)).astype(np.int64)
        at = 0
        for row, own in zip(rows, counts, strict=True):
            mine = total[place[at : at + len(own)]]
            at += len(own)
            differ = np.flatnonzero(mine != own)
            if len(differ):
                yield pa.RecordBatch.from_pylist([{"block": row["block"], **where, "places": _packed(differ.astype(np.int32)), "totals": _packed(mine[differ])}], _BACK_SCHEMA)
        sums = np.array([(total > 0).sum(), total.sum()], np.int64).tobytes()
        yield pa.RecordBatch.from_pylist([{"block": -1, **where, "places": b"", "totals": sums}], _BACK_SCHEMA)


class Automaton:
    """The states and arcs that one block of texts needs: for each order its sorted n-grams and their counts."""

    def __init__(self, counts: list[np.ndarray], train_tokens: int, vocabulary: int) -> None:
        self.counts, self.train_tokens, self.vocabulary = counts, train_tokens, vocabulary

    def root(self, token: np.ndarray) -> np.ndarray:
        return (self.counts[0][token] + 1) / (self.train_tokens + self.vocabulary + 1)

    def walk(self, grams: list[np.ndarray], history: list[np.ndarray]) -> np.ndarray:
        """log10 of each token's probability. grams: by order, the numbers of the n-grams that end at each place;
        history: by length, how often the history of that many tokens goes on in the training rows."""
        weight = [self.root(grams[0])]  # the arc's weight from the state of each history length, or a failure's and what follows
        for k in range(1, len(grams)):
            weight.append((self.counts[k][grams[k]] + PRIOR[k] * weight[-1]) / (history[k] + PRIOR[k]))
        out, state, waiting = np.zeros(len(grams[0])), len(grams) - 1, np.arange(len(grams[0]))
        while state and len(waiting):
            seen = self.counts[state][grams[state][waiting]] > 0
            arc, rest = waiting[seen], waiting[~seen]
            out[arc] += np.log10(weight[state][arc])
            out[rest] += np.log10(PRIOR[state] / (history[state][rest] + PRIOR[state]))  # a history never seen is no state: nothing is lost
            waiting, state = rest, state - 1
        out[waiting] += np.log10(weight[0][waiting])
        return out


def _score(buckets: int, most: int, train_tokens: int, vocabulary: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _groups(batches, "block"):
            head = rows[0]  # the block itself sorts first
            vocab, tokens, lengths, learn = _opened(head)
            held = np.array(head["held"], bool)
            keys, counts, grams = [], [], []
            for k in _grams(tokens, lengths, most):
                found, own, place = _sorted(k, learn)
                keys.append(_ranges(found, buckets)), counts.append(own.astype(np.int64)), grams.append(place)
            for row in rows[1:]:
                at = keys[row["kind"] - 1][row["bucket"]]
                counts[row["kind"] - 1][at + _unpacked(row["places"], np.int32)] = _unpacked(row["totals"], np.int64)
            first = np.cumsum(lengths) - lengths
            # a history's count is that of the n-gram that ends at the place before; the end's is that of all texts
            n_end = int(counts[0][np.searchsorted(vocab, END)])
            begins = np.zeros(len(tokens), bool)
            begins[first] = True
            history = [np.zeros(0), np.concatenate([[0], counts[0][grams[0]][:-1]])]
            history[1][begins] = n_end
            for k in range(2, most):
                # of a text's first tokens the history is ends alone, which every text has, or ends and its first tokens
                longer = np.concatenate([[0], counts[k - 1][grams[k - 1]][:-1]])
                longer[begins] = n_end
                history.append(longer)
            model = Automaton(counts, train_tokens, vocabulary)
            step, base = model.walk(grams, history), np.log10(model.root(grams[0]))
            doc, n = np.repeat(np.arange(len(lengths)), lengths), len(lengths)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(head["doc_ids"], pa.int64()),
                    pa.array(held),
                    pa.array(lengths),
                    pa.array(np.bincount(doc, weights=counts[0][grams[0]] > 0, minlength=n).astype(np.int64)),
                    pa.array(np.full(n, train_tokens, np.int64)),
                    pa.array(np.bincount(doc, weights=base, minlength=n)),
                    pa.array(np.bincount(doc, weights=step, minlength=n)),
                ],
                ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    return run


def train_and_score(docs: DataFrame, order: int = ORDER, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row, by the n-grams of the rows not held out.

    `order`: the most tokens of an n-gram, up to len(PRIOR).
    """
    spark = docs.sparkSession
    buckets = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(F.col(id_col), 7, 2).alias("held_out"), F.col(text_col).alias("text"))
    with Scratch(spark, "grams") as scratch:
        blocks = scratch.table(rows.mapInArrow(_read, _BLOCK))
        sent = blocks.mapInArrow(_send(buckets, order), _SENT)
        back = scratch.table(sent.repartition(buckets, "bucket").sortWithinPartitions("bucket", "kind").mapInArrow(_add_up, _BACK))
        sums = back.where("block < 0 AND kind = 1").select("totals").toArrow()["totals"].to_pylist()  # one row a bucket
        vocabulary, train_tokens = (int(x) for x in np.frombuffer(b"".join(sums), np.int64).reshape(-1, 2).sum(axis=0))
        parts = blocks.withColumn("kind", F.lit(0)).unionByName(back.where("block >= 0"), allowMissingColumns=True).repartition("block").sortWithinPartitions("block", "kind", "bucket")
        schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
        return cut(parts.mapInArrow(_score(buckets, order, train_tokens, vocabulary), schema))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return train_and_score(documents(spark, sf_dir))
