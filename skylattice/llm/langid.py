"""Language identification by segmentation-marginalised unigrams over a fixed public vocabulary.

`fit` counts the vocabulary's pieces in each language over all training texts; `predict` sums, for every word and
language, the probabilities of all segmentations of the word into pieces by a forward algorithm, and a text's score is
the sum of its words' logarithms. Pieces do not cross words, so each distinct word of a slice is worked out once, all of
them at the same time, and sums are scaled on the way. A word of more than WHOLE code points is a chain of stretches: each
stretch is a matrix from the forward sums before it to those after it, so that no segmentation is left out.

The model is languages x pieces numbers. Its size is bounded by `max_languages`: of more labels than that, the ones with the
most training documents are learnt, by name where equal, and the others are never predicted.

Defined results: `und` with score 0 for a null text, a text without a letter, or a model without languages; training rows
with a null text or language are left out; languages that tie give the first by name; a null doc_id counts as held out;
repeated rows and rows that share a doc_id repeat their results; a text of any length is read whole; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skylattice.llm import _text
from skylattice.llm._shared import cut, documents

UNDETERMINED = "und"
#: Code points of a word that is worked out in one go, of the stretches of a longer one, and between two scalings.
WHOLE = 64
STRETCH = 16
SCALED = 8
_PLACE_BITS = 18
SMOOTHING = 0.1
#: A text whose best language is not more probable than all others together has none.
LEAST_SCORE = 0.5
_MARK = "▁"

#: Bytes of text whose words are gathered at once.
_SLICE = 6 << 20


def _processor(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def _unique_words(rows: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Each word's document and number, and the distinct words (A-Z folded)."""
    data, offsets = _text.buffer(rows["text"])
    data = _text.LOWER[data]
    doc, starts, ends = _text.words(data, offsets)
    first, number = _text.distinct(data, starts, ends)
    raw = data.tobytes()
    return doc, number, [raw[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)]


def _count(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp = _text.held(("pieces", path), lambda: _processor(path))
        n_pieces = sp.get_piece_size()
        totals: dict[str, np.ndarray] = {}  # the last place counts documents
        for batch in batches:
            for rows in _text.slices(batch, limit=_SLICE):
                langs = rows["lang"].to_pylist()
                names = sorted(set(langs))
                of = np.array([names.index(x) for x in langs])
                doc, number, words = _unique_words(rows)
                pieces = sp.encode([w.decode() for w in words], num_threads=1)
                lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
                flat = np.fromiter(chain.from_iterable(pieces), np.int32, int(lengths.sum()))
                owner = np.repeat(np.arange(len(pieces)), lengths)
                for k, name in enumerate(names):
                    times = np.bincount(number[of[doc] == k], minlength=len(words))
                    total = totals.setdefault(name, np.zeros(n_pieces + 1, np.int64))
                    total[:-1] += np.bincount(flat, weights=times[owner], minlength=n_pieces).astype(np.int64)
                    total[-1] += int((of == k).sum())
        for name, total in totals.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at)), pa.array(at.astype(np.int32)), pa.array(total[at])], ["lang", "piece", "n"])

    return run


@dataclass
class Model:
    languages: list[str]
    vocabulary: str
    #: (pieces + 1) x languages probabilities; the last row is that of a character which is no piece.
    pieces: np.ndarray
    #: logarithms of the languages' shares of the training documents
    prior: np.ndarray
    key: str


def fit(docs: DataFrame, vocabulary: str, text_col: str = "text", lang_col: str = "lang", max_languages: int = 200) -> Model:
    """Piece counts of all rows with a text and a language: one pass, and one row per task, language and piece."""
    rows = docs.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).where("text IS NOT NULL AND lang IS NOT NULL")
    counts = cut(rows.mapInArrow(_count(vocabulary), "lang string, piece int, n long").groupBy("lang", "piece").agg(F.sum("n").alias("n")))
    n_pieces = _processor(vocabulary).get_piece_size()
    most = counts.where(F.col("piece") == n_pieces).orderBy(F.desc("n"), "lang").limit(max_languages)
    languages = sorted(r.lang for r in most.select("lang").collect())
    table = np.zeros((n_pieces + 1, len(languages)))
    if languages:
        found = counts.where(F.col("lang").isin(languages)).toArrow()  # at most max_languages * (n_pieces + 1) rows
        where = {name: k for k, name in enumerate(languages)}
        table[found["piece"].to_numpy(), [where[x] for x in found["lang"].to_pylist()]] = found["n"].to_numpy()
    prior = np.log(table[-1])
    table[-1] = 0
    table += SMOOTHING
    return Model(languages, vocabulary, table / table.sum(axis=0), prior, uuid.uuid4().hex)


def _extended(h: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Hashes of strings with one more code point before them."""
    return _text.mix(h * np.uint64(0x9E3779B97F4A7C15) + code + np.uint64(1))


class _Forward:
    """Sums over segmentations, for many words at once."""

    def __init__(self, model: Model) -> None:
        sp = _processor(model.vocabulary)
        names = [(k, sp.id_to_piece(k)) for k in range(sp.get_piece_size()) if not (sp.is_byte(k) or sp.is_control(k) or sp.is_unknown(k))]
        lengths = np.array([len(x) for _, x in names])
        self.longest = int(lengths.max())
        flat, ends = self._codes([x for _, x in names]), np.cumsum(lengths)
        keys = np.zeros(len(names), np.uint64)
        for n in range(1, self.longest + 1):
            has = np.flatnonzero(lengths >= n)
            keys[has] = _extended(keys[has], flat[ends[has] - n])
        order = np.argsort(keys)
        self.keys, self.ids = keys[order], np.array([k for k, _ in names])[order]
        # where the keys with the same highest bits begin; most hashes of other strings meet an empty place there
        places = (self.keys >> np.uint64(64 - _PLACE_BITS)).astype(np.int64)
        self.first = np.searchsorted(places, np.arange((1 << _PLACE_BITS) + 1)).astype(np.int32)
        self.deepest = int(np.diff(self.first).max(initial=0))
        self.p, self.unknown = model.pieces, len(model.pieces) - 1

    @staticmethod
    def _codes(strings: list[str]) -> np.ndarray:
        return np.frombuffer("".join(strings).encode("utf-32-le"), np.uint32).astype(np.uint64)

    def _arcs(self, flat: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pieces that end at a code point and begin at most `before` before it: last code point, length, piece.

        A code point that is no piece counts as an unknown one, so that something always ends everywhere.
        """
        h, found = np.zeros(len(flat), np.uint64), []
        for n in range(1, min(self.longest, len(flat)) + 1):
            h[n - 1 :] = _extended(h[n - 1 :], flat[: len(flat) - n + 1])
            last = np.flatnonzero(before >= n - 1)
            asked = h[last]
            place = (asked >> np.uint64(64 - _PLACE_BITS)).astype(np.int64)
            at, size = self.first[place], self.first[place + 1] - self.first[place]
            piece = np.full(len(last), -1)
            for k in range(self.deepest):
                some = np.flatnonzero(size > k)
                some = some[self.keys[at[some] + k] == asked[some]]
                piece[some] = self.ids[at[some] + k]
            if n == 1:
                piece[piece < 0] = self.unknown
            hit = piece >= 0
            found.append((last[hit], np.full(int(hit.sum()), n), piece[hit]))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))

    def _short(self, shown: list[str]) -> np.ndarray:
        """Log-likelihoods of words of at most WHOLE code points."""
        flat, lengths = self._codes(shown), np.fromiter(map(len, shown), np.int64, len(shown))
        ends, word = np.cumsum(lengths), np.repeat(np.arange(len(shown)), lengths)
        place = np.arange(len(flat)) - np.repeat(ends - lengths, lengths)
        last, n, piece = self._arcs(flat, place)
        order = np.lexsort((n, place[last]))
        last, n, piece = last[order], n[order], piece[order]
        to = place[last]
        group = np.flatnonzero(np.diff(to * (self.longest + 1) + n, prepend=-1))
        forward = np.zeros((len(flat), self.p.shape[1]))
        begin, log = np.ones((len(shown), self.p.shape[1])), np.zeros((len(shown), self.p.shape[1]))
        for a, b in zip(group.tolist(), [*group[1:].tolist(), len(to)], strict=True):
            end, p, t = last[a:b], self.p[piece[a:b]], int(to[a])
            forward[end] += p * (begin[word[end]] if n[a] == t + 1 else forward[end - n[a]])
            if t % SCALED == SCALED - 1 and (b == len(to) or to[b] != t):
                done = np.flatnonzero(place == t)
                reach = done[:, None] - np.arange(min(self.longest, t + 1))
                scale = forward[reach].max(axis=1)
                forward[reach] /= scale[:, None]
                begin[word[done]] /= scale
                log[word[done]] += np.log(scale)
        return np.log(forward[ends - 1]) + log

    def _long(self, shown: str) -> np.ndarray:
        """Log-likelihoods of one word of any length."""
        flat, reach, langs = self._codes([shown]), self.longest, self.p.shape[1]
        sums, log = np.zeros((reach, langs)), np.zeros(langs)  # forward sums of the last `reach` places, the latest one last
        sums[-1] = 1
        step = max(1, (1 << 21) // ((STRETCH + reach) * reach * langs)) * STRETCH
        for at in range(0, len(flat), step):
            to, low = min(at + step, len(flat)), max(at - reach + 1, 0)
            last, n, piece = self._arcs(flat[low:to], np.arange(to - low) + min(low, 1) * reach)
            inside = last >= at - low
            last, n, piece = last[inside] + low - at, n[inside], piece[inside]
            inside = last + 1 - n + at >= 0
            last, n, piece = last[inside], n[inside], piece[inside]
            rows = -(-(to - at) // STRETCH)
            each = np.zeros((rows, reach + STRETCH, reach, langs))
            each[:, np.arange(reach), np.arange(reach)] = 1
            place = last % STRETCH
            order = np.lexsort((n, place))
            last, n, piece, place = last[order], n[order], piece[order], place[order]
            group = np.flatnonzero(np.diff(place * (reach + 1) + n, prepend=-1)).tolist()
            for a, b in zip(group, [*group[1:], len(n)], strict=True):
                row, t = last[a:b] // STRETCH, int(place[a])
                each[row, reach + t] += each[row, reach + t - n[a]] * self.p[piece[a:b]][:, None, :]
            for k in range(rows):
                size = min(STRETCH, to - at - k * STRETCH)
                sums = np.einsum("ijl,jl->il", each[k, size : size + reach], sums)
                scale = sums.max(axis=0)
                sums, log = sums / scale, log + np.log(scale)
        return np.log(sums[-1]) + log

    def words(self, words: list[bytes]) -> np.ndarray:
        """Log-likelihoods, words x languages, and in a last column whether the word has a letter."""
        shown = [_MARK + w.decode() for w in words]
        out = np.zeros((len(shown), self.p.shape[1] + 1))
        short = np.array([len(w) <= WHOLE for w in shown])
        if short.any():
            out[short, :-1] = self._short([w for w in shown if len(w) <= WHOLE])
        for k in np.flatnonzero(~short).tolist():
            out[k, :-1] = self._long(shown[k])
        out[:, -1] = [any(map(str.isalpha, w)) for w in shown]
        return out

    def scores(self, words: list[bytes]) -> np.ndarray:
        return np.concatenate([self.words(words[k : k + 16384]) for k in range(0, len(words), 16384)])


def _labels(model: Model, rows: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each row: whether its language is told, the language's number, and the score."""
    forward, n_lang, n = _text.held(("forward", model.key), lambda: _Forward(model)), len(model.languages), rows.num_rows
    doc, number, words = _unique_words(rows)
    known, score, best = np.zeros(n, bool), np.zeros(n), np.zeros(n, np.int64)
    if words and n_lang:
        each = forward.scores(words)
        total = np.stack([np.bincount(doc, weights=each[number, k], minlength=n) for k in range(n_lang)], 1) + model.prior
        known = np.bincount(doc, weights=each[number, -1], minlength=n) > 0
        best = total.argmax(1)
        score = np.where(known, 1 / np.exp(total - total.max(1, keepdims=True)).sum(1), 0.0)
    return known, best, score


def _predict(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for rows in _text.slices(batch, limit=_SLICE):
                known, best, score = _labels(model, rows)
                names = [model.languages[k] if ok else UNDETERMINED for k, ok in zip(best.tolist(), known.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([rows["doc_id"], rows["held_out"], pa.array(names, pa.string()), pa.array(score)], ["doc_id", "held_out", "lang_pred", "score"])

    return run


def _keep(shared, least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for rows in _text.slices(batch, limit=_SLICE):
                known, best, score = _labels(model, rows)
                keep = known & (score >= least)
                names = pa.array([model.languages[k] if ok else None for k, ok in zip(best.tolist(), keep.tolist(), strict=True)], pa.string())
                at = rows.schema.get_field_index("lang")
                told = pc.coalesce(rows["lang"].cast(pa.string()), names)
                yield rows.set_column(at, "lang", told).filter(pa.array(keep))

    return run


def held_out(id_col: Column, parts: int, part: int) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string")) % parts == part, F.lit(True))


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row. One pass, no shuffle."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(F.col(id_col), 5, 0).alias("held_out"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_predict(docs.sparkSession.sparkContext.broadcast(model)), "doc_id long, held_out boolean, lang_pred string, score double")


def recognised(docs: DataFrame, model: Model, least: float = LEAST_SCORE) -> DataFrame:
    """The rows of `docs` (text, a string column lang and more) whose language is told with a score of `least` or more.

    The language that was told is handed on in `lang` where that is null; the texts stay where they are. A model without
    languages can reject nothing but texts without a letter.
    """
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    return docs.mapInArrow(_keep(docs.sparkSession.sparkContext.broadcast(model), least), docs.schema)


def training_rows(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return docs.where(~held_out(F.col(id_col), 5, 0))


def default_vocabulary() -> str:
    return public_tokenizers.path("piece_bpe_32k.model")


def train_and_predict(docs: DataFrame) -> DataFrame:
    return predict(docs, fit(training_rows(docs), default_vocabulary()))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return train_and_predict(documents(spark, sf_dir))
