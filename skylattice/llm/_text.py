"""Vectorised reading of Arrow text columns: words, chunks and lines as spans of the UTF-8 bytes.

A word is `[^\\x20\\x09-\\x0D]+`; whitespace is ASCII, so a span never splits a code point. Where spans begin and end
depends on the bytes around them alone, so it does not matter how a column is cut into slices. A span's 64-bit hash chains a
bijective mixer over its blocks of eight bytes, that of a long one is a cryptographic digest; where one span stands for
others, `distinct` compares the bytes as well.
"""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once; a longer document is a slice of its own.
SLICE_BYTES = 2 << 20
#: Bytes looked at in one step of finding spans; decides memory alone.
_WINDOW = 1 << 20
#: Spans of more bytes are hashed and compared one by one.
_LONG = 64

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
_BYTES = np.arange(256)
_LETTER = ((_BYTES >= 65) & (_BYTES <= 90)) | ((_BYTES >= 97) & (_BYTES <= 122))
_MARK = (_BYTES >= 33) & (_BYTES <= 126) & ~_LETTER & ~((_BYTES >= 48) & (_BYTES <= 57))


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser on uint64."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


#: glibc's call that hands freed memory back to the system; None with other libraries.
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """A worker lives on beside the executor's other work, so it doesn't hold what a batch no longer needs."""
    pa.default_memory_pool().release_unused()
    if _TRIM:
        _TRIM(0)


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive rows holding about `limit` bytes of text, at least one row each."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield batch.slice(at, to - at)
        at = to
    give_back()


def buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the n + 1 offsets of its rows; a null row is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(column) + 1, 8 * column.offset) if offsets else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def _blocks(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one number, zeros after the end."""
    return np.ndarray(len(data) + 1, "<u8", np.concatenate([data, np.zeros(8, np.uint8)]), strides=(1,))


_KEPT = np.array([(1 << 8 * k) - 1 for k in range(8)] + [(1 << 64) - 1], np.uint64)
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of spans, which depend on their bytes alone."""
    n, blocks = ends - starts, _blocks(data)
    h = mix((blocks[starts] & _KEPT[np.minimum(n, 8)]) + n.astype(np.uint64) * _FACTOR)
    at, more = 8, np.flatnonzero((n > 8) & (n <= _LONG))
    while len(more):
        h[more] = mix(h[more] * _FACTOR + (blocks[starts[more] + at] & _KEPT[np.minimum(n[more] - at, 8)]))
        at += 8
        more = more[n[more] > at]
    for k in np.flatnonzero(n > _LONG).tolist():
        h[k] = int.from_bytes(hashlib.blake2b(data[starts[k] : ends[k]], digest_size=8).digest(), "little")
    return h


def equal(a: np.ndarray, at_a: np.ndarray, n: np.ndarray, b: np.ndarray, at_b: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Whether the n bytes of a from at_a on are the n_b bytes of b from at_b on, of each pair of places."""
    blocks_a, blocks_b, same = _blocks(a), _blocks(b), n == n_b
    more, at = np.flatnonzero(same & ((at_a != at_b) | (a is not b))), 0
    while len(more):
        short = n[more] <= _LONG
        for k in more[~short].tolist():
            same[k] = np.array_equal(a[at_a[k] : at_a[k] + n[k]], b[at_b[k] : at_b[k] + n[k]])
        more = more[short]
        differ = (blocks_a[at_a[more] + at] ^ blocks_b[at_b[more] + at]) & _KEPT[np.minimum(n[more] - at, 8)] != 0
        same[more[differ]] = False
        at += 8
        more = more[~differ & (n[more] > at)]
    return same


def distinct(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first of each group of spans with the same bytes, and each span's group. Hashes group them, bytes confirm it."""
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    _, first, group = np.unique(hashes(data, starts, ends), return_index=True, return_inverse=True)
    same = equal(data, starts, ends - starts, data, starts[first[group]], (ends - starts)[first[group]])
    if not same.all():
        seen: dict[bytes, int] = {}
        raw = data.tobytes()
        group = np.array([seen.setdefault(raw[a:b], len(seen)) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)])
        first = np.unique(group, return_index=True)[1]
    return first, group


def _edges(offsets: np.ndarray, at: int, to: int) -> np.ndarray:
    """Of the places at .. to, which begin or end a document."""
    edge = np.zeros(to - at + 1, bool)
    edge[offsets[np.searchsorted(offsets, at, "left") : np.searchsorted(offsets, to, "right")] - at] = True
    return edge


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each word: its document's index, first byte and end."""
    n, starts, ends = len(data), [], []
    for at in range(0, n, _WINDOW):
        to = min(at + _WINDOW, n)
        # solid[k] is of the byte at + k - 1; before the first and after the last byte there is none
        solid = np.zeros(to - at + 2, bool)
        low, high = max(at - 1, 0), min(to + 1, n)
        solid[low - at + 1 : high - at + 1] = ~IS_SPACE[data[low:high]]
        edge = _edges(offsets, at, to)
        starts.append(np.flatnonzero(solid[1:-1] & (~solid[:-2] | edge[:-1])) + at)
        ends.append(np.flatnonzero(solid[1:-1] & (~solid[2:] | edge[1:])) + at + 1)
    starts, ends = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (starts, ends))
    return np.searchsorted(offsets, starts, "right") - 1, starts, ends


def folded(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case, but where a byte follows that may begin a mark which joins the letter."""
    out = LOWER[data]
    stay = np.flatnonzero(data[1:] >= 0x80)
    out[stay] = data[stay]
    return out


def runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As words(), with further cuts between an ASCII letter and an ASCII mark, but none after an apostrophe."""
    doc, starts, ends = words(data, offsets)
    start, end = np.zeros(len(data) + 1, bool), np.zeros(len(data) + 1, bool)
    start[starts], end[ends] = True, True
    for at in range(1, len(data), _WINDOW):
        part = data[at - 1 : at + _WINDOW]
        letter, mark = _LETTER[part], _MARK[part]
        stop = (letter[:-1] & mark[1:]) | (mark[:-1] & letter[1:] & (part[:-1] != ord("'")))
        start[at : at + _WINDOW][: len(stop)] |= stop
        end[at : at + _WINDOW][: len(stop)] |= stop
    starts, ends = np.flatnonzero(start), np.flatnonzero(end)
    return np.searchsorted(offsets, starts, "right") - 1, starts, ends


def chunks(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As words(), but each with the whitespace before it, and a document's trailing whitespace as one more.

    There is a further cut between an ASCII letter and an ASCII mark. No cut follows a byte that may end a Unicode space,
    so that runs of mixed whitespace stay together.
    """
    n, found = len(data), [np.zeros(0, np.int64)]
    for at in range(0, n, _WINDOW):
        to = min(at + _WINDOW, n)
        low = max(at - 2, 0)
        part = data[low:to]
        gap = IS_SPACE[part]
        odd = (part >= 0x80) & (part <= 0xAF)
        odd[1:] &= np.isin(part[:-1], (0xC2, 0x80, 0x81, 0x9A))
        odd |= (part >= 0x1C) & (part <= 0x1F)
        stop = np.zeros(len(part), bool)
        stop[1:] = (gap[1:] & ~gap[:-1] & ~odd[:-1]) | (_MARK[part[1:]] & _LETTER[part[:-1]])
        found.append(np.flatnonzero(stop[at - low :] | _edges(offsets, at, to)[:-1]) + at)
    starts = np.concatenate(found)
    return np.searchsorted(offsets, starts, "right") - 1, starts, np.append(starts[1:], n)[: len(starts)]


def per_document(doc: np.ndarray, n: int, weights: np.ndarray | None = None) -> np.ndarray:
    return np.bincount(doc, weights=weights, minlength=n).astype(np.int64)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices starts[i] .. starts[i] + lengths[i] - 1 of all i, one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)


_held: dict = {}


def held(key: object, make: Callable[[], object]) -> object:
    """What a worker process keeps from task to task: one thing, so that stages of other kinds leave nothing behind."""
    if key not in _held:
        _held.clear()
        _held[key] = make()
    return _held[key]


class Memo:
    """A dictionary of bounded size: two generations of at most `limit` entries, the older one dropped whole."""

    def __init__(self, limit: int) -> None:
        self.limit, self.new, self.old = limit, {}, {}

    def get(self, key):
        return self.many([key])[0]

    def many(self, keys: list) -> list:
        """The values of all keys, None for those that are not there."""
        values = list(map(self.new.get, keys))
        if self.old:
            for k in [k for k, v in enumerate(values) if v is None]:
                if (value := self.old.get(keys[k])) is not None:
                    values[k] = value
                    self.put(keys[k], value)
        return values

    def put(self, key, value) -> None:
        if len(self.new) >= self.limit:
            self.old, self.new = self.new, {}
        self.new[key] = value
