"""Whole-text encoding with the tokenizers library, a chunk of text at a time.

Both kinds of vocabulary used here split text before merging and no pre-token goes on past a whitespace that follows a
non-whitespace, or from a letter to a mark, so a text's ids are the ids of its chunks in order. Chunks repeat: each distinct
chunk of a slice is encoded once, or found among those of earlier slices, whose bytes are compared. Many chunks go to the library as one string, with a special token between them, at which it
splits before it does anything else. A special token written out in a text is one id, as the library has it by default; a text
that holds one goes to the library whole and alone.

A vocabulary with the normalizer and pre-tokenizer of FOLDED lower-cases, and splits between letters and marks as well. Its
chunks are folded and cut there, so that fewer differ, and those of letters alone need no special token between them: each
is one pre-token, whose last id is one of a word's end. A string that has not as many ends as chunks is encoded in the other way.
"""

from __future__ import annotations

import json
import os

import numpy as np

from skylattice.llm import _text

#: Bytes of text whose chunks are gathered at once, and chunks that make one string for the library.
SLICE_BYTES = 8 << 20
_JOINED = 256
#: Chunks that a worker process remembers at most, and the longest of them.
_REMEMBERED = 500_000
_LONGEST = 64
#: Normalizers and pre-tokenizers by whose rules chunks may be folded and cut at marks.
FOLDED = (
    [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}],
    [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
)


def _last_ids(tokenizer) -> np.ndarray | None:
    """Of each id whether it ends a word, if the vocabulary is one of FOLDED whose words all have such an end; otherwise None."""
    from tokenizers.pre_tokenizers import ByteLevel

    rules = json.loads(tokenizer.to_str())
    model, split = rules["model"], tuple((rules[k] or {}).get(f"{k.replace('_', '')}s") for k in ("normalizer", "pre_tokenizer"))
    end, vocabulary = model.get("end_of_word_suffix"), model["vocab"]
    if split != FOLDED or not end or any(model.get(k) for k in ("dropout", "continuing_subword_prefix")):
        return None
    if any(c + e not in vocabulary for c in ByteLevel.alphabet() for e in ("", end)):
        return None
    last = np.zeros(tokenizer.get_vocab_size(), bool)
    last[[k for token, k in vocabulary.items() if token.endswith(end)]] = True
    return last


class _Known:
    """Chunks by hash, with their bytes and ids, in a few arrays."""

    def __init__(self) -> None:
        self.hashes, self.data, self.ids = np.zeros(0, np.uint64), np.zeros(0, np.uint8), np.zeros(0, np.int32)
        self.at, self.n, self.ids_at, self.ids_n = (np.zeros(0, np.int64) for _ in range(4))

    def find(self, h: np.ndarray, data: np.ndarray, starts: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The number of each chunk, -1 of those that are not there."""
        if not len(self.hashes):
            return np.full(len(h), -1)
        k = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        some = np.flatnonzero(self.hashes[k] == h)
        some = some[_text.equal(data, starts[some], n[some], self.data, self.at[k[some]], self.n[k[some]])]
        out = np.full(len(h), -1)
        out[some] = k[some]
        return out

    def add(self, h: np.ndarray, raw: list[bytes], ids: np.ndarray, ids_n: np.ndarray) -> None:
        """More chunks, their ids one after the other. When there are too many, the earlier ones go."""
        if len(self.hashes) + len(h) > _REMEMBERED:
            self.__init__()
        n = np.fromiter(map(len, raw), np.int64, len(raw))
        at, ids_at = len(self.data) + np.cumsum(n) - n, len(self.ids) + np.cumsum(ids_n) - ids_n
        self.data, self.ids = np.concatenate([self.data, np.frombuffer(b"".join(raw), np.uint8)]), np.concatenate([self.ids, ids])
        order = np.argsort(hashes := np.concatenate([self.hashes, h]), kind="stable")
        self.hashes = hashes[order]
        self.at, self.n, self.ids_at, self.ids_n = (np.concatenate(x)[order] for x in ((self.at, at), (self.n, n), (self.ids_at, ids_at), (self.ids_n, ids_n)))


class ChunkEncoder:
    def __init__(self, path: str, spaces: bool) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = {k: t.content.encode() for k, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.special = list(added.values())
        self.mark = next(((k, t) for k, t in added.items() if self._ids(["a" + t.decode() + "b"])[0] == [*self._ids(["a"])[0], k, *self._ids(["b"])[0]]), None)
        self.last = None if spaces else _last_ids(self.tokenizer)
        self.find = _text.chunks if spaces else _text.words if self.last is None else _text.runs
        self.known = _Known()

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _each(self, keys: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of all strings, and where each one's begin and how many they are."""
        ids, lengths, at, left = [np.zeros(0, np.int32)], np.zeros(len(keys), np.int64), [], range(len(keys))
        if self.last is not None and keys:
            # a text that holds a special token may hold line ends, then all go the other way
            texts = b"\n".join(keys).decode().split("\n")
            alpha = list(map(str.isalpha, texts)) if len(texts) == len(keys) else []
            letters, left = [k for k, x in enumerate(alpha) if x], [k for k, x in enumerate(alpha) if not x] if alpha else left
            groups = [letters[a : a + _JOINED] for a in range(0, len(letters), _JOINED)]
            for group, found in zip(groups, self._ids([b" ".join([keys[k] for k in group]).decode() for group in groups]), strict=True):
                flat = np.array(found, np.int32)
                ends = np.flatnonzero(self.last[flat])
                if len(ends) == len(group):
                    lengths[group] = np.diff(ends, prepend=-1)
                    ids.append(flat)
                    at += group
                else:
                    left += group
        least = min(map(len, self.special), default=0)
        odd = [k for k in left if self.mark is None or len(keys[k]) >= least and any(t in keys[k] for t in self.special)]
        plain = sorted(set(left) - set(odd)) if odd else list(left)
        if self.mark is not None:
            k, mark = self.mark
            joined = [mark.join([keys[x] for x in plain[a : a + _JOINED]] + [b""]).decode() for a in range(0, len(plain), _JOINED)]
            if joined:
                flat = np.concatenate([np.array(x, np.int32) for x in self._ids(joined)])
                ends = np.flatnonzero(flat == k)
                lengths[plain] = np.diff(ends, prepend=-1) - 1
                ids.append(flat[flat != k])
        for k in odd:
            ids.append(np.array(self._ids([keys[k].decode()])[0], np.int32))
            lengths[k] = len(ids[-1])
        at += [*plain, *odd]
        starts = np.zeros(len(keys), np.int64)
        starts[at] = np.cumsum(lengths[at]) - lengths[at]
        return np.concatenate(ids), starts, lengths

    def _spans(self, data: np.ndarray, offsets: np.ndarray, raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Document, first byte and end of what is encoded by itself: chunks, or all of a text that holds a special token's string."""
        doc, starts, ends = self.find(data, offsets)
        places = []
        for token in self.special:
            at = raw.find(token)
            while at >= 0:
                places.append(at)
                at = raw.find(token, at + 1)
        if not places:
            return doc, starts, ends
        whole = np.unique(np.searchsorted(offsets, places, "right") - 1)
        rest = ~np.isin(doc, whole)
        starts, ends = np.concatenate([starts[rest], offsets[whole]]), np.concatenate([ends[rest], offsets[whole + 1]])
        order = np.argsort(starts, kind="stable")
        return np.concatenate([doc[rest], whole])[order], starts[order], ends[order]

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids (int32) of all documents, one after the other, and how many each document has."""
        n, raw = len(offsets) - 1, data.tobytes()
        if self.last is not None:
            folded = _text.folded(data)
            other = folded.tobytes()
            if all(raw.count(t) == other.count(t) for t in self.special):  # otherwise folding would write a special token
                data, raw = folded, other
        doc, starts, ends = self._spans(data, offsets, raw)
        if not len(doc):
            return np.zeros(0, np.int32), np.zeros(n, np.int64)
        first, inverse = _text.distinct(data, starts, ends)
        starts, ends = starts[first], ends[first]
        h, known = _text.hashes(data, starts, ends), self.known
        found = known.find(h, data, starts, ends - starts)
        new = np.flatnonzero(found < 0)
        keys = [raw[a:b] for a, b in zip(starts[new].tolist(), ends[new].tolist(), strict=True)]
        ids, ids_at, ids_n = self._each(keys)
        at, lengths = known.ids_at[found] if len(known.hashes) else np.zeros(len(h), np.int64), known.ids_n[found] if len(known.hashes) else np.zeros(len(h), np.int64)
        at[new], lengths[new] = len(known.ids) + ids_at, ids_n
        flat = np.concatenate([known.ids, ids])
        short = np.flatnonzero((ends - starts)[new] <= _LONGEST)
        if len(short) <= _REMEMBERED:
            known.add(h[new[short]], [keys[k] for k in short.tolist()], ids[_text.ragged(ids_at[short], ids_n[short])], ids_n[short])
        each = lengths[inverse]
        return flat[_text.ragged(at[inverse], each)], _text.per_document(doc, n, each)


def encoder(path: str, spaces: bool) -> ChunkEncoder:
    """One for each worker process; spaces: whether whitespace is part of the tokens."""
    return _text.held(("encoder", path, spaces), lambda: ChunkEncoder(path, spaces))


def with_end(ids: np.ndarray, counts: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The same with the id `end` after each document, and the n + 1 offsets of the documents."""
    out = np.full(len(ids) + len(counts), end, np.int32)
    offsets = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(counts + 1, out=offsets[1:])
    keep = np.ones(len(out), bool)
    keep[offsets[1:] - 1] = False
    out[keep] = ids
    return out, offsets
