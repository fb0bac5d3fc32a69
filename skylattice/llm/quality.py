"""Quality rules as a ledger: every rule is evaluated once, its failure is a bit, policies are masks over the bits.

`ledger` reads each text once and keeps measurements and bits; `apply_policy` turns bits into a verdict by a versioned
mask, and `ablations` computes what each rule of a policy removes, alone and at all, from the bits by one aggregation.

Defined results: a null, empty or blank text has no words and no lines and fails `few_words`; rows are independent, so repeated
rows and rows that share a doc_id repeat their results, and a row with a null doc_id keeps it; a text of any length is measured
whole, words and lines are compared by their bytes; an empty table gives an empty ledger; columns other than the id and the
text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skylattice.llm import _text
from skylattice.llm._shared import documents

#: Rules in the order of their bits: SQL conditions over the measurements.
RULES = {
    "few_words": "n_words < 20",
    "repeated_passages": "100 * n_repeat_words > 30 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "duplicate_lines": "2 * n_dup_lines > n_lines",
    "word_length": "word_chars < 2 * n_words OR word_chars > 15 * n_words",
    "capitals": "n_words >= 20 AND 10 * n_capitals > 6 * n_letters",
}
#: Versions of the policy: the rules that reject. Ledgers stay valid when a version is added.
POLICIES = {
    "base": ("few_words", "repeated_passages"),
    "v1": tuple(RULES),
}
WINDOW = 8
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals", "n_letters")

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_BYTES = np.arange(256)
_UPPER = (_BYTES >= 65) & (_BYTES <= 90)
_LETTER = _UPPER | ((_BYTES >= 97) & (_BYTES <= 122))


def _sum(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def _pair_names(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Numbers for pairs of numbers: equal ones for equal pairs alone."""
    return np.unique(left * (int(right.max()) + 1) + right, return_inverse=True)[1]


def _repeated_words(doc: np.ndarray, name: np.ndarray, n: int) -> np.ndarray:
    """Words of each document that lie in a window of WINDOW words which the document has at least twice.

    A window's name is built from those of its halves, so that equal names stand for equal words.
    """
    if len(name) < WINDOW:
        return np.zeros(n, np.int64)
    half = 1
    while half < WINDOW:
        name = _pair_names(name[:-half], name[half:])
        half *= 2
    at = np.flatnonzero(doc[: len(name)] == doc[WINDOW - 1 :])
    if not len(at):
        return np.zeros(n, np.int64)
    _, own, times = np.unique(doc[at] * (int(name.max()) + 1) + name[at], return_inverse=True, return_counts=True)
    twice = at[times[own] > 1]
    begin = np.zeros(len(doc) + 1, np.int64)
    np.add.at(begin, twice, 1)
    np.add.at(begin, twice + WINDOW, -1)
    return _text.per_document(doc[np.cumsum(begin[:-1]) > 0], n)


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in _text.slices(batch):
            data, offsets = _text.buffer(part["text"])
            n, raw = part.num_rows, data.tobytes()
            doc, starts, ends = _text.words(data, offsets)
            _, word = _text.distinct(data, starts, ends)
            # bytes.strip() strips just [\x20\x09-\x0D]
            lines = [[x for x in raw[a:b].split(b"\n") if x.strip()] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            found = {
                "n_words": _text.per_document(doc, n),
                "word_chars": _sum(~_text.IS_SPACE[data] & ((data & 0xC0) != 0x80), offsets),
                "n_symbols": _sum(_SYMBOL[data], offsets),
                "n_dup_lines": np.array([len(x) - len(set(x)) for x in lines], np.int64),
                "n_repeat_words": _repeated_words(doc, word, n),
                "n_lines": np.array([len(x) for x in lines], np.int64),
                "n_capitals": _sum(_UPPER[data], offsets),
                "n_letters": _sum(_LETTER[data], offsets),
            }
            yield pa.RecordBatch.from_arrays([part["doc_id"], *(pa.array(found[k]) for k in MEASURES)], ["doc_id", *MEASURES])


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, the measurements and `failed`, whose bit k is set when the k-th of RULES fails. One pass, no shuffle."""
    measured = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        _measure, "doc_id long, " + ", ".join(f"{k} long" for k in MEASURES)
    )
    bits = [F.when(F.expr(rule), F.lit(1 << k)).otherwise(F.lit(0)) for k, rule in enumerate(RULES.values())]
    failed = bits[0]
    for bit in bits[1:]:
        failed = failed.bitwiseOR(bit)
    return measured.withColumn("failed", failed)


def mask(version: str) -> int:
    return sum(1 << list(RULES).index(rule) for rule in POLICIES[version])


def apply_policy(entries: DataFrame, version: str = "v1", name: str = "kept") -> DataFrame:
    return entries.withColumn(name, F.col("failed").bitwiseAND(F.lit(mask(version))) == 0)


def ablations(entries: DataFrame, version: str = "v1") -> DataFrame:
    """Per rule of the policy: documents it rejects, those only it rejects, and how many a policy without it keeps."""
    m = mask(version)
    hit = F.col("failed").bitwiseAND(F.lit(m))
    rows = [
        F.struct(
            F.lit(rule).alias("rule"),
            F.count_if(hit.bitwiseAND(F.lit(b)) != 0).alias("rejects"),
            F.count_if(hit == b).alias("rejects_alone"),
            F.count_if(hit.bitwiseAND(F.lit(m & ~b)) == 0).alias("kept_without"),
        )
        for rule in POLICIES[version]
        for b in [1 << list(RULES).index(rule)]
    ]
    return entries.agg(F.array(*rows).alias("r")).select(F.inline("r"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = apply_policy(apply_policy(ledger(documents(spark, sf_dir)), "v1"), "base", "base_ok")
    return entries.select("doc_id", *MEASURES[:5], (~F.col("base_ok")).alias("base_failed"), "kept", *MEASURES[5:], "failed")


SQL = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM t),
p AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS pos FROM w WHERE len(ws) >= 8),
k AS (SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id, array_to_string(ws[pos:pos + 7], ' ')) AS n FROM p),
c AS (SELECT doc_id, count(*) AS n_repeat_words FROM
      (SELECT DISTINCT doc_id, unnest(range(pos, pos + 8)) AS word FROM k WHERE n >= 2) GROUP BY doc_id),
l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM t),
d AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM l
      WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
m AS (SELECT doc_id, len(ws)::BIGINT AS n_words,
       length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
       length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
       coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
       coalesce(n_lines, 0)::BIGINT AS n_lines,
       length(regexp_replace(text, '[^A-Z]', '', 'g'))::BIGINT AS n_capitals,
       length(regexp_replace(text, '[^A-Za-z]', '', 'g'))::BIGINT AS n_letters
      FROM w LEFT JOIN c USING (doc_id) LEFT JOIN d USING (doc_id)),
f AS (SELECT *, ((n_words < 20)::INT + 2 * (100 * n_repeat_words > 30 * n_words)::INT + 4 * (10 * n_symbols > n_words)::INT
       + 8 * (2 * n_dup_lines > n_lines)::INT + 16 * (word_chars < 2 * n_words OR word_chars > 15 * n_words)::INT
       + 32 * (n_words >= 20 AND 10 * n_capitals > 6 * n_letters)::INT)::INT AS failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (failed & 3) <> 0 AS base_failed, failed = 0 AS kept,
       n_lines, n_capitals, n_letters, failed FROM f
"""
