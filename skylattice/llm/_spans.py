"""Places of pattern matches as native column expressions.

Spark's functions give the matched texts and the texts between them; places are the running sums of their lengths,
taken in blocks so that a text with n matches takes about 64 n additions and no window or shuffle. Lengths are code points.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

_BLOCK = 128


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is evaluated once."""
    return F.transform(F.array(value), body)[0]


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a + x)


def _starts(lengths: Column) -> Column:
    """For each element the sum of those before it."""

    def blocks(v: Column) -> Column:
        sums = F.transform(F.sequence(F.lit(0), F.ceil(F.size(v) / _BLOCK).cast("int") - 1), lambda b: _total(F.slice(v, b * _BLOCK + 1, _BLOCK)))
        return F.aggregate(sums, F.array(F.lit(0).cast("long")), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)))

    def inner(v: Column) -> Column:
        return let(
            blocks(v),
            lambda b: F.transform(
                F.sequence(F.lit(0), F.size(v) - 1),
                lambda i: F.get(b, F.floor(i / _BLOCK).cast("int")) + _total(F.slice(v, (F.floor(i / _BLOCK) * _BLOCK + 1).cast("int"), i % _BLOCK)),
            ),
        )

    return let(lengths, inner)


#: What matches() gives: half-open places and the matched text.
SPAN = "array<struct<begin:bigint,stop:bigint,found:string>>"


def matches(text: Column, pattern: str, only_if: Column | None = None) -> Column:
    """array of (begin, stop, found) of the leftmost, non-overlapping matches of a Java pattern that matches no empty text."""

    def place(hits: Column) -> Column:
        gaps = F.transform(F.split(text, pattern, -1), F.char_length)
        each = F.zip_with(gaps, F.transform(hits, F.char_length), lambda g, h: F.coalesce(g, F.lit(0)).cast("long") + F.coalesce(h, F.lit(0)))
        return let(
            gaps,
            lambda g: let(
                _starts(each),
                lambda s: F.transform(
                    hits,
                    lambda h, i: F.struct(
                        (F.get(s, i) + F.get(g, i)).alias("begin"),
                        (F.get(s, i) + F.get(g, i) + F.char_length(h)).alias("stop"),
                        h.alias("found"),
                    ),
                ),
            ),
        )

    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    found = let(hits, lambda h: F.when(F.size(h) > 0, place(h)))
    if only_if is not None:
        found = F.when(only_if, found)
    return F.coalesce(found, F.array().cast(SPAN))


def listed(spans: Column) -> Column:
    """kind:start:end of all, by start, then the kind's number, then end, joined by commas."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["begin"], s["n"], s["stop"], s["kind"])))
    return F.concat_ws(",", F.transform(ordered, lambda s: F.concat_ws(":", s["kind"], s["begin"], s["stop"])))


def labelled(spans: Column, kind: str, n: int) -> Column:
    """The spans with their kind and its number."""
    return F.transform(spans, lambda s: F.struct(F.lit(n).alias("n"), F.lit(kind).alias("kind"), s["begin"].alias("begin"), s["stop"].alias("stop"), s["found"].alias("found")))


def is_kind(n: int) -> Callable[[Column], Column]:
    return lambda s: s["n"] == n


def redact(text: Column, spans: Column, mark: Callable[[Column], Column]) -> Column:
    """`text` with every span replaced by mark(kind); spans that overlap are replaced as one, by the first one's mark."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["begin"].alias("begin"), s["n"].alias("n"), s["stop"].alias("stop"), s["kind"].alias("kind"))))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out"))

    def step(a: Column, s: Column) -> Column:
        fresh = F.concat(a["out"], F.array(F.substring(text, (a["at"] + 1).cast("int"), (s["begin"] - a["at"]).cast("int")), mark(s["kind"])))
        return F.struct(F.greatest(a["at"], s["stop"]).alias("at"), F.when(s["begin"] >= a["at"], fresh).otherwise(a["out"]).alias("out"))

    def finish(a: Column) -> Column:
        return F.concat(F.array_join(a["out"], ""), F.substring(text, (a["at"] + 1).cast("int"), F.char_length(text)))

    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(ordered, start, step, finish))
