"""Binary tables of FITS files as rows. The format is read with NumPy alone: no reader needs to be installed."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

#: Fixed values of the format: bytes of a block and of a header line; column letters with NumPy and Spark types.
BLOCK = 2880
CARD = 80
LETTERS = {"L": ("S1", T.BooleanType()), "B": ("u1", T.ShortType()), "I": (">i2", T.ShortType()), "J": (">i4", T.IntegerType()), "K": (">i8", T.LongType()), "E": (">f4", T.FloatType()), "D": (">f8", T.DoubleType()), "A": ("S", T.StringType())}


def _header(raw: bytes, at: int) -> tuple[dict[str, str], int]:
    """The header that begins at a place: its values as they are written, and where the data begin."""
    found: dict[str, str] = {}
    while True:
        card = raw[at : at + CARD].decode("ascii")
        if len(card) < CARD:
            raise ValueError("a header without END")
        at += CARD
        if card.startswith("END") and not card[3:].strip():
            return found, -(-at // BLOCK) * BLOCK
        if card[8:10] == "= ":
            value = card[10:].strip()
            text = re.match(r"'((?:[^']|'')*)'", value)
            found[card[:8].strip()] = text[1].replace("''", "'").rstrip() if text else value.split("/")[0].strip()


def table(raw: bytes, number: int = 1) -> pd.DataFrame:
    """The number-th binary table of a file's bytes. Cells of several values, other than texts, are lists."""
    at = 0
    while at < len(raw):
        head, at = _header(raw, at)
        shape = [int(head[f"NAXIS{k + 1}"]) for k in range(int(head["NAXIS"]))]
        size = abs(int(head["BITPIX"])) // 8 * int(np.prod(shape)) if shape else 0
        size += int(head.get("PCOUNT", 0))
        if head.get("XTENSION") == "BINTABLE":
            number -= 1
            if not number:
                return _cells(raw, at, head, shape)
        at += -(-size // BLOCK) * BLOCK
    raise ValueError("no such binary table")


def _cells(raw: bytes, at: int, head: dict[str, str], shape: list[int]) -> pd.DataFrame:
    fields = []
    for k in range(1, int(head["TFIELDS"]) + 1):
        form = re.match(r"(\d*)([A-Z])", head[f"TFORM{k}"])
        times, letter = int(form[1] or 1), form[2]
        if letter not in LETTERS:
            raise ValueError(f"columns of the form {head[f'TFORM{k}']} are not read")
        kind = LETTERS[letter][0]
        fields.append((head[f"TTYPE{k}"], f"S{times}") if letter == "A" else (head[f"TTYPE{k}"], kind, (times,)) if times != 1 else (head[f"TTYPE{k}"], kind))
    rows = np.frombuffer(raw, np.dtype(fields), shape[1], at)
    out = {}
    for k, (name, *_) in enumerate(fields, 1):
        cells, letter = rows[name], re.match(r"\d*([A-Z])", head[f"TFORM{k}"])[1]
        if letter == "A":
            cells = [x.decode("ascii", "replace").rstrip(" \0") for x in cells.tolist()]
        elif letter == "L":
            cells = [None if x not in (b"T", b"F") else x == b"T" for x in cells.tolist()] if cells.ndim == 1 else [[x == b"T" for x in c] for c in cells.tolist()]
        else:
            cells = cells.astype(cells.dtype.newbyteorder("="))
            if f"TSCAL{k}" in head or f"TZERO{k}" in head:
                cells = cells * float(head.get(f"TSCAL{k}", 1)) + float(head.get(f"TZERO{k}", 0))
            cells = cells if cells.ndim == 1 else cells.tolist()
        out[name] = cells
    return pd.DataFrame(out)


def fits_tables(spark: SparkSession, path: str, schema: T.StructType, number: int = 1, unique: str | None = None) -> DataFrame:
    """The rows of a binary table in every file of `path`, one file per task; `schema` names the columns that are wanted.

    `unique`: of rows that agree in this column one is left.
    """
    names = [f.name for f in schema.fields]

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for content in part["content"]:
                yield table(bytes(content), number)[names]

    rows = spark.read.format("binaryFile").load(path).select("content").mapInPandas(run, schema)
    return rows.dropDuplicates([unique]) if unique else rows
