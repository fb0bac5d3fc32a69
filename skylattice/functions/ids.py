"""Packed designations as integers and back, and string helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def packed_to_long(packed: Column) -> Column:
    """Left-padded to eight ASCII characters, cut to eight, read as a little-endian integer."""
    return F.conv(F.hex(F.reverse(F.lpad(packed, 8, " "))), 16, 10).cast("bigint")


def long_to_packed(number: Column) -> Column:
    return F.ltrim(F.reverse(F.decode(F.unhex(F.lpad(F.hex(number), 16, "0")), "UTF-8")))


def stripped(text: Column) -> Column:
    """Without the NULs that pad a fixed-width string."""
    return F.regexp_replace(text, "\\x00+$", "")


def object_hash(name: Column) -> Column:
    """A 64-bit id for a name."""
    return F.xxhash64(name)
