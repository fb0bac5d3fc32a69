"""Modified Julian dates, TAI and UTC, nights."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: First MJD (UTC) and TAI - UTC in seconds from there on.
LEAP_SECONDS = (
    (41317, 10), (41499, 11), (41683, 12), (42048, 13), (42413, 14), (42778, 15), (43144, 16), (43509, 17), (43874, 18), (44239, 19),
    (44786, 20), (45151, 21), (45516, 22), (46247, 23), (47161, 24), (47892, 25), (48257, 26), (48804, 27), (49169, 28), (49534, 29),
    (50083, 30), (50630, 31), (51179, 32), (53736, 33), (54832, 34), (56109, 35), (57204, 36), (57754, 37),
)
UNIX_EPOCH_MJD = 40587


def mjd_of(ts: Column) -> Column:
    """MJD of a timestamp; a timestamp without zone counts as UTC."""
    return F.unix_micros(ts.cast("timestamp")).cast("double") / 86400e6 + float(UNIX_EPOCH_MJD)


def tai_minus_utc(mjd_tai: Column) -> Column:
    """Seconds, by the range that a TAI date falls into; a fixed list of 28 ranges, so no join."""
    out = F.lit(LEAP_SECONDS[0][1])
    for start, seconds in LEAP_SECONDS[1:]:
        out = F.when(mjd_tai >= start + seconds / 86400, F.lit(seconds)).otherwise(out)
    return out


def mjd_tai_to_utc_micros(mjd_tai: Column) -> Column:
    """Microseconds since 1970 UTC."""
    return F.floor((mjd_tai - float(UNIX_EPOCH_MJD)) * 86400e6 + 0.5).cast("long") - tai_minus_utc(mjd_tai).cast("long") * 1_000_000


def mjd_tai_to_utc(mjd_tai: Column) -> Column:
    return F.timestamp_micros(mjd_tai_to_utc_micros(mjd_tai))


def night(mjd: Column) -> Column:
    return F.floor(mjd).cast("long")
