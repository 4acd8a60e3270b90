"""Safe casts: a bad cell becomes NULL instead of failing the job (ANSI mode)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_bool(c: Column | str) -> Column:
    """'true/t/yes/y/1' and 'false/f/no/n/0' (any case, trimmed) -> boolean; else NULL."""
    return _c(c).try_cast("boolean")


def safe_timestamp(c: Column | str) -> Column:
    return F.try_to_timestamp(_c(c))


def coerce_numeric(c: Column | str) -> Column:
    """Text -> double; non-numbers, NaN and +/-inf -> NULL."""
    d = _c(c).try_cast("double")
    return F.when(F.isnan(d) | (F.abs(d) == F.lit(float("inf"))), F.lit(None).cast("double")).otherwise(d)


# Fixed value: the ISO-8601 duration shape read by the producer; matched at the
# start of the text only, so a day part ("P1DT2H") or fractions give 0.
ISO_DURATION_PATTERN = r"^PT(?:(\d+)H)?(?:(\d+)M)?(?:(\d+)S)?"


# With ``allow_days``: an optional day part, and a 'T' that may be absent.
ISO_DURATION_DAYS_PATTERN = r"^P(?:(\d+)D)?(?:T(?:(\d+)H)?(?:(\d+)M)?(?:(\d+)S)?)?$"


def iso_duration_seconds(c: Column | str, allow_days: bool = False) -> Column:
    """'PT#H#M#S' -> integer seconds; no match, NULL or '' -> 0.

    By default a day part gives 0 (the producer's rule); ``allow_days=True``
    also reads 'P#DT#H#M#S' (whole text, integer parts only).
    """
    c = _c(c)
    pattern = ISO_DURATION_DAYS_PATTERN if allow_days else ISO_DURATION_PATTERN

    def part(i: int) -> Column:
        return F.coalesce(F.regexp_extract(c, pattern, i).try_cast("long"), F.lit(0))

    if allow_days:
        total = part(1) * 86400 + part(2) * 3600 + part(3) * 60 + part(4)
    else:
        total = part(1) * 3600 + part(2) * 60 + part(3)
    return F.coalesce(total.try_cast("int"), F.lit(0))
