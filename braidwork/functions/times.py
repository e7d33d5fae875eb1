"""Timestamps as columns (UTC, microseconds); the run's time is always handed in."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_ISO = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(\.\d{1,9})?(Z| UTC|[+-]\d{2}:?\d{2})?$"
_COLON_MICROS = r"^(\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}):(\d{1,6})( UTC|Z)?$"


def as_timestamp(text: Column) -> Column:
    """The instant of a text in one of the accepted forms, null for others.

    ``…T10:30:00[.digits][Z| UTC|+00:00]``, with a blank for the T, or microseconds behind a colon.
    """
    text = F.btrim(text)
    plain = F.when(text.rlike(_ISO), F.regexp_replace(F.regexp_replace(text, " UTC$", "Z"), r"([+-]\d{2})(\d{2})$", "$1:$2").try_cast("timestamp"))
    micros = F.concat(F.regexp_extract(text, _COLON_MICROS, 1), F.lit("."), F.lpad(F.regexp_extract(text, _COLON_MICROS, 2), 6, "0"), F.lit("Z"))
    return F.coalesce(plain, F.when(text.rlike(_COLON_MICROS), micros.try_cast("timestamp")))


def iso(instant: Column) -> Column:
    return F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def normalised(text: Column) -> Column:
    """The ISO form of a timestamp text; null for blank, the text itself if it is in no accepted form."""
    return F.when(F.btrim(text) != "", F.coalesce(iso(as_timestamp(text)), text))


def whole_days(start: Column, end: Column) -> Column:
    """Full 24-hour days between two instants."""
    return F.floor((F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))) / 86_400_000_000).cast("long")


def seconds_between(start: Column, end: Column) -> Column:
    return F.floor((F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))) / 1_000_000).cast("long")


def local_time(instant: Column, zone: str = "America/New_York") -> Column:
    """The wall-clock time in a zone, without a zone."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), instant.cast("timestamp_ntz"))


def month_of(instant: Column) -> Column:
    return F.trunc(F.to_date(instant), "month")


def age_bucket(days: Column) -> Column:
    return F.when(days < 1, "same day").when(days < 3, "1-2 days").when(days < 7, "3-6 days").otherwise("7+ days")
