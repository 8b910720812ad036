"""Epoch seconds, readable times and snapshot file names.

Everything is computed in UTC on zone-free timestamps, so the session time
zone does not change a result.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"
# First second of year 1 and last second of year 9999.
_FIRST_SECOND, _LAST_SECOND = -62135596800, 253402300799
_NAME = r"^(.+)_([0-9]{8})_([0-9]{6})\.(?:pb|json)$"


def epoch_seconds(moment: Column) -> Column:
    """Whole seconds since 1970 of a zone-free timestamp read as UTC."""
    days = F.unix_date(moment.cast("date")).cast("bigint")
    return days * 86400 + F.hour(moment) * 3600 + F.minute(moment) * 60 + F.second(moment)


def format_epoch(seconds: Column) -> Column:
    """``YYYY-MM-DD HH:MM:SS``; null outside the years 1 to 9999."""
    return F.when(
        seconds.between(_FIRST_SECOND, _LAST_SECOND),
        F.timestamp_add("SECOND", seconds, F.expr(_EPOCH)).cast("string"),
    )


def iso_time(seconds: Column) -> Column:
    """``YYYY-MM-DDTHH:MM:SS``; null outside the years 1 to 9999.

    Six digits of a second follow where ``seconds`` has a fraction.
    """
    exact = seconds.cast("decimal(20,6)")
    whole = F.floor(exact).cast("bigint")
    micros = ((exact - whole) * 1_000_000).cast("int")
    fraction = F.when(micros == 0, "").otherwise(F.concat(F.lit("."), F.lpad(micros.cast("string"), 6, "0")))
    return F.concat(F.replace(format_epoch(whole), F.lit(" "), F.lit("T")), fraction)


def timestamp_readable(seconds: Column) -> Column:
    """Readable time of a record; null and zero both count as no time."""
    return F.when(seconds != 0, format_epoch(seconds))


def snapshot_filename(feed_type: Column, seconds: Column, extension: str) -> Column:
    """``<kind>_<yyyyMMdd>_<HHmmss>.<extension>`` for a UTC second."""
    stamp = F.translate(format_epoch(seconds), " -:", "_")
    return F.concat(feed_type, F.lit("_"), stamp, F.lit("." + extension))


def _base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def snapshot_kind(path: Column) -> Column:
    """The feed kind in a snapshot's file name; null if the name has another form."""
    kind = F.regexp_extract(_base_name(path), _NAME, 1)
    return F.when(kind != "", kind)


def snapshot_epoch(path: Column) -> Column:
    """The UTC second in a snapshot's file name; null if it names no real time."""
    stamp = F.regexp_extract(
        _base_name(path), r"_([0-9]{8}_[0-9]{6})\.(?:pb|json)$", 1
    )
    spaced = F.regexp_replace(
        stamp, "^(....)(..)(..)_(..)(..)(..)$", "$1-$2-$3 $4:$5:$6"
    )
    return epoch_seconds(spaced.try_cast("timestamp_ntz"))


def day_folder(seconds: Column) -> dict[str, Column]:
    """``year``, ``month`` and ``day`` folder names, zero padded."""
    text = format_epoch(seconds)
    return {
        "year": F.substring(text, 1, 4),
        "month": F.substring(text, 6, 2),
        "day": F.substring(text, 9, 2),
    }
