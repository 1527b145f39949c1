"""Time helpers on TIMESTAMP_NTZ columns; no expression depends on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_SECONDS = 86_400


def _epoch() -> Column:
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")


def seconds_interval(n: Column | int) -> Column:
    """A day-time interval of ``n`` whole seconds."""
    n = F.lit(n) if isinstance(n, int) else n
    return F.make_dt_interval(secs=n.cast("decimal(18,6)"))


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds since 1970 of the wall clock (floor), as bigint."""
    day = F.unix_date(F.to_date(ts)).cast("bigint")
    return day * DAY_SECONDS + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def from_epoch_seconds(n: Column) -> Column:
    return _epoch() + seconds_interval(n)


def second_fraction(ts: Column) -> Column:
    return F.extract(F.lit("SECOND"), ts) - F.second(ts)


def floor_seconds(ts: Column, step: int) -> Column:
    """Floor to a multiple of ``step`` seconds since midnight 1970-01-01."""
    return from_epoch_seconds(F.floor(epoch_seconds(ts) / F.lit(step)).cast("bigint") * step)


def floor_minute(ts: Column) -> Column:
    return ts - F.make_dt_interval(secs=F.extract(F.lit("SECOND"), ts).cast("decimal(18,6)"))


def on_the_minute(ts: Column) -> Column:
    return F.extract(F.lit("SECOND"), ts) == 0


def on_the_hour(ts: Column) -> Column:
    return on_the_minute(ts) & (F.minute(ts) == 0)


def time_of_day(ts: Column) -> Column:
    """Seconds since midnight including the fraction."""
    return (F.hour(ts) * 3600 + F.minute(ts) * 60) + F.extract(F.lit("SECOND"), ts)


def clock_between(ts: Column, first: str, last: str) -> Column:
    """Time of day within ``HH:MM`` bounds, both included to the last fraction."""

    def to_seconds(text: str) -> int:
        hours, minutes = text.split(":")
        return int(hours) * 3600 + int(minutes) * 60

    return time_of_day(ts).between(F.lit(to_seconds(first)), F.lit(to_seconds(last)))


def as_datetime(text: Column) -> Column:
    """Text to TIMESTAMP_NTZ, null where it is no date-time."""
    return F.trim(text).try_cast("timestamp_ntz")


def slash_datetime(text: Column) -> Column:
    """``yyyy/MM/dd HH:mm`` text to TIMESTAMP_NTZ, null where it has another form."""
    ok = text.rlike(r"^\d{4}/\d{2}/\d{2} \d{2}:\d{2}$")
    return F.when(ok, F.replace(text, F.lit("/"), F.lit("-"))).try_cast("timestamp_ntz")


def iso_wall_clock(text: Column) -> Column:
    """ISO-8601 text with an offset to the wall clock it shows; the offset is dropped."""
    bare = F.regexp_replace(text, r"(Z|[+-]\d{2}:?\d{2})$", "")
    return F.nullif(bare, F.lit("")).try_cast("timestamp_ntz")


def datetime_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def slash_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy/MM/dd HH:mm")


def calendar_parts(ts: Column) -> dict[str, Column]:
    return {"Hour": F.hour(ts), "Minute": F.minute(ts), "Month": F.month(ts)}


def serial_fields(serial: Column) -> dict[str, Column]:
    """Split a slot serial ``yyyyMMddHHmm`` + two-digit site.

    A spreadsheet's trailing ``.0`` is cut off first. Fields that do not parse
    are null.
    """
    bare = F.split_part(F.trim(serial), F.lit("."), F.lit(1))

    def number(start: int, length: int) -> Column:
        return F.substring(bare, start, length).try_cast("int")

    start = F.try_make_timestamp_ntz(
        number(1, 4), number(5, 2), number(7, 2), number(9, 2), number(11, 2), F.lit(0).cast("decimal(16,6)")
    )
    site = F.when(F.length(bare) > 0, F.right(bare, F.lit(2)))
    return {
        "slot_start": F.when(bare.rlike(r"^\d{12}"), start),
        "LocationCode": F.when(site.rlike(r"^\s*[+-]?\d+\s*$"), site).try_cast("int"),
    }
