"""Scalar column functions: lenient numbers, safe ratios, rounding, times, keys, display text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clickloom.schemas import EVENT_TIME_FORMAT, SNAPSHOT_PREFIX


def lenient_long(value: Column) -> Column:
    """BIGINT, fractions cut off, with anything that is not a number counted as 0."""
    return F.coalesce(value.try_cast("bigint"), value.try_cast("double").try_cast("bigint"),
                      F.lit(0).cast("bigint"))


def lenient_double(value: Column) -> Column:
    """DOUBLE; NaN and anything that is not a number count as 0."""
    return F.coalesce(F.nanvl(value.try_cast("double"), F.lit(0.0)), F.lit(0.0))


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """0.0 when the denominator is 0 or null."""
    return F.coalesce(F.try_divide(numerator.cast("double"), denominator.cast("double")), F.lit(0.0))


def round_even(value: Column, digits: int = 2) -> Column:
    """Half-even on the scaled double, as numerical array libraries round."""
    scale = 10.0 ** digits
    return F.rint(value * F.lit(scale)) / F.lit(scale)


def share_pct(share: Column) -> Column:
    return round_even(share * F.lit(100.0), 2)


def utc_date(event_time: Column) -> Column:
    """The UTC day, whatever the session's time zone."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(event_time) / F.lit(86_400)).cast("int"))


def day_bucket(event_time: Column) -> Column:
    return utc_date(event_time).cast("string")


def hour_bucket(event_time: Column) -> Column:
    return F.pmod(F.floor(F.unix_seconds(event_time) / F.lit(3600)), F.lit(24)).cast("int")


def parse_event_time(text: Column) -> Column:
    """Strict topic format; anything else is null instead of an error."""
    return F.try_to_timestamp(text, F.lit(EVENT_TIME_FORMAT))


def parse_iso(text: Column) -> Column:
    """ISO-8601, a full date at least, with or without an offset (none means UTC); anything else is null."""
    bare = F.trim(text)
    clock = r"[T ]\d{2}(:\d{2}(:\d{2}([.,]\d{1,9})?)?)?"
    whole = bare.rlike(rf"^\d{{4}}-\d{{2}}-\d{{2}}({clock}(Z|[+-]\d{{2}}(:?\d{{2}})?)?)?$")
    minutes = F.regexp_replace(bare, r"^(.{10}[T ]\d{2})(Z|[+-].*)?$", "$1:00$2")
    seconds = F.regexp_replace(minutes, r"^(.{10}[T ]\d{2}:\d{2})(Z|[+-].*)?$", "$1:00$2")
    offset = F.regexp_replace(seconds, r"([+-]\d{2})(\d{2})$", "$1:$2")
    zoned = (F.when(bare.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.concat(bare, F.lit("T00:00:00Z")))
             .when(offset.rlike(r"(Z|[+-]\d{2}(:\d{2})?)$") & (F.length(offset) > 10), offset)
             .otherwise(F.concat(offset, F.lit("Z"))))
    return F.when(whole, F.try_to_timestamp(F.regexp_replace(zoned, r"([T ].*[+-]\d{2})$", "$1:00")))


def iso_utc(event_time: Column) -> Column:
    """Whole seconds with a ``Z`` suffix."""
    second = F.pmod(F.unix_seconds(event_time), F.lit(86_400))
    parts = (F.floor(second / 3600), F.floor(second / 60) % 60, second % 60)
    clock = F.concat_ws(":", *[F.lpad(p.cast("string"), 2, "0") for p in parts])
    return F.concat(day_bucket(event_time), F.lit("T"), clock, F.lit("Z"))


def snapshot_key(product_id: Column, prefix: str = SNAPSHOT_PREFIX) -> Column:
    return F.concat_ws(":", F.lit(prefix), product_id)


def product_of_key(key: Column) -> Column:
    """Last segment of a snapshot key."""
    return F.element_at(F.split(key, ":"), -1)


def format_int(value: Column) -> Column:
    """Thousands separated by dots."""
    return F.regexp_replace(F.format_number(value.cast("bigint"), 0), ",", ".")


def format_pct(share: Column) -> Column:
    """One digit, half-even on the exact value of the double."""
    shown = F.format_number(share.cast("double") * F.lit(100.0), 1)
    return F.concat(F.regexp_replace(shown, ",", ""), F.lit("%"))


def format_money(value: Column) -> Column:
    return F.concat(F.lit("US$ "), F.format_number(value.cast("double"), 2))
