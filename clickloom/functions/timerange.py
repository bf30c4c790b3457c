"""Half-open time ranges that prune both partitions and row groups."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, time, timedelta, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class TimeRange:
    """Instants ``[start, end)``; both carry a time zone."""

    start: datetime
    end: datetime

    def __post_init__(self):
        if self.start.tzinfo is None or self.end.tzinfo is None:
            raise ValueError("range bounds need a time zone")
        if self.end <= self.start:
            raise ValueError("the end of a range must lie after its start")

    def apply(self, events: DataFrame) -> DataFrame:
        """Rows inside the range.

        Spark does not derive partition bounds from ``event_time``, so a table partitioned by
        ``event_date`` also gets the bounds in dates.
        """
        at = F.col("event_time")
        kept = (at >= F.lit(self.start)) & (at < F.lit(self.end))
        if "event_date" in events.columns:
            last = (self.end - timedelta(microseconds=1)).astimezone(timezone.utc).date()
            first = self.start.astimezone(timezone.utc).date()
            kept = kept & F.col("event_date").between(F.lit(first), F.lit(last))
        return events.filter(kept)


def day_range(first: date, last: date) -> TimeRange:
    """Whole UTC days from ``first`` to ``last``, both included."""
    midnight = time(tzinfo=timezone.utc)
    return TimeRange(datetime.combine(first, midnight),
                     datetime.combine(last, midnight) + timedelta(days=1))


def iso_range(start: str, end: str) -> TimeRange:
    """Bounds from ISO-8601 text; no offset means UTC."""
    return TimeRange(_instant(start), _instant(end))


def recent_days(now: datetime | None = None) -> TimeRange:
    """The default range: the days touched by the last 24 hours."""
    now = (now or datetime.now(timezone.utc)).astimezone(timezone.utc)
    return day_range((now - timedelta(hours=24)).date(), now.date())


def _instant(text: str) -> datetime:
    moment = datetime.fromisoformat(text.strip())
    return moment if moment.tzinfo else moment.replace(tzinfo=timezone.utc)


def within(events: DataFrame, period: TimeRange | None) -> DataFrame:
    """Rows of the period; all rows without one."""
    return events if period is None else period.apply(events)
