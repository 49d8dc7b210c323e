"""Snapshot dates and names."""

from __future__ import annotations

from datetime import date, datetime
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

# The time zone that decides "today", the name of a snapshot.
SNAPSHOT_ZONE = "America/New_York"
SNAPSHOT_NAME = "{table}_{day}.csv"
SNAPSHOT_PATTERN = r"([^/]+)_(\d{4}-\d{2}-\d{2})\.csv(/part-[^/]*)?$"


def snapshot_today(now: datetime | None = None) -> date:
    """Today in US Eastern time; ``now`` must carry a time zone."""
    return (now or datetime.now(ZoneInfo(SNAPSHOT_ZONE))).astimezone(ZoneInfo(SNAPSHOT_ZONE)).date()


def snapshot_day(moment: Column, zone: str | None = None) -> Column:
    """The US Eastern day of a timestamp as ``YYYY-MM-DD``, for any session time zone.

    ``zone`` is the time zone of a timestamp that carries none.
    """
    source = F.lit(zone) if zone else None
    local = F.convert_timezone(source, F.lit(SNAPSHOT_ZONE), moment.cast("timestamp_ntz"))
    return F.date_format(local, "yyyy-MM-dd")


def snapshot_name(table: str, day: date) -> str:
    return SNAPSHOT_NAME.format(table=table, day=day.isoformat())


def as_date(day: date | str) -> date:
    return day if isinstance(day, date) else date.fromisoformat(day)
