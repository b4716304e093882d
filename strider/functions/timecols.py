"""Epoch-millisecond time columns.

All clock fields are taken in UTC from the epoch value itself, through a
TIMESTAMP_NTZ, so results do not depend on the session time zone.
"""

from __future__ import annotations

import datetime as _dt
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

# Slots are half hours, 48 per day.
SLOT_MINUTES = 30
SLOTS_PER_DAY = 48
DAY_MS = 86_400_000



def _epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _epoch_seconds(ts_ntz: Column | str) -> Column:
    # NTZ − NTZ is a day-time interval: no session time zone is involved.
    return (_col(ts_ntz) - _epoch_ntz()).cast("decimal(18,6)")


def epoch_ms(ts_ntz: Column | str) -> Column:
    """TIMESTAMP_NTZ (UTC wall clock) → epoch milliseconds (floor of the micros)."""
    return F.floor(_epoch_seconds(ts_ntz) * 1000).cast("long")


def epoch_ms_whole_seconds(ts_ntz: Column | str) -> Column:
    """TIMESTAMP_NTZ → epoch milliseconds at whole-second precision."""
    return (F.floor(_epoch_seconds(ts_ntz)) * 1000).cast("long")


def day_folder(ts_ntz: Column | str) -> Column:
    """TIMESTAMP_NTZ → day folder name ``DDMMYY`` (from the date parts, zone-free)."""
    d = _col(ts_ntz).cast("date")

    def two(x: Column) -> Column:
        return F.lpad(x.cast("string"), 2, "0")
    return F.concat(two(F.dayofmonth(d)), two(F.month(d)), two(F.pmod(F.year(d), F.lit(100))))


def ms_to_utc(ms: Column | str) -> Column:
    """Epoch milliseconds → TIMESTAMP_NTZ holding the UTC wall clock."""
    return F.timestamp_add("MILLISECOND", _col(ms), _epoch_ntz())


def half_hour_slot(ms: Column | str) -> Column:
    """Half-hour slot 0..47 of the UTC day: floor((hour*60 + minute) / 30)."""
    ts = ms_to_utc(ms)
    return F.floor((F.hour(ts) * 60 + F.minute(ts)) / SLOT_MINUTES).cast("int")


def iso_weekday(ms: Column | str) -> Column:
    """ISO day of week, Monday = 1 … Sunday = 7."""
    return (F.weekday(ms_to_utc(ms)) + 1).cast("int")


def slot_text(slot: Column | str) -> Column:
    """Half-hour slot → ``h:mm AM/PM`` (0 → 12:00 AM, 24 → 12:00 PM)."""
    slot = _col(slot).cast("int")
    total = slot * SLOT_MINUTES
    hours = F.floor(total / 60).cast("int")
    minutes = F.pmod(total, F.lit(60))
    h12 = F.when(F.pmod(hours, F.lit(12)) == 0, F.lit(12)).otherwise(F.pmod(hours, F.lit(12)))
    return F.concat(h12.cast("string"), F.lit(":"), F.lpad(minutes.cast("string"), 2, "0"),
                    F.lit(" "), F.when(hours < 12, F.lit("AM")).otherwise(F.lit("PM")))


# --- parameters (driver-side scalars, not data) ------------------------------------

def to_epoch_ms(value: _dt.datetime | str | int, tz: str = "UTC") -> int:
    """A datetime (naive values are in ``tz``) or ISO text → epoch ms, whole seconds."""
    if isinstance(value, int):
        return value
    if isinstance(value, str):
        value = _dt.datetime.fromisoformat(value)
    if value.tzinfo is None:
        value = value.replace(tzinfo=ZoneInfo(tz))
    return int(value.timestamp()) * 1000


def day_end_ms(start_ms: int, tz: str = "UTC") -> int:
    """Last millisecond (23:59:59.999) of the day of ``start_ms`` in ``tz``."""
    zone = ZoneInfo(tz)
    start = _dt.datetime.fromtimestamp(start_ms / 1000.0, zone)
    end = start.replace(hour=23, minute=59, second=59, microsecond=999000)
    return int(round(end.timestamp() * 1000))
