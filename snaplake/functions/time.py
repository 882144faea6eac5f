"""Time helpers that keep the input's timestamp flavour (LTZ or NTZ)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, TimestampNTZType, TimestampType


def is_ntz(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, TimestampNTZType)


def trunc_like(df: DataFrame, column: str, unit: str) -> Column:
    """``date_trunc(unit, column)`` with the same timestamp type as the input.

    ``date_trunc`` always yields an LTZ timestamp; for an NTZ (or DATE)
    input the session zone is UTC, so casting back is exact.
    """
    dt = df.schema[column].dataType
    src = F.col(column)
    if isinstance(dt, DateType):
        return F.date_trunc(unit, src.cast("timestamp"))
    out = F.date_trunc(unit, src)
    return out.cast("timestamp_ntz") if isinstance(dt, TimestampNTZType) else out


def epoch_micros(c: Column) -> Column:
    """Microseconds since the epoch for LTZ or NTZ timestamps (session UTC)."""
    return F.unix_micros(c.cast("timestamp"))


def day_number(c: Column) -> Column:
    """Days since 1970-01-01 of a DATE (the ordering key of calendar frames)."""
    return F.unix_date(c)


def utc_naive(ts: _dt.datetime) -> _dt.datetime:
    if ts.tzinfo is not None:
        ts = ts.astimezone(_dt.timezone.utc).replace(tzinfo=None)
    return ts


def ts_lit(ts: _dt.datetime | _dt.date, like: DataType | None = None) -> Column:
    """A timestamp literal in UTC of the same type as ``like`` (LTZ default).

    Built from text so the Python process' local zone never matters.
    """
    if isinstance(ts, _dt.datetime):
        text = utc_naive(ts).strftime("%Y-%m-%d %H:%M:%S.%f")
    else:
        text = ts.strftime("%Y-%m-%d 00:00:00")
    target = "timestamp_ntz" if isinstance(like, TimestampNTZType) else "timestamp"
    if like is not None and not isinstance(like, (TimestampNTZType, TimestampType)):
        target = like.simpleString()
    return F.lit(text).cast(target)


def period_bounds(as_of: _dt.datetime) -> dict[str, _dt.datetime]:
    """UTC day and month of ``as_of`` as half-open [start, end) bounds."""
    t = utc_naive(as_of)
    day = t.replace(hour=0, minute=0, second=0, microsecond=0)
    month = day.replace(day=1)
    nxt = (month.replace(year=month.year + 1, month=1) if month.month == 12
           else month.replace(month=month.month + 1))
    return {"day_start": day, "day_end": day + _dt.timedelta(days=1),
            "month_start": month, "month_end": nxt}
