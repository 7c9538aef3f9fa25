"""Calendar expressions on naive local time (`timestamp_ntz`).

All of them give the same answer in every session time zone: a naive 02:30 on a daylight-saving night is an
ordinary value and must not move. Functions that go through the zoned `timestamp` type are avoided.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the text format of raw timestamps, e.g. 05/15/2022 09:00:00 AM (leading zeros optional).
RAW_TIMESTAMP_FORMAT = "M/d/yyyy h:mm:ss a"


def parse_timestamp(text: Column, fmt: str = RAW_TIMESTAMP_FORMAT) -> Column:
    """Text to naive timestamp, null where it does not parse."""
    parsed = F.from_csv(text, "t timestamp_ntz", {"timestampNTZFormat": fmt, "sep": "\u0001"})
    return parsed.getField("t")


def floor_to_hour(ts: Column) -> Column:
    return F.make_timestamp_ntz(F.year(ts), F.month(ts), F.day(ts), F.hour(ts), F.lit(0), F.lit(0))


def step_interval(step: str, count: int = 1) -> Column:
    return F.expr(f"INTERVAL {int(count)} {step.upper()}")


def step_index(ts: Column, step: str) -> Column:
    """Number of the whole step since 1970: consecutive integers along a gap-free grid."""
    days = F.unix_date(ts.cast("date")).cast("bigint")
    return days * 24 + F.hour(ts) if step == "hour" else days


def steps_between(start: Column, end: Column, step: str) -> Column:
    """Whole steps from start to end (both on one grid)."""
    return step_index(end, step) - step_index(start, step)


def _within_step(ts: Column, step: str) -> Column:
    parts = [F.minute(ts), F.date_part(F.lit("SECONDS"), ts)]
    return F.struct(*parts) if step == "hour" else F.struct(F.hour(ts), *parts)


def on_grid(ts: Column, origin: Column, step: str) -> Column:
    """Whether `ts` lies a whole number of steps from `origin`; null for a null time."""
    return ts.isNotNull() & (_within_step(ts, step) == _within_step(origin, step))


def complete_steps(start: Column, end: Column, step: str) -> Column:
    """Steps that are complete between two times, which need not lie on one grid."""
    begun = F.when(_within_step(end, step) < _within_step(start, step), 1).otherwise(0)
    return steps_between(start, end, step) - begun


def add_steps(ts: Column, count: Column, step: str) -> Column:
    return ts + step_interval(step) * count


def day_of_week(ts: Column) -> Column:
    """Monday = 0 to Sunday = 6."""
    return F.weekday(ts)


def is_weekend(ts: Column) -> Column:
    return F.weekday(ts) >= 5


def timestamp_literal(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")
