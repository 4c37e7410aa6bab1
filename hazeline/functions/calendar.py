"""Calendar, cyclic and formatting expressions on timestamps."""

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from hazeline.schemas import LOCAL_ZONE

WEEKDAYS = ("Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun")


def day_of_week(ts: Column) -> Column:
    """Monday is 0."""
    return F.weekday(ts)


def cyclic(value: Column, period: int) -> tuple[Column, Column]:
    angle = F.lit(2 * math.pi) * value / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def hour_flag(ts: Column, first: int, last: int) -> Column:
    return F.hour(ts).between(first, last).cast("int")


def season(ts: Column, september_is_summer: bool) -> Column:
    """Winter 0, spring 1, summer 2, autumn 3; definitions differ on September."""
    month = F.month(ts)
    summer_end = 9 if september_is_summer else 8
    return (
        F.when(month.isin(12, 1, 2), 0)
        .when(month.between(3, 5), 1)
        .when(month.between(6, summer_end), 2)
        .when(month.isNotNull(), 3)
    )


def day_name(ts: Column) -> Column:
    """Three-letter English day name, independent of the locale."""
    names = F.array(*[F.lit(name) for name in WEEKDAYS])
    return F.get(names, F.weekday(ts))


def to_local(ts: Column, zone: str = LOCAL_ZONE) -> Column:
    """Wall clock of a zone as a zoneless value, from a UTC one."""
    return F.from_utc_timestamp(ts, zone)


def add_hours(ts: Column, hours: Column) -> Column:
    return ts + F.make_dt_interval(hours=hours)


def add_days(ts: Column, days: Column) -> Column:
    return ts + F.make_dt_interval(days=days)


def stamp_label(ts: Column, zone_label: str = "PKT") -> Column:
    """``05 Jan 2024, 14:00 PKT``."""
    return F.concat(F.date_format(ts, "dd MMM yyyy, HH:mm"), F.lit(f" {zone_label}"))


def day_label(ts: Column, offset: Column) -> Column:
    """``Tomorrow · Fri 05 Jan`` or ``Day 2 · Sat 06 Jan``."""
    head = F.when(offset == 1, F.lit("Tomorrow")).otherwise(F.concat(F.lit("Day "), offset.cast("string")))
    return F.concat(head, F.lit(" · "), day_name(ts), F.date_format(ts, " dd MMM"))
