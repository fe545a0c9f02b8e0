"""Full-time or part-time, from free text about working hours."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import SPACE, _c, fold_schedule, let

FULL_TIME = "Toàn thời gian"
PART_TIME = "Bán thời gian"
FULL_TIME_HOURS = 35
LUNCH_FROM, LUNCH = 8.5, 1.0
DEFAULT_HOURS, DEFAULT_DAYS = 8.0, 5.0

_S = f"[{SPACE}]*"
_DAY_RANGE = rf"thu{_S}([2-7]){_S}-{_S}thu{_S}([2-7])"


def hours_per_day(text: Column, folded: Column) -> Column:
    """Sum of consecutive clock pairs, else a number of hours; long days lose lunch."""
    clock = F.regexp_extract_all(text, F.lit("([0-9]{1,2}:[0-9]{2})"), F.lit(1))
    minutes = F.transform(
        clock,
        lambda t: F.split_part(t, F.lit(":"), F.lit(1)).cast("int") * 60
        + F.split_part(t, F.lit(":"), F.lit(2)).cast("int"),
    )

    def worked(times: Column) -> Column:
        pairs = F.floor(F.size(times) / 2).cast("int")
        total = F.aggregate(
            F.sequence(F.lit(0), pairs - 1),
            F.lit(0.0),
            lambda acc, i: acc
            + F.greatest(F.lit(0.0), (F.get(times, i * 2 + 1) - F.get(times, i * 2)) / F.lit(60.0)),
        )
        return F.when(pairs >= 1, total).otherwise(F.lit(0.0))

    spoken = F.regexp_extract(folded, rf"([0-9]{{1,2}}){_S}(?:h|gio|tieng)", 1).try_cast("double")
    hours = let(minutes, worked)
    hours = let(hours, lambda h: F.when(h == 0, F.coalesce(spoken, F.lit(0.0))).otherwise(h))
    hours = let(hours, lambda h: F.when(h >= LUNCH_FROM, h - LUNCH).otherwise(h))
    return let(hours, lambda h: F.when(h > 0, h))


def days_per_week(folded: Column) -> Column:
    """Length of a weekday range, else the number of weekdays named."""
    first = F.regexp_extract(folded, _DAY_RANGE, 1).try_cast("int")
    last = F.regexp_extract(folded, _DAY_RANGE, 2).try_cast("int")
    named = F.size(F.array_distinct(F.regexp_extract_all(folded, F.lit(rf"thu{_S}([2-7])"), F.lit(1))))
    sunday = F.when(folded.rlike(rf"chu{_S}nhat|cn"), 1).otherwise(0)
    monthly = folded.rlike(rf"[0-9]+{_S}thu{_S}7{_S}/{_S}thang")
    listed = F.when(monthly, F.greatest(named + sunday, F.lit(5))).otherwise(named + sunday)
    return F.when(last >= first, last - first + 1).when(named > 0, listed).cast("double")


def classify_work_schedule(col: Column | str) -> Column:
    """Full or part time; null for null or empty text."""
    col = _c(col)

    def estimate(parts: Column) -> Column:
        hours = F.coalesce(parts["hours"], F.lit(DEFAULT_HOURS))
        days = F.coalesce(parts["days"], F.lit(DEFAULT_DAYS))
        known = parts["hours"].isNotNull() | parts["days"].isNotNull()
        return F.when(known & (hours * days >= FULL_TIME_HOURS), F.lit(FULL_TIME)).otherwise(F.lit(PART_TIME))

    def body(folded: Column) -> Column:
        full = F.contains(folded, F.lit("toan thoi gian")) | F.contains(folded, F.lit("full time"))
        part = F.contains(folded, F.lit("ban thoi gian")) | F.contains(folded, F.lit("part time"))
        parts = F.struct(hours_per_day(col, folded).alias("hours"), days_per_week(folded).alias("days"))
        return F.when(full, F.lit(FULL_TIME)).when(part, F.lit(PART_TIME)).otherwise(let(parts, estimate))

    return F.when(col != "", let(fold_schedule(col), body))
