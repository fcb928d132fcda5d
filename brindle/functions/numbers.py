"""Numeric and time expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Places in a recording at which samples start.
FRACTIONS = (0.06, 0.23, 0.43, 0.63, 0.79)


def safe_ratio(a: Column, b: Column) -> Column:
    return a / F.greatest(b, F.lit(1))


def pct1(a: Column, b: Column) -> Column:
    """Percentage to one decimal, rounded half up."""
    return F.round((a * 100 / F.greatest(b, F.lit(1))).cast("decimal(18,6)"), 1).cast("double")


def to_double_strict(c: Column) -> Column:
    """A number written in digits as a double; null for anything else, so '1d' and '1_0' are null."""
    return F.when(c.rlike(r"^\s*[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?\s*$"), F.trim(c).try_cast("double"))


def clamp(c: Column, low: Column, high: Column) -> Column:
    return F.least(F.greatest(c, low), high)


def norm_bonus(value: Column, low: Column, high: Column, span: int) -> Column:
    """Place of a value between two quartiles as whole points from -span to span, halves to even; 0 if low >= high."""
    place = (clamp((value - low) / (high - low), F.lit(0.0), F.lit(1.0)) * 2 - 1) * span
    usable = value.isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf")) & (high > low)
    return F.when(usable, F.bround(place, 0).cast("int")).otherwise(F.lit(0))


def backoff_minutes(n: Column, base: int = 30) -> Column:
    return (F.lit(base) * F.pow(F.lit(2), n - 1)).cast("int")


def days_after(ts: Column, n: Column) -> Column:
    return ts + F.make_dt_interval(n.cast("int"))


def within_days(ts: Column, now: Column, days: int = 7) -> Column:
    return ts >= now - F.make_dt_interval(F.lit(days))


def local_hour(ts: Column, tz: Column) -> Column:
    return F.hour(F.from_utc_timestamp(ts, tz))


def local_weekday(ts: Column, tz: Column) -> Column:
    """Sunday is 0."""
    return F.dayofweek(F.from_utc_timestamp(ts, tz)) - 1


def segment_window(duration: Column, ordinal: Column, seg: float = 300.0, fractions: Sequence[float] = FRACTIONS) -> Column:
    """Start and length in seconds of a sample, at one of five places of the recording."""
    d = F.coalesce(duration, F.lit(0.0))
    share = F.element_at(F.array(*[F.lit(x) for x in fractions]), (F.pmod(ordinal, F.lit(len(fractions))) + 1).cast("int"))
    start = F.least(F.greatest(F.lit(35.0), d * share), d - seg - 15)
    short = d <= seg + 60
    return F.struct(
        F.when(short, 20.0).otherwise(start).alias("start"),
        F.when(short, F.when(d > 0, F.greatest(F.lit(90.0), d - 30)).otherwise(float(seg))).otherwise(F.least(F.lit(float(seg)), d - start - 8)).alias("length"),
    )


def sample_stride(duration: Column) -> Column:
    return F.greatest(F.lit(3.0), duration / 110)


def aspect(w: Column, h: Column) -> Column:
    return w / F.greatest(h, F.lit(1))


def fit_dims(w: Column, h: Column, min_w: int = 960, min_h: int = 540, max_w: int = 2560) -> Column:
    """Size scaled up to a least width and height, and then down to a greatest width; halves to even."""
    up = F.greatest(F.lit(1.0), F.lit(float(min_w)) / w, F.lit(float(min_h)) / h)
    down = F.least(F.lit(1.0), F.lit(float(max_w)) / (w * up))
    return F.struct(F.bround(w * up * down, 0).cast("int").alias("w"), F.bround(h * up * down, 0).cast("int").alias("h"))


def in_send_window(now: Column, tz: Column, days: Column, start: Column, end: Column) -> Column:
    """Whether the local weekday is in the list and the local hour in [start, end); tz must be valid or null."""
    day_ok = (F.size(days) == 0) | F.array_contains(days, local_weekday(now, tz))
    hour = local_hour(now, tz)
    return F.coalesce(day_ok & (hour >= F.coalesce(start, F.lit(8))) & (hour < F.coalesce(end, F.lit(18))), F.lit(True))
