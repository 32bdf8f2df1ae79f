"""Column expressions shared by batch and stream. All are Spark built-ins, so
they stay inside generated code and cost no Python round trip."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

# Rating of an event type; weights of views, carts, purchases.
RATINGS = {"view": 1.0, "addtocart": 3.0, "transaction": 5.0}
SCORE_WEIGHTS = (0.1, 0.3, 0.6)


def safe_ratio(num: Column | str, den: Column | str) -> Column:
    """num / den where den is positive, else 0.0 (a NULL den also gives 0.0)."""
    num, den = _col(num), _col(den)
    return F.when(den > 0, num / den).otherwise(F.lit(0.0))


def implicit_rating(event_type: Column | str = "event_type") -> Column:
    kind = _col(event_type)
    return first_of([(kind == name, F.lit(value)) for name, value in RATINGS.items()], 0.0)


def weighted_score(views: Column | str, carts: Column | str, purchases: Column | str) -> Column:
    parts = [_col(c) * w for c, w in zip((views, carts, purchases), SCORE_WEIGHTS)]
    return parts[0] + parts[1] + parts[2]


def count_of(event_type: str) -> Column:
    """Rows of one event type in the group (0 when there are none)."""
    return F.count_if(F.col("event_type") == event_type)


def event_time(text: Column | str = "timestamp") -> Column:
    """ISO text to a timestamp; unreadable text gives NULL, also under ANSI mode."""
    return F.try_to_timestamp(_col(text))


def event_date(text: Column | str = "timestamp") -> Column:
    return F.to_date(event_time(text))


def iso_text(ts: Column | str) -> Column:
    """Timestamp as ISO text; the fraction is left out when it is zero."""
    ts = _col(ts)
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    return F.when(F.date_trunc("second", ts) == ts, whole).otherwise(
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    )


def epoch_day(ms: Column | str) -> Column:
    """UTC calendar day of an epoch in milliseconds, whatever the session zone."""
    return F.date_from_unix_date(F.floor(_col(ms) / F.lit(86_400_000)).cast("int"))


def cents(amount: Column | str) -> Column:
    """Round to two places by the exact binary value, halves to even.

    2.675 is stored a little below the half and becomes 2.67. Where the product
    with 100 lands on a half, the exact remainder of that product (from the two
    halves of the number, whose products are exact) tells the side.
    """
    x = _col(amount)
    scaled = x * 100
    split = x * F.lit(134217729.0)  # 2^27 + 1
    high = split - (split - x)
    remainder = (high * 100 - scaled) + (x - high) * 100
    on_half = scaled - F.floor(scaled) == 0.5
    nearest = (
        F.when(on_half & (remainder > 0), F.ceil(scaled))
        .when(on_half & (remainder < 0), F.floor(scaled))
        .otherwise(F.rint(scaled))
    )
    return nearest.cast("double") / 100


def split_bucket(*keys: Column | str) -> Column:
    """0..9 from whole-number keys by arithmetic alone: the same split in every
    run, engine and partitioning (two keys: 31 a + 17 b). Last digits are taken
    first, so that wide keys do not overflow. Meant for comparing engines; ids
    that end alike fall together, unlike under ``hash_bucket``."""
    factors = (31, 17, 13, 7)
    digits = (F.pmod(_col(k), F.lit(10)) * f for k, f in zip(keys, factors))
    return F.pmod(reduce(lambda a, b: a + b, digits), F.lit(10))


def hash_bucket(*keys: Column | str) -> Column:
    """0..9 by a hash of the keys: the same in every run and partitioning."""
    return F.pmod(F.xxhash64(*keys), F.lit(10))


def null_safe_keys(left: str, right: str, keys: Sequence[str]) -> Column:
    """Equality on all keys where NULL meets NULL. Still a hash / merge key for Spark."""
    return reduce(
        lambda a, b: a & b,
        (F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys),
    )


def first_of(steps: Sequence[tuple[Column, Column]], otherwise=None) -> Column:
    """CASE over (condition, value) pairs."""
    (condition, value), *rest = steps
    chain = reduce(lambda c, step: c.when(*step), rest, F.when(condition, value))
    return chain.otherwise(otherwise)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
