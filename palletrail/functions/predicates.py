"""Row predicates.  Every function returns a boolean column, or None for "no condition"."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F


def stamp(value: datetime) -> Column:
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def keep(df: DataFrame, *conditions: Column | None) -> DataFrame:
    for condition in conditions:
        if condition is not None:
            df = df.where(condition)
    return df


def between_window(when: Column, start: datetime | None, end: datetime | None) -> Column | None:
    """Closed window that only a start switches on; a start without an end matches nothing."""
    if start is None:
        return None
    if end is None:
        return F.lit(False)
    return when.between(stamp(start), stamp(end))


def open_window(when: Column, start: datetime | None, end: datetime | None) -> Column | None:
    """Window whose two ends are optional one by one."""
    ends = [when >= stamp(start)] if start is not None else []
    ends += [when <= stamp(end)] if end is not None else []
    return _all(ends)


def rolling_window(when: Column, as_of: datetime, days: int) -> Column:
    return when >= stamp(as_of) - F.expr(f"interval {days} days")


def ref_filter(reference: Column, wanted: str | None) -> Column | None:
    """Reference filter from one text, case ignored: all, LIKE pattern, list, or one value.

    A text with both ``%`` and ``,`` matches by either reading.  List items are compared
    as whole values, so a reference with ``_`` in it is no wildcard here.
    """
    if not wanted:
        return None
    value, wanted = F.upper(reference), wanted.upper()
    readings = []
    if "%" in wanted:
        readings.append(value.like(wanted))
    if "," in wanted:
        readings.append(value.isin(*wanted.split(",")))
    if not readings:
        readings.append(value == wanted)
    return F.coalesce(_any(readings), F.lit(False))


def self_transfer_drop(source: Column, target: Column) -> Column:
    """Source and target carrier differ; a missing carrier differs from everything."""
    return source.isNull() | target.isNull() | (source != target)


def numeric_target(carrier: Column) -> Column:
    return carrier.rlike("^[0-9]+$")


def has_prefix(value: Column, prefixes: Iterable[str]) -> Column:
    return _any([value.like(f"{prefix}%") for prefix in prefixes])


def starts_with_digit(value: Column) -> Column:
    return value.rlike(r"^\d")


def nullable_exclude(value: Column, excluded: str) -> Column:
    """Everything but one value; NULL stays."""
    return ~value.eqNullSafe(F.lit(excluded))


def nullable_unlike(value: Column, pattern: str) -> Column:
    return ~F.coalesce(value.like(pattern), F.lit(False))


def report_predicate(where: Mapping[str, str]) -> Column:
    """Conditions on derived report columns: LIKE (case ignored) where there is a ``%``, else equal."""
    return _all([
        F.upper(F.col(name)).like(value.upper()) if "%" in value else F.col(name) == value
        for name, value in where.items()
    ])


def mask_ready(channel: Column, place: Column, carrier: Column, *, wanted: str = "OUTLET",
               not_at: Sequence[str] = ("OLAP", "FIN"), carrier_prefix: str = "50") -> Column:
    """Stock ready to go: outlet channel, not at the excluded places, on a shipping carrier."""
    at = F.upper(F.trim(F.coalesce(place, F.lit(""))))
    return _all([
        F.upper(F.trim(F.coalesce(channel, F.lit("")))) == wanted,
        *[~at.startswith(prefix) for prefix in not_at],
        F.trim(F.coalesce(carrier, F.lit(""))).startswith(carrier_prefix),
    ])


def _all(conditions: Sequence[Column]) -> Column | None:
    joined = None
    for condition in conditions:
        joined = condition if joined is None else joined & condition
    return joined


def _any(conditions: Sequence[Column]) -> Column | None:
    joined = None
    for condition in conditions:
        joined = condition if joined is None else joined | condition
    return joined
