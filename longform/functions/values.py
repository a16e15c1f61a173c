"""Scalar expressions on values and keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(value) -> Column:
    """``''`` becomes null; a value of blanks is kept."""
    return F.nullif(_col(value), F.lit(""))


def surrogate_key(*values) -> Column:
    """First eight hex digits of the SHA-256 of the values joined by ``|``.

    A null counts as an empty string, so that it keeps its place between the bars.
    """
    parts = [F.coalesce(_col(v).cast("string"), F.lit("")) for v in values]
    return F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, 8)


def to_number(value) -> Column:
    """Text to double, null where it is no number (``136.`` is one)."""
    return _col(value).try_cast("double")


def to_day(value, fmt: str = "yyyy-MM-dd") -> Column:
    """Text to date, null where it does not follow the format."""
    return F.try_to_date(_col(value), fmt)


def numeric_value(value, data_type) -> Column:
    """The number in ``value`` where the mapped type is numeric, else null."""
    return F.when(_col(data_type) == "numeric", to_number(value))


def clip(value, low=None, high=None) -> Column:
    """Bound a measure; either bound may be left out, nulls stay null."""
    out = v = _col(value)
    if low is not None:
        out = F.greatest(out, F.lit(low))
    if high is not None:
        out = F.least(out, F.lit(high))
    return F.when(v.isNotNull(), out)


def round_significant(value, digits: int) -> Column:
    """Round to ``digits`` significant figures; zero and null pass through."""
    v = _col(value).cast("double")
    places = F.lit(digits - 1) - F.floor(F.log10(F.abs(v)))
    # scale by a power >= 1 on either side, which keeps round decimals exact
    up = F.pow(F.lit(10.0), F.greatest(places, F.lit(0)))
    down = F.pow(F.lit(10.0), F.greatest(-places, F.lit(0)))
    return F.when(v == 0, v).otherwise(F.round(v * up / down) * down / up)


def turnaround_days(received, processed) -> Column:
    return F.datediff(_col(processed), _col(received))
