"""Sizes, shares and conditional counts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

GB = 1e9


def gb(bytes_: Column | str) -> Column:
    """Content volume in decimal gigabytes; one division, at the end."""
    return _col(bytes_).cast("double") / F.lit(GB)


def half_even(value: Column, digits: int) -> Column:
    """A double rounded half to even, without the decimal arithmetic of bround."""
    scale = F.lit(10.0**digits)
    return F.rint(value * scale) / scale


def gb2(bytes_: Column | str) -> Column:
    """Gigabytes with two decimals."""
    return half_even(gb(bytes_), 2)


def kib(bytes_: Column | str) -> Column:
    return half_even(_col(bytes_) / F.lit(1024.0), 1)


def mib(bytes_: Column | str) -> Column:
    return half_even(_col(bytes_) / F.lit(1048576.0), 2)


def pct(part: Column | str, whole: Column | str) -> Column:
    """part / whole * 100, and 0 when there is no whole."""
    part, whole = _col(part).cast("double"), _col(whole).cast("double")
    return F.when(whole > 0, part / whole * F.lit(100.0)).otherwise(F.lit(0.0))


def width(value: Column | str, largest: Column | str) -> Column:
    """Bar width against the largest value, at most 100."""
    return F.least(pct(value, largest), F.lit(100.0))


def big_sum(bytes_: Column | str) -> Column:
    """Sum of already summed byte counts over the whole estate.

    Bytes of one site fit a bigint; the estate may not, so partial sums are
    added as decimals. Use on aggregated rows only.
    """
    return F.sum(_col(bytes_).cast("decimal(20,0)"))


def total(values: Column | str) -> Column:
    """Sum that is 0, not NULL, over no rows."""
    return F.coalesce(F.sum(_col(values)), F.lit(0).cast("bigint"))


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
