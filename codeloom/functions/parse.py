"""Tolerant conversions: bad input becomes null, never an error."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from codeloom.functions.text import as_col, strip

_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"

# Date layouts met in the extracts; month comes first in slashed dates.
DATE_LAYOUTS = (
    "yyyy-MM-dd",
    "M/d/yyyy",
    "M/d/yy",
    "yyyyMMdd",
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss",
    "M/d/yyyy H:mm",
    "M/d/yyyy H:mm:ss",
    "yyyy/M/d",
    "d-MMM-yyyy",
    "MMM d, yyyy",
)


def to_number(value: Column | str, kind: str = "double") -> Column:
    text = strip(as_col(value).cast("string"))
    return F.when(text.rlike(_NUMBER), text).try_cast(kind)


def to_status(value: Column | str) -> Column:
    """A status such as ``1``, ``1.0`` or ``01`` as an integer; anything fractional or textual is null."""
    number = to_number(value)
    return F.when(number == F.floor(number), number).try_cast("int")


def to_date_mixed(value: Column | str, layouts: Iterable[str] = DATE_LAYOUTS) -> Column:
    text = strip(as_col(value).cast("string"))
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(layout)) for layout in layouts]).cast("date")
