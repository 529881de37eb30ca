"""Date functions."""

from __future__ import annotations

import datetime
import itertools
import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caretiers.operators.columns import with_columns

# Strptime directives and their Java letters.
_NUMERIC = {"m": "M", "d": "d", "H": "H", "I": "h", "M": "m", "S": "s"}
_OTHER = {"Y": "yyyy", "y": "yy", "j": "DDD", "f": "SSSSSS", "b": "MMM", "B": "MMMM", "p": "a"}


def java_pattern(strptime_format: str) -> str:
    """Java date pattern of a ``strptime`` format.

    A number next to another number has a fixed width; otherwise leading zeros are optional.
    """
    parts = re.findall(r"%.|[^%]+", strptime_format)
    pattern = []
    for i, part in enumerate(parts):
        if part == "%%":
            pattern.append("%")
        elif not part.startswith("%"):
            pattern.append(re.sub(r"[A-Za-z]+", r"'\g<0>'", part.replace("'", "''")))
        elif part[1] in _NUMERIC:
            touching = any(0 <= j < len(parts) and parts[j].startswith("%") for j in (i - 1, i + 1))
            pattern.append(_NUMERIC[part[1]] * (2 if touching else 1))
        elif part[1] in _OTHER:
            pattern.append(_OTHER[part[1]])
        else:
            raise ValueError(f"unsupported directive {part} in {strptime_format!r}")
    return "".join(pattern)


def parse_iso_date(column: Column) -> Column:
    """``yyyy-mm-dd`` text to a date, null for anything else."""
    return F.when(column.rlike(r"\A\p{Nd}{4}-\p{Nd}{2}-\p{Nd}{2}\z"), F.try_to_date(column, "yyyy-MM-dd"))


def age_in_years(birth_date: Column, as_of: Column) -> Column:
    """Whole years of 365 days between two dates, rounded down."""
    return F.floor(F.datediff(as_of, birth_date) / 365).cast("long")


def datediff(
    start: Column, end: Column, days_to_ignore: Column | Sequence[datetime.date] | None = None
) -> Column:
    """Days from start to end.

    With ``days_to_ignore`` (a column of date arrays, or a list of dates for all rows): the days of
    the closed interval that are not ignored, minus one and never below 0. A null array ignores
    nothing; a null date gives null. Only the ignored days are looked at; the days of the interval
    are never listed.
    """
    days = F.datediff(end, start)
    if days_to_ignore is None:
        return days
    if isinstance(days_to_ignore, Column):
        inside = F.filter(F.array_distinct(days_to_ignore), lambda day: (day >= start) & (day <= end))
        ignored = F.coalesce(F.array_size(inside), F.lit(0))
    else:
        ignored = _listed_days(days_to_ignore, end) - _listed_days(days_to_ignore, F.date_sub(start, 1))
    return F.when(start.isNotNull() & end.isNotNull(), F.greatest(days - ignored, F.lit(0)))


def _listed_days(listed: Sequence[datetime.date], until: Column) -> Column:
    """How many of the listed days are not after ``until``: one lookup by day number.

    The running counts from the first to the last listed day are a constant of the plan.
    """
    ordered = sorted(set(listed))
    if not ordered:
        return F.lit(0)
    span = (ordered[-1] - ordered[0]).days + 1
    is_listed = {(day - ordered[0]).days for day in ordered}
    counts = itertools.accumulate((day in is_listed for day in range(span)), initial=0)
    table = F.split(F.lit(",".join(str(int(count)) for count in counts)), ",").cast("array<int>")
    position = F.datediff(until, F.lit(ordered[0])) + 1
    return F.get(table, F.greatest(F.least(position, F.lit(span)), F.lit(0)))


def convert_int_expr_to_date(column: Column) -> Column:
    """Eight digits ``yyyymmdd``, as number or text, to a date; null for anything else."""
    text = column.cast("string")
    return F.when(text.rlike(r"\A[0-9]{8}\z"), F.try_to_date(text, "yyyyMMdd"))


def convert_ints_to_dates(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return with_columns(df, **{name: convert_int_expr_to_date(df[name]) for name in columns})


def timestamp_to_date(column: Column, timestamp_format: str | None = None) -> Column:
    """Date of a timestamp, or of text in a ``strptime`` format. Unreadable text is an error."""
    return F.to_date(column, java_pattern(timestamp_format)) if timestamp_format else F.to_date(column)


def convert_timestamps_to_dates(
    df: DataFrame, columns: Iterable[str], timestamp_format: str | None = None
) -> DataFrame:
    """``timestamp_to_date`` on those listed columns that exist."""
    wanted = set(columns)
    found = [name for name in df.columns if name in wanted]
    return with_columns(df, **{name: timestamp_to_date(df[name], timestamp_format) for name in found}) if found else df
