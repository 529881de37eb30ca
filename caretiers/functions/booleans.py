"""Text to boolean."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def string_to_boolean(column: Column, true_values: Iterable[str], false_values: Iterable[str]) -> Column:
    """True or false for listed values, null for all others."""
    listed_true = column.isin(list(true_values))
    listed_false = column.isin(list(false_values))
    return F.when(listed_true, F.lit(True)).when(listed_false, F.lit(False))


def map_to_boolean(column: Column, to_true: list[str] | str, to_false: list[str] | str) -> Column:
    """``string_to_boolean`` on any type; one value may be given without a list."""
    as_list = [[values] if isinstance(values, str) else values for values in (to_true, to_false)]
    return string_to_boolean(column.cast("string"), *as_list)


def convert_strings_to_boolean(
    df: DataFrame, columns: Iterable[str], true_values: Iterable[str], false_values: Iterable[str]
) -> DataFrame:
    """``string_to_boolean`` on those listed columns that exist."""
    wanted = set(columns)
    return df.withColumns(
        {name: string_to_boolean(df[name], true_values, false_values) for name in df.columns if name in wanted}
    )
