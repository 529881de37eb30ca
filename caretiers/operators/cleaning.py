"""Cleaning of column names and top-level string columns. Nested values stay as they are."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# All characters with the Unicode White_Space property. Python also counts the four
# information separators as space, which the property does not.
WHITE_SPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace() and c not in range(0x1C, 0x20))


def get_string_column_names(df: DataFrame) -> list[str]:
    return [field.name for field in df.schema.fields if isinstance(field.dataType, T.StringType)]


def _map_strings(df: DataFrame, change) -> DataFrame:
    strings = set(get_string_column_names(df))
    return df.select(*[change(df[c]).alias(c) if c in strings else df[c] for c in df.columns])


def lowercase_columns(df: DataFrame) -> DataFrame:
    """Column names in lower case."""
    lowered = [name.lower() for name in df.columns]
    if lowered == df.columns:
        return df
    if len(set(lowered)) < len(lowered):
        raise ValueError(f"column names collide in lower case: {df.columns}")
    return df.toDF(*lowered)


def strip(column: Column, mode: str = "unicode") -> Column:
    """Text without white space at both ends; ``mode="spaces"`` strips the space only."""
    return F.trim(column) if mode == "spaces" else F.btrim(column, F.lit(WHITE_SPACE))


def trim_string_columns(df: DataFrame, mode: str = "unicode") -> DataFrame:
    return _map_strings(df, lambda column: strip(column, mode))


def nullify_string_columns(df: DataFrame) -> DataFrame:
    """Empty strings become null."""
    return _map_strings(df, lambda column: F.nullif(column, F.lit("")))


def clean(df: DataFrame) -> DataFrame:
    """Lower-case names, then trim, then nullify, so that blank text ends up null."""
    return df.transform(lowercase_columns).transform(trim_string_columns).transform(nullify_string_columns)
