"""Adding and replacing columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame


def column_name(df: DataFrame, column: Column) -> str:
    """Output name of an expression (its alias, or the name of the column it refers to)."""
    return df.select(column).columns[0]


def with_columns(df: DataFrame, *columns: Column, **named: Column) -> DataFrame:
    """All columns of ``df`` plus the given ones; a replaced column moves to the end.

    Positional expressions keep their own name.
    """
    added = {column_name(df, column): column for column in columns} | named
    kept = [df[name] for name in df.columns if name not in added]
    return df.select(*kept, *[column.alias(name) for name, column in added.items()])
