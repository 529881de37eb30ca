"""Data frames with a declared schema.

A subclass of ``TypedDataFrame`` lists its columns as annotations::

    class Point(TypedDataFrame):
        x: Col[int]
        color: Col[str | None]

``Point.x`` is an unbound column, ``Point.from_df(df).x`` a column of that frame, and
everything a ``DataFrame`` can do is available on the wrapper.
"""

from __future__ import annotations

import datetime
import decimal
import types
import typing
from collections.abc import Iterable
from typing import Any, ClassVar, Generic, Self, TypeVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caretiers.operators.columns import with_columns

V = TypeVar("V")

_SCALARS: dict[type, T.DataType] = {
    str: T.StringType(),
    int: T.LongType(),
    float: T.DoubleType(),
    bool: T.BooleanType(),
    bytes: T.BinaryType(),
    datetime.date: T.DateType(),
    datetime.datetime: T.TimestampType(),
    decimal.Decimal: T.DecimalType(38, 18),
}


class SchemaError(ValueError):
    """A frame does not have the columns its typed class declares."""


def spark_type(hint: Any) -> tuple[T.DataType, bool]:
    """Spark type and nullability of a column annotation."""
    if isinstance(hint, T.DataType):
        return hint, False
    if typing.get_origin(hint) in (typing.Union, types.UnionType):
        options = [option for option in typing.get_args(hint) if option is not type(None)]
        if len(options) != 1:
            raise TypeError(f"a column has one type, not {hint}")
        return spark_type(options[0])[0], True
    if typing.get_origin(hint) is list:
        element, contains_null = spark_type(typing.get_args(hint)[0])
        return T.ArrayType(element, contains_null), False
    if typing.get_origin(hint) is dict:
        key, value = typing.get_args(hint)
        value_type, contains_null = spark_type(value)
        return T.MapType(spark_type(key)[0], value_type, contains_null), False
    if hint in _SCALARS:
        return _SCALARS[hint], False
    if isinstance(hint, type) and typing.get_type_hints(hint):
        fields = [T.StructField(name, *spark_type(inner)) for name, inner in typing.get_type_hints(hint).items()]
        return T.StructType(fields), False
    raise TypeError(f"no Spark type for {hint!r}")


class Col(Generic[V]):
    """Column of a typed frame."""

    def __init__(self, name: str):
        self.name = name

    def __get__(self, frame: TypedDataFrame | None, owner: type) -> Column:
        if frame is not None:
            return frame.df[self.name]
        column = F.col(self.name)
        column.__dict__["unbound_name"] = self.name
        return column


def _join_key(key: Any) -> Any:
    # An unbound column is ambiguous in a self-join; its name is not.
    return vars(key).get("unbound_name", key) if isinstance(key, Column) else key


class TypedDataFrame:
    """A ``DataFrame`` whose schema is declared by the class."""

    SchemaError: ClassVar[type[Exception]] = SchemaError
    _columns: ClassVar[T.StructType] = T.StructType([])

    def __init__(self, df: DataFrame):
        self.df = df

    def __init_subclass__(cls, abstract: bool = False, **kwargs: Any):
        super().__init_subclass__(**kwargs)
        if abstract:
            return
        fields = []
        for name, hint in typing.get_type_hints(cls).items():
            if typing.get_origin(hint) is Col:
                data_type, nullable = spark_type(typing.get_args(hint)[0])
                fields.append(T.StructField(name, data_type, nullable))
                setattr(cls, name, Col(name))
        cls._columns = T.StructType(fields)

    def __getattr__(self, name: str) -> Any:
        if name == "df":
            raise AttributeError(name)
        return getattr(self.df, name)

    def __getitem__(self, item: Any) -> Any:
        return self.df[item]

    def __dir__(self) -> Iterable[str]:
        return sorted({*super().__dir__(), *dir(self.df)})

    def __repr__(self) -> str:
        return f"{type(self).__name__}({self.df!r})"

    @classmethod
    def as_spark_schema(cls) -> T.StructType:
        return cls._columns

    @classmethod
    def from_df(cls, df: DataFrame | TypedDataFrame, validate: bool = True, strict: bool = False) -> Self:
        """Wrap a frame after comparing its schema with the declared one.

        Order and nullability of columns are free. ``strict`` also refuses columns that are
        not declared.
        """
        df = plain(df)
        if validate:
            cls._check(df.schema, strict)
        return cls(df)

    from_relation = from_df

    @classmethod
    def from_dicts(cls, dicts: list[dict[str, Any]], schema: T.StructType | None = None) -> Self:
        """Typed frame from local rows; a key missing from a row becomes null."""
        spark = SparkSession.getActiveSession()
        if spark is None:
            raise RuntimeError("from_dicts needs an active SparkSession")
        wanted = schema or cls.as_spark_schema()
        free = T.StructType([T.StructField(f.name, f.dataType, True) for f in wanted.fields])
        rows = [tuple(row.get(name) for name in free.names) for row in dicts]
        return cls.from_df(spark.createDataFrame(rows, schema=free))

    @classmethod
    def _check(cls, found: T.StructType, strict: bool) -> None:
        have = {field.name: field.dataType.simpleString() for field in found.fields}
        want = {field.name: field.dataType.simpleString() for field in cls._columns.fields}
        problems = [f"{name}: missing, expected {want[name]}" for name in want if name not in have]
        problems += [
            f"{name}: is {have[name]}, expected {want[name]}"
            for name in want
            if name in have and have[name] != want[name]
        ]
        if strict:
            problems += [f"{name}: not declared" for name in have if name not in want]
        if problems:
            raise SchemaError(f"{cls.__name__}: " + "; ".join(problems))

    def join(self, other: DataFrame | TypedDataFrame, on: Any = None, how: str | None = None) -> DataFrame:
        if isinstance(on, (list, tuple)):
            on = [_join_key(key) for key in on]
        else:
            on = _join_key(on)
        return self.df.join(plain(other), on, how)

    def with_columns(self, **named: Column) -> DataFrame:
        return with_columns(self.df, **named)


def plain(df: DataFrame | TypedDataFrame) -> DataFrame:
    """The ``DataFrame`` behind a typed or plain frame."""
    return df.df if isinstance(df, TypedDataFrame) else df
