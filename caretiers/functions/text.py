"""Text functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalize_municipality_name(column: Column) -> Column:
    """Capitalise each hyphenated part: ``MÄNTTÄ-VILPPULA`` becomes ``Mänttä-Vilppula``."""
    return F.array_join(F.transform(F.split(column, "-"), F.initcap), "-")
