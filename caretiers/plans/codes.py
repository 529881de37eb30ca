"""Codes in use against the code lists.

Codes are counted before they meet the lists, so a few rows for each code are all that is joined, and the
lists, some dozens of codes, are what is broadcast.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caretiers import contracts as C
from caretiers.functions import fhir
from caretiers.operators.flatten import as_resources
from caretiers.typed import TypedDataFrame, plain

#: Of each silver frame, SQL for the codes (as an array) of each field with a list, and the list.
CODED: dict[str, dict[str, tuple[str, list[str]]]] = {
    "patient": {"gender": ("array(gender)", C.GENDERS)},
    "condition": {
        "category": ("array(category_code)", C.CONDITION_CATEGORIES),
        "code_system": ("array(code_system)", list(C.SYSTEMS.values())),
    },
    "observation": {
        "status": ("array(status)", C.OBSERVATION_STATUSES),
        "category": ("category_codings.code", C.OBSERVATION_CATEGORIES),
        "value_type": ("array(value_type)", C.VALUE_TYPES),
        "component_value_type": ("components.value_type", C.VALUE_TYPES),
    },
    "condition_status": {
        "clinical": ("array(clinical_status)", C.CONDITION_CLINICAL_STATUSES),
        "verification": ("array(verification_status)", C.CONDITION_VERIFICATION_STATUSES),
    },
}


def code_sets(spark: SparkSession) -> DataFrame:
    """The lists as rows: ``frame``, ``field``, ``code``."""
    rows = [(frame, field, code) for frame, fields in CODED.items() for field, (_, codes) in fields.items() for code in codes]
    return spark.createDataFrame(rows, "frame string, field string, code string")


def condition_statuses(bronze: DataFrame | TypedDataFrame) -> DataFrame:
    """Clinical and verification status of conditions, which silver does not have: the first coding's code, or the text."""

    def status(name: str) -> str:
        return f"try_variant_get(resource, '$.{name}', '{fhir.CODEABLE_CONCEPT}') AS {name}"

    read = as_resources(bronze).selectExpr("try_variant_get(resource, '$.id', 'string') AS id", status("clinicalStatus"), status("verificationStatus"))

    def code(concept: str) -> Column:
        return F.coalesce(fhir.extract_first_coding(F.col(concept)).code, F.col(f"{concept}.text"))

    return read.select("id", code("clinicalStatus").alias("clinical_status"), code("verificationStatus").alias("verification_status"))


def used_codes(frames: Mapping[str, DataFrame | TypedDataFrame]) -> DataFrame:
    """Rows per ``frame``, ``field`` and ``code``. Each frame is read once; fields without a code are not counted.

    ``frames`` has silver frames by their names, and ``condition_status`` from ``condition_statuses``.
    """

    def counted(name: str, df: DataFrame) -> DataFrame:
        fields = ", ".join(f"transform({codes}, c -> struct('{field}' AS field, c AS code))" for field, (codes, _) in CODED[name].items())
        codes = df.selectExpr(f"inline(concat({fields}))").where("code IS NOT NULL")
        return codes.groupBy(F.lit(name).alias("frame"), "field", "code").agg(F.count("*").alias("rows"))

    return reduce(DataFrame.unionByName, [counted(name, plain(df)) for name, df in frames.items()])


def codes_outside_lists(spark: SparkSession, frames: Mapping[str, DataFrame | TypedDataFrame]) -> DataFrame:
    """The codes in use that are not in their field's list, and on how many rows."""
    return used_codes(frames).join(F.broadcast(code_sets(spark)), ["frame", "field", "code"], "left_anti")
