"""FHIR bundles to bronze, silver and gold tables on Spark, with data-quality reports."""

from caretiers.session import build_session
from caretiers.typed import Col, SchemaError, TypedDataFrame

__all__ = ["Col", "SchemaError", "TypedDataFrame", "build_session"]
