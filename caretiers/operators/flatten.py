"""Flat patient, condition and observation rows from nested resources.

The inner projection reads each JSON field once, with its type; the outer one derives the flat
columns. A job that needs two columns therefore reads two fields: Catalyst prunes the rest, down
to the shredded variant in the Parquet scan.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caretiers import contracts as C
from caretiers.functions import fhir
from caretiers.typed import TypedDataFrame, plain

LINEAGE = ["_source_file", "_source_bundle", "_full_url"]

_NAME = "struct<family:variant,given:variant,text:variant>"
_ADDRESS = "struct<line:variant,city:variant,postalCode:variant,country:variant>"
_VALUES = {
    "valueQuantity": fhir.QUANTITY,
    "valueCodeableConcept": fhir.CODEABLE_CONCEPT,
    "valueString": "string",
    "valueBoolean": "variant",
    "valueInteger": "variant",
    "valueDateTime": "string",
}
_COMPONENT = "struct<" + ",".join(f"{k}:{v}" for k, v in ({"code": fhir.CODEABLE_CONCEPT} | _VALUES).items()) + ">"


def as_resources(bronze: DataFrame | TypedDataFrame) -> DataFrame:
    """Lineage columns plus ``resource``, also from a frame with one column per JSON field."""
    bronze = plain(bronze)
    lineage = [bronze[name] if name in bronze.columns else F.lit(None).cast("string").alias(name) for name in LINEAGE]
    if "resource" in bronze.columns and isinstance(bronze.schema["resource"].dataType, T.VariantType):
        return bronze.select(*lineage, "resource")
    fields = F.struct(*[bronze[name] for name in bronze.columns if name not in LINEAGE])
    return bronze.select(*lineage, F.to_variant_object(fields).alias("resource"))


def _read_fields(bronze: DataFrame | TypedDataFrame, fields: dict[str, tuple[str, str]], at_once: bool) -> DataFrame:
    """The JSON fields by name, from their paths with their types.

    A stored variant is shredded, and each path read from it is a Parquet column of its own. A variant that was
    just parsed is walked once for each path, so all fields are taken ``at_once``, as one struct.
    """
    resources = as_resources(bronze)
    if not at_once:
        read = [f"try_variant_get(resource, '$.{path}', '{ddl}') AS {name}" for name, (path, ddl) in fields.items()]
        return resources.selectExpr("_source_file AS source_file", "_source_bundle AS source_bundle", *read)
    whole = resources.selectExpr("_source_file", "_source_bundle", f"try_variant_get(resource, '$', '{_shape(fields.values())}') AS fields")
    read = [f"fields.{path} AS {name}" for name, (path, _) in fields.items()]
    return whole.selectExpr("_source_file AS source_file", "_source_bundle AS source_bundle", *read)


def _shape(fields: Iterable[tuple[str, str]]) -> str:
    """The struct that holds all paths with their types."""
    inner: dict[str, list[tuple[str, str]]] = {}
    for path, ddl in fields:
        head, _, rest = path.partition(".")
        inner.setdefault(head, []).append((rest, ddl))
    parts = [f"{head}:{below[0][1] if not below[0][0] else _shape(below)}" for head, below in inner.items()]
    return f"struct<{','.join(parts)}>"


# Derived columns do not depend on the frame, and making hundreds of them takes longer than a small job,
# so each set is made once.


def _contract(df: DataFrame, contract: type[TypedDataFrame], columns: dict[str, Column]) -> DataFrame:
    """Exactly the columns of the contract (but its validation errors), in its order."""
    names = [name for name in contract.as_spark_schema().names if name != "validation_errors"]
    return df.select(*[columns[name].alias(name) if name in columns else name for name in names])


def flatten_patient(bronze: DataFrame | TypedDataFrame, at_once: bool = False) -> DataFrame:
    fields = _read_fields(
        bronze,
        {
            "id": ("id", "string"),
            "birth_date": ("birthDate", "string"),
            "gender": ("gender", "string"),
            "name": ("name", f"array<{_NAME}>"),
            "telecom": ("telecom", f"array<{fhir.IDENTIFIER}>"),
            "address": ("address", f"array<{_ADDRESS}>"),
            "extension": ("extension", f"array<{fhir.EXTENSION}>"),
            "identifier": ("identifier", f"array<{fhir.IDENTIFIER}>"),
        },
        at_once,
    )
    return _contract(fields, C.Patient, _patient_columns())


@cache
def _patient_columns() -> dict[str, Column]:
    name, address, identifier = F.col("name"), F.col("address"), F.col("identifier")
    return {
        "family_name": fhir.extract_from_name_list(name, "family"),
        "given_names": fhir.extract_from_name_list(name, "given"),
        "full_name": fhir.extract_from_name_list(name, "text"),
        "phone": fhir.extract_telecom(F.col("telecom"), "phone"),
        "address_line": fhir.extract_address_field(address, "line"),
        "city": fhir.extract_address_field(address, "city"),
        "postal_code": fhir.extract_address_field(address, "postalCode"),
        "country": fhir.extract_address_field(address, "country"),
        "nationality_code": fhir.extract_extension_code(F.col("extension"), C.NATIONALITY_EXTENSION),
        "identifier_eci": fhir.extract_identifier(identifier, C.IDENTIFIER_ECI),
        "identifier_mr": fhir.extract_identifier(identifier, C.IDENTIFIER_MR),
    }


def flatten_condition(bronze: DataFrame | TypedDataFrame, at_once: bool = False) -> DataFrame:
    fields = _read_fields(
        bronze,
        {
            "id": ("id", "string"),
            "subject_reference": ("subject.reference", "string"),
            "patient_display": ("subject.display", "string"),
            "category": ("category", f"array<{fhir.CODEABLE_CONCEPT}>"),
            "concept": ("code", fhir.CODEABLE_CONCEPT),
            "onset": ("onsetDateTime", "string"),
            "onset_extra": ("_onsetDateTime.value", "string"),
            "abatement": ("abatementDateTime", "string"),
            "abatement_extra": ("_abatementDateTime.value", "string"),
            "asserter_display": ("asserter.display", "string"),
        },
        at_once,
    )
    shared, columns = _condition_columns()
    return _contract(fields.withColumns(shared), C.Condition, columns)


@cache
def _condition_columns() -> tuple[dict[str, Column], dict[str, Column]]:
    """What several columns use, and the columns."""
    shared = {
        "category_coding": fhir.extract_category_from_list(F.col("category")),
        "coding": fhir.extract_first_coding(F.col("concept")),
    }
    return shared, {
        "patient_id": fhir.extract_reference_id(F.col("subject_reference")),
        "category_code": F.col("category_coding.code"),
        "category_display": F.col("category_coding.display"),
        "code_system": F.col("coding.system"),
        "code": F.col("coding.code"),
        "code_display": F.col("coding.display"),
        # Empty text is kept here, unlike in observations.
        "code_text": F.col("concept.text"),
        "onset_date": F.coalesce("onset", "onset_extra"),
        "abatement_date": F.coalesce("abatement", "abatement_extra"),
    }


def value_type(field: Callable[[str], Column]) -> Column:
    """Which value is present, by precedence; an empty object counts as present."""
    return (
        F.when(field("valueQuantity").isNotNull(), "quantity")
        .when(field("valueCodeableConcept").isNotNull(), "codeable_concept")
        .when(field("valueString").isNotNull(), "string")
        .when(fhir.is_present(field("valueBoolean")), "boolean")
        .when(fhir.is_present(field("valueInteger")), "integer")
        .when(field("valueDateTime").isNotNull(), "datetime")
    )


def value_columns(field: Callable[[str], Column]) -> dict[str, Column]:
    """The value columns of an observation or a component; ``field`` gives its JSON fields."""
    quantity, concept = field("valueQuantity"), field("valueCodeableConcept")
    coding = fhir.extract_first_coding(concept)
    return {
        "value_type": value_type(field),
        "value_quantity_value": fhir.float_value(quantity.value),
        "value_quantity_unit": quantity.unit,
        "value_quantity_system": quantity.system,
        "value_quantity_code": quantity.code,
        "value_codeable_concept_text": fhir.extract_code_text(concept),
        "value_codeable_concept_system": coding.system,
        "value_codeable_concept_code": coding.code,
        "value_codeable_concept_display": coding.display,
        "value_string": field("valueString"),
        "value_boolean": fhir.boolean_value(field("valueBoolean")),
        "value_integer": fhir.integer_value(field("valueInteger")),
        "value_datetime": field("valueDateTime"),
    }


def effective_datetime(at: list[Column], start: Column, end: Column) -> Column:
    """First non-empty moment, else the period as ``start/end``, its start or its end."""
    period = F.concat_ws("/", fhir.non_empty(start), fhir.non_empty(end))
    return F.coalesce(*[fhir.non_empty(moment) for moment in at], fhir.non_empty(period))


def category_codings(categories: Column) -> Column:
    """All codings of all categories, with the position of their category."""

    def of_category(category: Column, index: Column) -> Column:
        return F.transform(
            fhir.iter_codings(category),
            lambda coding: F.struct(index.cast("long").alias("category_index"), coding.system, coding.code, coding.display),
        )

    return F.flatten(F.transform(categories, of_category))


def _component_columns(component: Column, index: Column) -> dict[str, Column]:
    coding = fhir.extract_first_coding(component.code)
    return {
        "component_index": index.cast("long"),
        "code_text": fhir.extract_code_text(component.code),
        "code_system": coding.system,
        "code_code": coding.code,
        "code_display": coding.display,
    } | value_columns(lambda name: component[name])


def _component_row(component: Column, index: Column) -> Column:
    return F.struct(*[column.alias(name) for name, column in _component_columns(component, index).items()])


def flatten_components(bronze: DataFrame | TypedDataFrame) -> DataFrame:
    """A row for each component of an observation, with the observation's id: the rows of ``components``.

    Components become rows before their columns are made, so that these are generated code and no lambda, which
    would be interpreted.
    """
    fields = _read_fields(bronze, {"id": ("id", "string"), "component": ("component", f"array<{_COMPONENT}>")}, False)
    # The outer form, because the optimiser filters on the array before a plain explode, and would read it twice.
    rows = fields.select("id", F.posexplode_outer(F.array_compact("component")).alias("component_index", "component"))
    return rows.where("component IS NOT NULL").select("id", *_columns_of_components())


@cache
def _columns_of_components() -> tuple[Column, ...]:
    columns = _component_columns(F.col("component"), F.col("component_index"))
    return tuple(column.alias(name) for name, column in columns.items())


def flatten_observation(bronze: DataFrame | TypedDataFrame, at_once: bool = False) -> DataFrame:
    fields = _read_fields(
        bronze,
        {
            "id": ("id", "string"),
            "status": ("status", "string"),
            "issued": ("issued", "string"),
            "reference": ("subject.reference", "string"),
            "at": ("effectiveDateTime", "string"),
            "at_instant": ("effectiveInstant", "string"),
            "at_time": ("effectiveTime", "string"),
            "period_start": ("effectivePeriod.start", "string"),
            "period_end": ("effectivePeriod.end", "string"),
            "concept": ("code", fhir.CODEABLE_CONCEPT),
            "category": ("category", f"array<{fhir.CODEABLE_CONCEPT}>"),
            "performer": ("performer", f"array<{fhir.REFERENCE}>"),
            "component": ("component", f"array<{_COMPONENT}>"),
        }
        | {name: (name, ddl) for name, ddl in _VALUES.items()},
        at_once,
    )
    shared, columns = _observation_columns()
    fields = fields.withColumns(shared).withColumn("category_coding", fhir.extract_first_coding(fhir.first(F.col("category"))))
    return _contract(fields, C.Observation, columns)


@cache
def _observation_columns() -> tuple[dict[str, Column], dict[str, Column]]:
    """What several columns use, and the columns."""
    concept, categories = F.col("concept"), F.col("category")
    shared = {
        "category": fhir.iter_dict_list(categories),
        "component": fhir.iter_dict_list(F.col("component")),
        "coding": fhir.extract_first_coding(concept),
        "reference": fhir.non_empty(F.col("reference")),
        "performer_references": F.array_compact(
            F.transform(fhir.iter_dict_list(F.col("performer")), fhir.extract_reference)
        ),
    }
    coding, category_coding = F.col("coding"), F.col("category_coding")
    columns = {
        "subject_reference": F.col("reference"),
        "subject_id": fhir.extract_reference_id(F.col("reference")),
        "effective_datetime": effective_datetime(
            [F.col("at"), F.col("at_instant"), F.col("at_time")], F.col("period_start"), F.col("period_end")
        ),
        "category_text": fhir.extract_code_text(fhir.first(categories)),
        "category_system": category_coding.system,
        "category_code": category_coding.code,
        "category_display": category_coding.display,
        "code_text": fhir.extract_code_text(concept),
        "code_system": coding.system,
        "code_code": coding.code,
        "code_display": coding.display,
        "performer_ids": F.array_compact(F.transform("performer_references", fhir.extract_reference_id)),
        "code_codings": fhir.iter_codings(concept),
        "category_codings": category_codings(categories),
        "components": F.transform(F.col("component"), _component_row),
        "component_count": F.size("component").cast("long"),
    }
    return shared, columns | value_columns(F.col)
