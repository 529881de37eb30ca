"""Row validation: every row is kept and carries the names of the rules it breaks."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caretiers import contracts as C
from caretiers.typed import TypedDataFrame, plain


@dataclass(frozen=True)
class Rule:
    """A named SQL predicate that holds for good rows. Where it is null the row passes."""

    name: str
    check: str
    description: str


def _one_of(column: str, values: Sequence[str]) -> str:
    return f"{column} in ({', '.join(repr(value) for value in values)})"


def _date(column: str) -> Rule:
    # \z, because $ also matches before a final line break.
    check = rf"{column} is null or {column} rlike r'\A\p{{Nd}}{{4}}-\p{{Nd}}{{2}}-\p{{Nd}}{{2}}\z'"
    return Rule(f"{column}_format", check, f"{column} is written YYYY-MM-DD")


_ANY_VALUE = " or ".join(
    f"value_{kind} is not null"
    for kind in ("quantity_value", "codeable_concept_code", "string", "boolean", "integer", "datetime")
)

PATIENT_RULES = [
    Rule("id_required", "id is not null", "a patient has an id"),
    _date("birth_date"),
    Rule("gender_valid", f"gender is null or {_one_of('gender', C.GENDERS)}", "gender is a known code"),
    Rule("phone_format", r"phone is null or phone rlike r'\p{Nd}'", "a phone number has a digit"),
    Rule("has_name", "coalesce(family_name, given_names, full_name) is not null", "a patient has a name"),
]

CONDITION_RULES = [
    Rule("id_required", "id is not null", "a condition has an id"),
    Rule("code_required", "code is not null", "a condition has a diagnosis code"),
    Rule("code_display_required", "code_display is not null", "the diagnosis has a display name"),
    Rule("patient_id_required", "patient_id is not null", "a condition belongs to a patient"),
    _date("onset_date"),
    _date("abatement_date"),
    Rule(
        "valid_code_system",
        f"code_system is null or code_system = '{C.SYSTEMS['snomed_ct']}'",
        "the diagnosis is a SNOMED CT code",
    ),
]

OBSERVATION_RULES = [
    Rule("id_required", "id is not null", "an observation has an id"),
    Rule("status_required", "status is not null", "an observation has a status"),
    Rule("status_valid", _one_of("status", C.OBSERVATION_STATUSES), "the status is a known code"),
    Rule("code_present", "code_code is not null or code_text is not null", "what was observed is given"),
    Rule("subject_present", "subject_reference is not null", "an observation has a subject"),
    Rule(
        "effective_format",
        r"effective_datetime is null or effective_datetime rlike r'\A\p{Nd}{4}-\p{Nd}{2}-\p{Nd}{2}'",
        "the time starts with YYYY-MM-DD",
    ),
    Rule("has_value_or_components", f"{_ANY_VALUE} or component_count > 0", "there is a value or a component"),
    Rule(
        "quantity_unit_if_value",
        "value_quantity_value is null or value_quantity_unit is not null",
        "a quantity has a unit",
    ),
    Rule(
        "quantity_value_finite",
        "value_quantity_value is null or (not isnan(value_quantity_value)"
        " and abs(value_quantity_value) < double('infinity'))",
        "a quantity is a finite number",
    ),
]


def is_finite(column: Column) -> Column:
    """Neither NaN nor infinite; null stays null."""
    return F.when(column.isNotNull(), ~F.isnan(column) & (F.abs(column) < float("inf")))


def failed_rules(rules: Sequence[Rule]) -> Column:
    """Array of the names of the broken rules, in rule order."""
    failed = ", ".join(f"CASE WHEN NOT ({rule.check}) THEN '{rule.name}' END" for rule in rules)
    return F.expr(f"array_compact(array({failed}))")


def with_validation_errors(df: DataFrame | TypedDataFrame, rules: Sequence[Rule]) -> DataFrame:
    return plain(df).withColumn("validation_errors", failed_rules(rules))


def _model(df: DataFrame | TypedDataFrame, contract: type[TypedDataFrame], rules: Sequence[Rule]) -> TypedDataFrame:
    checked = with_validation_errors(df, rules)
    return contract.from_df(checked.select(*contract.as_spark_schema().names))


def validate_patient(sources: DataFrame | TypedDataFrame) -> C.Patient:
    return _model(sources, C.Patient, PATIENT_RULES)


def validate_condition(sources: DataFrame | TypedDataFrame) -> C.Condition:
    return _model(sources, C.Condition, CONDITION_RULES)


def validate_observation(sources: DataFrame | TypedDataFrame) -> C.Observation:
    return _model(sources, C.Observation, OBSERVATION_RULES)
