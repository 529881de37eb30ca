"""Columns of the silver and gold tables, and the code lists of the validation rules."""

from __future__ import annotations

import datetime
from enum import StrEnum
from typing import TypedDict

from caretiers.typed import Col, TypedDataFrame


class Schema(StrEnum):
    """Databases of the three layers."""

    BRONZE = "bronze"
    SILVER = "silver"
    GOLD = "gold"


# FHIR code lists and URIs.
OBSERVATION_STATUSES = [
    "registered", "preliminary", "final", "amended", "corrected", "cancelled", "entered-in-error", "unknown",
]
OBSERVATION_CATEGORIES = [
    "vital-signs", "laboratory", "imaging", "procedure", "survey", "exam", "therapy", "activity", "social-history",
]
CONDITION_CATEGORIES = ["problem-list-item", "encounter-diagnosis"]
CONDITION_CLINICAL_STATUSES = ["active", "recurrence", "relapse", "inactive", "remission", "resolved"]
CONDITION_VERIFICATION_STATUSES = [
    "unconfirmed", "provisional", "differential", "confirmed", "refuted", "entered-in-error",
]
GENDERS = ["male", "female", "other", "unknown"]
VALUE_TYPES = ["quantity", "codeable_concept", "string", "boolean", "integer", "datetime"]
SYSTEMS = {
    "loinc": "http://loinc.org",
    "snomed_ct": "http://snomed.info/sct",
    "icd_10": "http://hl7.org/fhir/sid/icd-10",
    "icd_10_cm": "http://hl7.org/fhir/sid/icd-10-cm",
    "ucum": "http://unitsofmeasure.org",
    "observation_category": "http://terminology.hl7.org/CodeSystem/observation-category",
    "condition_category": "http://terminology.hl7.org/CodeSystem/condition-category",
}
IDENTIFIER_ECI = "http://ec.europa.eu/identifier/eci"
IDENTIFIER_MR = "http://local.setting.eu/identifier"
NATIONALITY_EXTENSION = "http://hl7.org/fhir/StructureDefinition/patient-nationality"



class Coding(TypedDict):
    system: str | None
    code: str | None
    display: str | None


class CategoryCoding(TypedDict):
    category_index: int | None
    system: str | None
    code: str | None
    display: str | None


class Component(TypedDict):
    component_index: int | None
    code_text: str | None
    code_system: str | None
    code_code: str | None
    code_display: str | None
    value_type: str | None
    value_quantity_value: float | None
    value_quantity_unit: str | None
    value_quantity_system: str | None
    value_quantity_code: str | None
    value_codeable_concept_text: str | None
    value_codeable_concept_system: str | None
    value_codeable_concept_code: str | None
    value_codeable_concept_display: str | None
    value_string: str | None
    value_boolean: bool | None
    value_integer: int | None
    value_datetime: str | None


class Patient(TypedDataFrame):
    id: Col[str]
    source_file: Col[str]
    source_bundle: Col[str]
    family_name: Col[str | None]
    given_names: Col[str | None]
    full_name: Col[str | None]
    birth_date: Col[str | None]
    gender: Col[str | None]
    phone: Col[str | None]
    address_line: Col[str | None]
    city: Col[str | None]
    postal_code: Col[str | None]
    country: Col[str | None]
    nationality_code: Col[str | None]
    identifier_eci: Col[str | None]
    identifier_mr: Col[str | None]
    validation_errors: Col[list[str]]


class Condition(TypedDataFrame):
    id: Col[str]
    source_file: Col[str]
    source_bundle: Col[str]
    patient_id: Col[str | None]
    patient_display: Col[str | None]
    category_code: Col[str | None]
    category_display: Col[str | None]
    code_system: Col[str | None]
    code: Col[str | None]
    code_display: Col[str | None]
    code_text: Col[str | None]
    onset_date: Col[str | None]
    abatement_date: Col[str | None]
    asserter_display: Col[str | None]
    validation_errors: Col[list[str]]


class Observation(TypedDataFrame):
    """First codings are columns of their own; all codings and components stay arrays."""

    id: Col[str]
    source_file: Col[str]
    source_bundle: Col[str]
    status: Col[str | None]
    subject_reference: Col[str | None]
    subject_id: Col[str | None]
    effective_datetime: Col[str | None]
    issued: Col[str | None]
    category_text: Col[str | None]
    category_system: Col[str | None]
    category_code: Col[str | None]
    category_display: Col[str | None]
    code_text: Col[str | None]
    code_system: Col[str | None]
    code_code: Col[str | None]
    code_display: Col[str | None]
    value_type: Col[str | None]
    value_quantity_value: Col[float | None]
    value_quantity_unit: Col[str | None]
    value_quantity_system: Col[str | None]
    value_quantity_code: Col[str | None]
    value_codeable_concept_text: Col[str | None]
    value_codeable_concept_system: Col[str | None]
    value_codeable_concept_code: Col[str | None]
    value_codeable_concept_display: Col[str | None]
    value_string: Col[str | None]
    value_boolean: Col[bool | None]
    value_integer: Col[int | None]
    value_datetime: Col[str | None]
    performer_references: Col[list[str]]
    performer_ids: Col[list[str]]
    code_codings: Col[list[Coding]]
    category_codings: Col[list[CategoryCoding]]
    components: Col[list[Component]]
    component_count: Col[int]
    validation_errors: Col[list[str]]


class ObservationsPerPatient(TypedDataFrame):
    patient_id: Col[str | None]
    observation_count: Col[int]
    birth_date: Col[datetime.date | None]
    patient_age_years: Col[int | None]
