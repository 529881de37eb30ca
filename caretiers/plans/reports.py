"""Completeness and validity reports. Each is one pass over the data."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from caretiers.operators.validation import CONDITION_RULES, OBSERVATION_RULES, PATIENT_RULES
from caretiers.typed import TypedDataFrame, plain

Frame = DataFrame | TypedDataFrame


def _present(**columns: str) -> dict[str, str]:
    return {name: f"{column} IS NOT NULL" for name, column in columns.items()}


def _patient_fields() -> dict[str, str]:
    return _present(
        with_family_name="family_name",
        with_given_names="given_names",
        with_birth_date="birth_date",
        with_gender="gender",
        with_phone="phone",
        with_city="city",
        with_nationality="nationality_code",
    )


def _condition_fields() -> dict[str, str]:
    return _present(
        with_patient_id="patient_id",
        with_code="code",
        with_code_display="code_display",
        with_onset_date="onset_date",
        with_category="category_code",
    )


def _observation_fields() -> dict[str, str]:
    fields = _present(
        with_status="status",
        with_subject="subject_reference",
        with_code="code_code",
        with_effective_datetime="effective_datetime",
        with_value="value_type",
    )
    return fields | {
        "with_components": "component_count > 0",
        "with_performers": "size(performer_references) > 0",
    }


def _json_fields(**paths: str) -> dict[str, str]:
    # A JSON null is a variant, not an SQL null.
    field = "try_variant_get(resource, '$.{0}', 'variant')"
    present = f"{field} IS NOT NULL AND NOT is_variant_null({field})"
    return {name: present.format(path) for name, path in paths.items()}


def _counts(fields: Mapping[str, str]) -> list[Column]:
    return [F.expr(f"count_if({condition}) AS {name}") for name, condition in fields.items()]


def _summary(df: Frame, total: str, fields: Mapping[str, str]) -> DataFrame:
    return plain(df).agg(F.count("*").alias(total), *_counts(fields))


def patient_summary(patients: Frame) -> DataFrame:
    return _summary(patients, "total_patients", _patient_fields())


def condition_summary(conditions: Frame) -> DataFrame:
    return _summary(conditions, "total_conditions", _condition_fields())


def observation_summary(observations: Frame) -> DataFrame:
    return _summary(observations, "total_observations", _observation_fields())


def bronze_patient_summary(bronze: DataFrame) -> DataFrame:
    fields = _json_fields(
        with_name="name", with_birth_date="birthDate", with_gender="gender", with_telecom="telecom", with_address="address"
    )
    return _summary(bronze, "total_patients", fields)


def bronze_condition_summary(bronze: DataFrame) -> DataFrame:
    fields = _json_fields(
        with_subject="subject",
        with_code="code",
        with_category="category",
        with_onset="onsetDateTime",
        with_clinical_status="clinicalStatus",
    )
    return _summary(bronze, "total_conditions", fields)


def bronze_observation_summary(bronze: DataFrame) -> DataFrame:
    fields = _json_fields(
        with_status="status",
        with_subject="subject",
        with_code="code",
        with_effective="effectiveDateTime",
        with_value_quantity="valueQuantity",
        with_components="component",
    )
    return _summary(bronze, "total_observations", fields)


def quality_percentages(summary: DataFrame) -> DataFrame:
    """A one-row summary as rows of ``field``, ``count`` and ``pct`` of the total, its first column."""
    total, *fields = summary.columns
    share = F.when(F.col(total) > 0, F.col("count") / F.col(total) * 100).otherwise(0.0)
    return summary.unpivot([total], fields, "field", "count").select("field", "count", share.alias("pct"))


def valid_records(validated: Frame) -> DataFrame:
    """Rows that break no rule."""
    return plain(validated).where(F.size("validation_errors") == 0)


def validation_summary(validated: Frame) -> DataFrame:
    """Rows per broken rule, most frequent first."""
    errors = plain(validated).select(F.explode("validation_errors").alias("error")).where("error is not null")
    return errors.groupBy("error").agg(F.count("*").alias("count")).orderBy(F.desc("count"), "error")


def _report(validated: Frame, total: str, fields: Mapping[str, str]) -> DataFrame:
    # Rows that break the same rules are counted together; there are few such combinations, so
    # everything after the first grouping is small.
    field_names = list(fields)
    combinations = (
        plain(validated)
        .groupBy("validation_errors")
        .agg(F.count("*").alias("n"), *_counts(fields))
    )
    # A missing list of errors counts in the totals and is not valid.
    broken = F.coalesce(F.array_compact("validation_errors"), F.array().cast("array<string>"))
    # One line per combination for the totals (no error), and one per broken rule.
    lines = combinations.select(
        "n",
        *field_names,
        F.coalesce(F.size("validation_errors") == 0, F.lit(False)).alias("is_valid"),
        F.explode(F.concat(F.array(F.lit(None).cast("string")), broken)).alias("error"),
    )
    per_error = lines.groupBy("error").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("is_valid"), F.col("n")).otherwise(0)).alias("valid"),
        *[F.sum(name).alias(name) for name in field_names],
    )
    is_total = F.col("error").isNull()

    def total_of(column: str) -> Column:
        return F.coalesce(F.sum(F.when(is_total, F.col(column))), F.lit(0))

    error = F.when(~is_total, F.struct((-F.col("n")).alias("order"), "error", F.col("n").alias("count")))
    report = per_error.agg(
        total_of("n").alias(total),
        *[total_of(name).alias(name) for name in field_names],
        total_of("valid").alias("valid_records"),
        F.sort_array(F.collect_list(error)).alias("errors"),
    )
    invalid = F.col(total) - F.col("valid_records")
    rate = F.when(F.col(total) > 0, F.col("valid_records") / F.col(total)).otherwise(0.0)
    by_rule = F.transform("errors", lambda e: F.struct(e.error.alias("error"), e["count"].alias("count")))
    return report.select(
        total,
        *field_names,
        "valid_records",
        invalid.alias("invalid_records"),
        rate.alias("validity_rate"),
        by_rule.alias("errors_by_rule"),
    )


#: Of each silver frame: the column of its total, its fields, its rules.
_REPORTED = {
    "patient": ("total_patients", _patient_fields, PATIENT_RULES),
    "condition": ("total_conditions", _condition_fields, CONDITION_RULES),
    "observation": ("total_observations", _observation_fields, OBSERVATION_RULES),
}


def observed(name: str, validated: Frame) -> tuple[DataFrame, Callable[[], dict[str, object]]]:
    """A silver frame, by its name, whose report is collected while its rows go by.

    The function gives the report's columns and values, as ``patient_report`` and the like do, once the frame
    has been written. It counts each rule of the frame, so it has no rules of other frames.
    """
    total, fields, rules = _REPORTED[name]
    seen = Observation()
    broken = "array_contains(validation_errors, '{0}')"
    metrics = _counts(fields() | {"valid_records": "size(validation_errors) = 0"} | {f"broken_{r.name}": broken.format(r.name) for r in rules})
    frame = plain(validated).observe(seen, F.count("*").alias(total), *metrics)

    def report() -> dict[str, object]:
        found = seen.get
        rows, valid = found[total], found["valid_records"]
        errors = [(-found[f"broken_{r.name}"], r.name) for r in rules if found[f"broken_{r.name}"]]
        return {total: rows, **{field: found[field] for field in fields()}} | {
            "valid_records": valid,
            "invalid_records": rows - valid,
            "validity_rate": valid / rows if rows else 0.0,
            "errors_by_rule": [{"error": rule, "count": -n} for n, rule in sorted(errors)],
        }

    return frame, report


def validation_report(validated: Frame) -> DataFrame:
    """One row: ``total_records``, ``valid_records``, ``invalid_records``, ``validity_rate`` (0 for
    no rows) and ``errors_by_rule``, an array of (error, count), most frequent first."""
    return _report(validated, "total_records", {})


def patient_report(patients: Frame) -> DataFrame:
    """Summary and validation report in one row, from one pass."""
    return _report(patients, "total_patients", _patient_fields())


def condition_report(conditions: Frame) -> DataFrame:
    return _report(conditions, "total_conditions", _condition_fields())


def observation_report(observations: Frame) -> DataFrame:
    return _report(observations, "total_observations", _observation_fields())
