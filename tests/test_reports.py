import pytest

from caretiers.plans import reports


@pytest.fixture
def validated(spark):
    rows = [
        (1, []), (2, ["a"]), (3, ["a", "b"]), (4, ["b"]), (5, ["a"]), (6, []),
    ]
    return spark.createDataFrame(rows, "id int, validation_errors array<string>")


def test_rows_without_a_list_of_errors_count_but_are_not_valid(spark):
    rows = spark.createDataFrame([(1, None), (2, []), (3, ["a", None])], "id int, validation_errors array<string>")
    report = reports.validation_report(rows).first().asDict(recursive=True)
    assert report["total_records"] == 3 and report["valid_records"] == 1 and report["invalid_records"] == 2
    assert report["errors_by_rule"] == [{"error": "a", "count": 1}]


def test_validation_summary(validated):
    assert [tuple(row) for row in reports.validation_summary(validated).collect()] == [("a", 3), ("b", 2)]


def test_valid_records(validated):
    assert sorted(row.id for row in reports.valid_records(validated).collect()) == [1, 6]


def test_validation_report(validated):
    rows = reports.validation_report(validated).collect()
    assert len(rows) == 1
    assert rows[0].asDict(recursive=True) == {
        "total_records": 6,
        "valid_records": 2,
        "invalid_records": 4,
        "validity_rate": 2 / 6,
        "errors_by_rule": [{"error": "a", "count": 3}, {"error": "b", "count": 2}],
    }


def test_validation_report_of_nothing(validated):
    row = reports.validation_report(validated.limit(0)).first().asDict()
    assert row == {"total_records": 0, "valid_records": 0, "invalid_records": 0, "validity_rate": 0.0, "errors_by_rule": []}


def test_quality_percentages(spark):
    summary = spark.createDataFrame([(8, 8, 2, 0)], "total bigint, a bigint, b bigint, c bigint")
    assert {tuple(row) for row in reports.quality_percentages(summary).collect()} == {("a", 8, 100.0), ("b", 2, 25.0), ("c", 0, 0.0)}
    empty = spark.createDataFrame([(0, 0)], "total bigint, a bigint")
    assert [tuple(row) for row in reports.quality_percentages(empty).collect()] == [("a", 0, 0.0)]


def test_bronze_summaries_count_present_fields(resources):
    bronze = resources('{"name":[],"gender":"x","subject":{},"code":null}', '{"name":null,"birthDate":"","status":1}', "{}")
    patient = reports.bronze_patient_summary(bronze).first().asDict()
    assert patient == {
        "total_patients": 3, "with_name": 1, "with_birth_date": 1, "with_gender": 1, "with_telecom": 0, "with_address": 0,
    }
    assert reports.bronze_condition_summary(bronze).first().asDict()["with_code"] == 0
    assert reports.bronze_observation_summary(bronze).first().asDict()["with_status"] == 1
