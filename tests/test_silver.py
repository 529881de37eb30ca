import json

from pyspark.sql import functions as F

from caretiers.contracts import Condition, Observation, Patient
from caretiers.operators.flatten import flatten_components, flatten_condition, flatten_observation, flatten_patient
from caretiers.operators.validation import validate_condition, validate_observation, validate_patient

SPIROMETRY = {
    "resourceType": "Observation",
    "id": "lung-77",
    "status": "amended",
    "category": [{"coding": [{"system": "urn:cat", "code": "procedure", "display": "Procedure"}, {"code": "local"}]}],
    "code": {"text": "Spirometry", "coding": [{"system": "urn:tests", "code": "FEV-FVC", "display": "Ratio"}, {"code": "alt"}]},
    "subject": {"reference": "Patient/anna"},
    "performer": [{"reference": "Organization/lab"}, {"reference": "Practitioner/otto"}],
    "effectiveDateTime": "2022-11-30",
    "valueQuantity": {"value": 81, "unit": "%", "system": "urn:units", "code": "pct"},
    "component": [
        {"code": {"coding": [{"system": "urn:tests", "code": "FEV1"}]}, "valueQuantity": {"value": 3, "unit": "L"}},
        {"code": {"coding": [{"system": "urn:tests", "code": "FVC"}]}, "valueQuantity": {"value": 4, "unit": "L"}},
    ],
}
UNUSABLE = {"resourceType": "Observation", "id": "lung-78", "status": "maybe", "code": {"coding": []}, "component": []}


def observe(resources, *rows):
    frame = validate_observation(flatten_observation(resources(*map(json.dumps, rows))))
    return [row.asDict(recursive=True) for row in frame.collect()]


def one(resources, **fields):
    return observe(resources, {"resourceType": "Observation", **fields})[0]


def test_all_parts_of_an_observation(resources):
    row = observe(resources, SPIROMETRY)[0]
    assert list(row) == Observation.as_spark_schema().names
    assert (row["code_code"], row["subject_id"], row["performer_ids"]) == ("FEV-FVC", "anna", ["lab", "otto"])
    assert (row["value_type"], row["value_quantity_value"], row["component_count"]) == ("quantity", 81.0, 2)
    assert [c["code"] for c in row["code_codings"]] == ["FEV-FVC", "alt"]
    assert [(c["code"], c["category_index"]) for c in row["category_codings"]] == [("procedure", 0), ("local", 0)]
    parts = [(c["code_code"], c["value_type"], c["value_quantity_value"], c["component_index"]) for c in row["components"]]
    assert parts == [("FEV1", "quantity", 3.0, 0), ("FVC", "quantity", 4.0, 1)]
    assert row["validation_errors"] == []


def test_broken_rules_in_order(resources):
    assert observe(resources, UNUSABLE)[0]["validation_errors"] == [
        "status_valid", "code_present", "subject_present", "has_value_or_components",
    ]


def test_same_rows_from_a_nested_frame(spark, resources):
    schema = """resourceType string, id string, _source_file string, _source_bundle string, status string,
        subject struct<reference string>, effectiveDateTime string, performer array<struct<reference string>>,
        category array<struct<coding array<struct<system string, code string, display string>>>>,
        code struct<text string, coding array<struct<system string, code string, display string>>>,
        valueQuantity struct<value bigint, unit string, system string, code string>, valueBoolean boolean,
        component array<struct<code struct<coding array<struct<system string, code string>>>,
        valueQuantity struct<value bigint, unit string>>>"""
    nested = spark.createDataFrame([SPIROMETRY | {"_source_file": "f.json", "_source_bundle": "b"}], schema)
    expected = observe(resources, SPIROMETRY)
    assert [row.asDict(recursive=True) for row in validate_observation(flatten_observation(nested)).collect()] == expected


def test_effective_datetime(resources):
    rows = [
        {"effectiveDateTime": "", "effectiveInstant": "2020-01-01T00:00:00Z", "effectiveTime": "x"},
        {"effectiveTime": "t", "effectivePeriod": {"start": "a"}},
        {"effectivePeriod": {"start": "a", "end": "b"}},
        {"effectivePeriod": {"start": "", "end": "b"}},
        {"effectivePeriod": {"start": "a", "end": ""}},
        {"effectivePeriod": {"start": "", "end": None}},
        {"effectivePeriod": "a"},
    ]
    found = [row["effective_datetime"] for row in observe(resources, *rows)]
    assert found == ["2020-01-01T00:00:00Z", "t", "a/b", "b", "a", None, None]


def test_value_precedence_and_exact_types(resources):
    rows = [
        {"valueQuantity": {}, "valueString": "s"},
        {"valueQuantity": None, "valueCodeableConcept": {}},
        {"valueQuantity": [], "valueString": ""},
        {"valueBoolean": False, "valueInteger": 3},
        {"valueBoolean": "true"},
        {"valueInteger": 3.5},
        {"valueInteger": "3"},
        {"valueDateTime": "2020"},
        {"valueBoolean": None},
    ]
    found = [
        (row["value_type"], row["value_string"], row["value_boolean"], row["value_integer"], row["value_datetime"])
        for row in observe(resources, *rows)
    ]
    assert found == [
        ("quantity", "s", None, None, None),
        ("codeable_concept", None, None, None, None),
        ("string", "", None, None, None),
        ("boolean", None, False, 3, None),
        ("boolean", None, None, None, None),
        ("integer", None, None, None, None),
        ("integer", None, None, None, None),
        ("datetime", None, None, None, "2020"),
        (None, None, None, None, None),
    ]


def test_whole_numbers(resources):
    values = [9223372036854775807, -1, 3.0, 3.25, 1e3, 99999999999999999999, "3", True, None]
    found = [row["value_integer"] for row in observe(resources, *[{"valueInteger": v} for v in values])]
    assert found == [9223372036854775807, -1, 3, None, 1000, None, None, None, None]


def test_quantity_values(resources):
    values = [1, 1.5, "120.5", " 7 ", "1e3", "1_000", "x", "12d", "0x10", "", None, [1], {"a": 1}, "-.5", "5.", True]
    found = [row["value_quantity_value"] for row in observe(resources, *[{"valueQuantity": {"value": v}} for v in values])]
    assert found == [1.0, 1.5, 120.5, 7.0, 1000.0, 1000.0, None, None, None, None, None, None, None, -0.5, 5.0, 1.0]
    infinite = one(resources, valueQuantity={"value": "Infinity", "unit": "u"})
    assert "quantity_value_finite" in infinite["validation_errors"]
    assert "quantity_unit_if_value" in one(resources, valueQuantity={"value": 1})["validation_errors"]


def test_lists_keep_only_objects(resources):
    row = one(
        resources,
        category=["x", None, {"text": "", "coding": [3, {"code": "a"}, {"code": "b"}]}, {"text": "t", "coding": {"code": "no list"}}, {"coding": [{}]}],
        code={"text": "", "coding": [None, "x", {"display": "d"}, {"code": "c"}]},
        performer=[{"reference": ""}, {"reference": "urn:uuid:"}, "x", {"reference": "A/b/"}, {"reference": "A/b"}],
        component=[None, "x", {"valueString": "one"}, {"code": {"text": "two"}, "valueBoolean": True, "valueInteger": 4}],
    )
    assert row["category_codings"] == [
        {"category_index": 0, "system": None, "code": "a", "display": None},
        {"category_index": 0, "system": None, "code": "b", "display": None},
        {"category_index": 2, "system": None, "code": None, "display": None},
    ]
    assert (row["category_text"], row["category_code"]) == (None, "a")
    assert (row["code_text"], row["code_code"], row["code_display"]) == (None, None, "d")
    assert row["performer_references"] == ["urn:uuid:", "A/b/", "A/b"]
    assert row["performer_ids"] == ["b"]
    assert row["component_count"] == 2
    assert [(c["component_index"], c["code_text"], c["value_type"], c["value_string"]) for c in row["components"]] == [
        (0, None, "string", "one"),
        (1, "two", "boolean", None),
    ]
    assert row["components"][1]["value_boolean"] is True and row["components"][1]["value_integer"] == 4


def test_absent_lists_are_empty_arrays(resources):
    row = one(resources, id="o")
    for name in ("performer_references", "performer_ids", "code_codings", "category_codings", "components"):
        assert row[name] == []
    assert row["component_count"] == 0
    assert row["validation_errors"] == ["status_required", "code_present", "subject_present", "has_value_or_components"]


def test_subject_and_effective_rules(resources):
    row = one(resources, id=None, status="final", code={"text": "x"}, subject={"reference": "urn:uuid:a/b"}, effectiveDateTime="01.02.2024", valueString="")
    assert row["subject_id"] == "a/b"
    assert row["validation_errors"] == ["id_required", "effective_format"]


def patients(resources, *rows):
    frame = validate_patient(flatten_patient(resources(*map(json.dumps, rows))))
    return [row.asDict() for row in frame.collect()]


def test_patient(resources):
    url = "http://hl7.org/fhir/StructureDefinition/patient-nationality"
    row = patients(
        resources,
        {
            "id": "p",
            "birthDate": "1990-02-03",
            "gender": "female",
            "name": [None, {"use": "x"}, {"family": "Doe", "given": ["A", "B"]}, {"text": "Full"}],
            "telecom": [{"system": "email", "value": "e"}, {"system": "phone", "value": "1"}, {"system": "phone", "value": "2"}],
            "address": [{"line": ["s1", "s2"], "city": "C"}, {"postalCode": "1", "country": "FI"}],
            "extension": [{"url": url}, {"url": url, "valueCodeableConcept": None}, {"url": url, "valueCodeableConcept": {"coding": []}},
                          {"url": url, "valueCodeableConcept": {"coding": [{"code": "FI"}, {"code": "SE"}]}}],
            "identifier": [{"system": "http://local.setting.eu/identifier", "value": "m"}, {"system": "http://ec.europa.eu/identifier/eci", "value": "e"}],
        },
    )[0]
    assert list(row) == Patient.as_spark_schema().names
    assert (row["family_name"], row["given_names"], row["full_name"], row["phone"]) == ("Doe", "A B", "Full", "1")
    assert (row["address_line"], row["city"], row["postal_code"], row["country"]) == ("s1, s2", "C", "1", "FI")
    assert (row["nationality_code"], row["identifier_eci"], row["identifier_mr"]) == ("FI", "e", "m")
    assert (row["source_file"], row["source_bundle"], row["validation_errors"]) == ("f.json", "b", [])


def test_patient_first_match_decides(resources):
    row = patients(
        resources,
        {
            "name": [{"family": "", "given": []}, {"family": "late", "given": ["late"]}],
            "telecom": [{"system": "phone"}, {"system": "phone", "value": "late"}],
            "address": "no list",
            "identifier": {"system": "x"},
        },
    )[0]
    assert (row["family_name"], row["given_names"], row["phone"]) == (None, "", None)
    assert (row["city"], row["identifier_mr"]) == (None, None)
    assert row["validation_errors"] == ["id_required"]


def test_patient_rules(resources):
    found = patients(
        resources,
        {"id": "a", "name": [{"text": "t"}], "birthDate": "1990-2-3", "gender": "Male", "telecom": [{"system": "phone", "value": "none"}]},
        {"id": "b", "name": [{"text": "t"}], "birthDate": "1990-02-03\n", "gender": None, "telecom": [{"system": "phone", "value": "٣"}]},
        {"id": "c"},
    )
    assert [row["validation_errors"] for row in found] == [
        ["birth_date_format", "gender_valid", "phone_format"],
        ["birth_date_format"],
        ["has_name"],
    ]


def test_condition(resources):
    rows = [
        {
            "id": "c",
            "subject": {"reference": "Patient/p", "display": "P"},
            "category": [{"coding": [{"display": "no code"}, {"code": "second"}]}, {"coding": ["x", {"code": "cat", "display": "Cat"}]}],
            "code": {"text": "", "coding": [{"system": "http://snomed.info/sct", "code": "1", "display": "One"}, {"code": "2"}]},
            "onsetDateTime": None,
            "_onsetDateTime": {"value": "2020-01-01"},
            "abatementDateTime": "2020-01-02",
            "_abatementDateTime": {"value": "2021-01-01"},
            "asserter": {"display": "Dr"},
        },
        {"subject": "x", "code": {"coding": [{"system": "http://other"}]}, "onsetDateTime": "", "abatementDateTime": "2020"},
    ]
    frame = validate_condition(flatten_condition(resources(*map(json.dumps, rows))))
    good, bad = [row.asDict() for row in frame.collect()]
    assert list(good) == Condition.as_spark_schema().names
    assert (good["patient_id"], good["patient_display"], good["category_code"], good["category_display"]) == ("p", "P", "cat", "Cat")
    assert (good["code_system"], good["code"], good["code_display"], good["code_text"]) == ("http://snomed.info/sct", "1", "One", "")
    assert (good["onset_date"], good["abatement_date"], good["asserter_display"]) == ("2020-01-01", "2020-01-02", "Dr")
    assert good["validation_errors"] == []
    assert bad["onset_date"] == ""
    assert bad["validation_errors"] == [
        "id_required", "code_required", "code_display_required", "patient_id_required",
        "onset_date_format", "abatement_date_format", "valid_code_system",
    ]


def test_rows_are_never_dropped(resources):
    frame = validate_patient(flatten_patient(resources("{}", "[]", '"text"', '{"id":"p"}')))
    assert frame.count() == 4
    assert frame.where(F.size("validation_errors") > 0).count() == 4


def test_components_as_rows_equal_those_of_the_array(resources):
    odd = [None, 7, "x", {}, {"valueString": "s"}, {"code": {"text": "t", "coding": [3, {"code": "c"}]}, "valueQuantity": {"value": "Infinity"}}, {"valueInteger": 3.5}, {"valueBoolean": "true"}]
    rows = [{"resourceType": "Observation", "id": f"o{i}", "component": c} for i, c in enumerate([odd, odd[::-1], [], None, {"code": 1}, "text"])]
    bronze = resources(*map(json.dumps, [*rows, SPIROMETRY, UNUSABLE]))
    expected = flatten_observation(bronze).select("id", F.inline("components"))
    found = flatten_components(bronze)
    assert found.columns == expected.columns
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))
