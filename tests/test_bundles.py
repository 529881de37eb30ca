import json

import pytest
from pyspark.sql import functions as F

from caretiers.functions.fhir import read
from caretiers.sources import bundles

BUNDLE = {
    "resourceType": "Bundle",
    "id": "visit-4",
    "entry": [
        {"resource": {"resourceType": "Observation", "id": "pulse", "status": "preliminary"}},
        {"fullUrl": "urn:visit:anna", "resource": {"resourceType": "Patient", "id": "anna", "gender": "female"}},
        {"resource": {"resourceType": "Patient", "id": "otto"}},
    ],
}


@pytest.fixture
def directory(tmp_path):
    def write(**files):
        for name, content in files.items():
            text = content if isinstance(content, str) else json.dumps(content, indent=1)
            (tmp_path / name.replace("__", ".")).write_text(text)
        return str(tmp_path)

    return write


def rows(entries):
    columns = ["bronze_table", "_source_file", "_source_bundle", "_full_url", read(F.col("resource"), "id")]
    return sorted((tuple(row) for row in entries.select(*columns).collect()), key=str)


def test_one_row_per_resource_with_lineage(spark, directory):
    second = {"id": "b2", "entry": [{"resource": {"resourceType": "Condition", "id": "c1"}}]}
    path = directory(one__json=BUNDLE, two__json=second, notes__txt="no bundle")
    assert rows(bundles.load_bronze_bundles(spark, path)) == [
        ("condition", "two.json", "b2", None, "c1"),
        ("observation", "one.json", "visit-4", None, "pulse"),
        ("patient", "one.json", "visit-4", "urn:visit:anna", "anna"),
        ("patient", "one.json", "visit-4", None, "otto"),
    ]


def test_single_file(spark, directory):
    path = directory(one__json=BUNDLE, two__json=BUNDLE)
    assert len(rows(bundles.load_bronze_bundle_file(spark, f"{path}/one.json"))) == 3


def test_a_file_named_like_a_pattern(spark, directory):
    path = directory(**{"visit[1]__json": BUNDLE, "visit1__json": BUNDLE | {"id": "other"}, "v*__json": BUNDLE | {"id": "star"}})
    assert {row[2] for row in rows(bundles.load_bronze_bundle_file(spark, f"{path}/visit[1].json"))} == {"visit-4"}
    assert {row[2] for row in rows(bundles.load_bronze_bundle_file(spark, f"{path}/v*.json"))} == {"star"}
    assert bundles.read_bundle_files(spark, f"{path}/visit*.json").count() == 2
    assert len(rows(bundles.load_bronze_bundles(spark, path))) == 9


def test_one_bundle_per_line(spark, directory):
    path = directory(many__json="\n".join(json.dumps(BUNDLE | {"id": f"b{i}"}) for i in range(5)))
    entries = bundles.load_bronze_bundles(spark, path, lines=True)
    assert entries.select("_source_bundle").distinct().count() == 5
    assert entries.count() == 15


def test_empty_directory_and_subdirectories(spark, tmp_path):
    for name in ("below", "day=1"):
        (tmp_path / name).mkdir()
        (tmp_path / name / "one.json").write_text(json.dumps(BUNDLE))
    assert rows(bundles.load_bronze_bundles(spark, str(tmp_path))) == []
    (tmp_path / "one.json").write_text(json.dumps(BUNDLE))
    assert len(rows(bundles.load_bronze_bundles(spark, str(tmp_path) + "/"))) == 3


def test_names_decide_nothing(spark, tmp_path):
    """A file may have any name, and a directory may be named like a file or a pattern."""
    (tmp_path / "export").write_text(json.dumps(BUNDLE))
    assert len(rows(bundles.load_bronze_bundle_file(spark, str(tmp_path / "export")))) == 3
    for name in ("x.json", "a[1]{b}"):
        (tmp_path / name).mkdir()
        (tmp_path / name / "one.json").write_text(json.dumps(BUNDLE))
        (tmp_path / name / "notes.txt").write_text("no bundle")
        assert len(rows(bundles.load_bronze_bundles(spark, str(tmp_path / name)))) == 3


def test_file_names_are_not_percent_encoded(spark, directory):
    path = directory(**{"a b+c%20d é__json": BUNDLE})
    names = {row[1] for row in rows(bundles.load_bronze_bundles(spark, path))}
    assert names == {"a b+c%20d é.json"}


def test_entries_without_type_are_left_out(spark, directory):
    entry = [
        None,
        {},
        {"resource": None},
        {"resource": {"id": "x"}},
        {"resource": {"resourceType": "", "id": "y"}},
        {"resource": {"resourceType": None}},
        {"resource": {"resourceType": "Patient", "id": "p"}},
    ]
    path = directory(one__json={"id": "b", "entry": entry}, two__json={"id": "none"}, three__json={"entry": None})
    assert rows(bundles.load_bronze_bundles(spark, path)) == [("patient", "one.json", "b", None, "p")]


def test_own_lineage_fields_win(spark, directory):
    own = {"resourceType": "Patient", "id": "p", "_source_file": "mine", "_full_url": None}
    path = directory(one__json={"id": "b", "entry": [{"fullUrl": "u", "resource": own}]})
    assert rows(bundles.load_bronze_bundles(spark, path)) == [("patient", "mine", "b", None, "p")]


def test_repeated_keys_keep_the_last_value(spark, directory):
    path = directory(one__json='{"id":"b","entry":[{"resource":{"resourceType":"Patient","id":"p","id":"q"}}]}')
    assert rows(bundles.load_bronze_bundles(spark, path)) == [("patient", "one.json", "b", None, "q")]


def test_malformed_json_fails(spark, directory):
    path = directory(one__json='{"id": "b", "entry": [')
    with pytest.raises(Exception, match="(?i)malformed"):
        bundles.load_bronze_bundles(spark, path).collect()


def test_frames_by_type_and_counts(spark, directory):
    entries = bundles.load_bronze_bundles(spark, directory(one__json=BUNDLE))
    frames = bundles.frames_by_type(entries)
    assert {name: frame.count() for name, frame in frames.items()} == {"patient": 2, "observation": 1}
    assert {tuple(row) for row in bundles.resource_counts(entries).collect()} == {("patient", 2), ("observation", 1)}
    assert bundles.of_type(entries, "Patient").columns == ["_source_file", "_source_bundle", "_full_url", "resource"]


def test_nested_columns_keep_arrays(resources):
    bronze = resources(
        '{"resourceType":"Location","id":"ward","alias":["W3","West"],"position":[{"floor":3,"rooms":["a","b"]},{"rooms":[]}]}',
        '{"resourceType":"Location","id":"yard","opened":{"year":1999}}',
    )
    nested = bundles.nested_columns(bronze)
    by_id = {row.id: row for row in nested.collect()}
    assert by_id["ward"].alias == ["W3", "West"]
    assert [(p.floor, p.rooms) for p in by_id["ward"].position] == [(3, ["a", "b"]), (None, [])]
    assert by_id["yard"].opened.year == 1999
    assert bundles.nested_columns(bronze.limit(0)).columns == ["_source_file", "_source_bundle", "_full_url"]


def test_nested_columns_of_fields_without_a_type(resources):
    bronze = resources('{"id":"a","never":null,"empty":[],"in":{"none":null},"OBJECT<":1}', '{"id":"b","VOID":"x"}')
    nested = bundles.nested_columns(bronze)
    assert {"id", "never", "empty", "in", "OBJECT<", "VOID"} < set(nested.columns)
    assert [row.id for row in nested.orderBy("id").collect()] == ["a", "b"]
    assert nested.where("id = 'a'").selectExpr("empty", "never").first()["empty"] == []


def test_parse_bundles_reads_text(spark):
    df = spark.createDataFrame([("x.json", json.dumps(BUNDLE))], "source_file string, bundle string")
    assert len(rows(bundles.explode_entries(bundles.parse_bundles(df)))) == 3
