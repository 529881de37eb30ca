import datetime
import json
import os
import random

import pytest

from caretiers import build_session
from caretiers.__main__ import main
from caretiers.operators.flatten import flatten_condition, flatten_observation, flatten_patient
from caretiers.plans.pipeline import run_bronze, run_bronze_new, run_gold, run_pipeline, run_silver, save_and_report, save_silver_tables
from caretiers.plans import reports
from caretiers.sources import files, tables
from caretiers.sources.bundles import explode_entries, nested_columns, of_type, parse_bundles
from caretiers.sources.tables import Warehouse
from workload.bundles import condition_bundles, observation_bundles, patient_bundles


@pytest.fixture
def warehouse(spark, tmp_path):
    for schema in ("bronze", "silver", "gold"):
        spark.sql(f"DROP DATABASE IF EXISTS {schema} CASCADE")
    return Warehouse(spark, str(tmp_path / "db"))


@pytest.fixture
def bundle_dir(tmp_path):
    path = tmp_path / "bundles"
    path.mkdir()
    for i in range(3):
        patient = {"resourceType": "Patient", "id": f"p{i}", "birthDate": "2000-01-01", "gender": "male"}
        observation = {"resourceType": "Observation", "id": f"o{i}", "subject": {"reference": "Patient/p0"}}
        entry = [{"resource": patient}, {"resource": observation}, {"resource": {"resourceType": "Foo/Bar %1", "id": "x"}}]
        (path / f"{i}.json").write_text(json.dumps({"id": f"b{i}", "entry": entry}))
    return path


def summary(spark, schema):
    return {row["table"]: row["rows"] for row in tables.get_table_summary(spark, schema).collect()}


def test_write_replaces_rows_and_schema(spark, warehouse):
    rows = [("anna", 41, datetime.date(1984, 6, 30), 40), ("otto", 0, None, None)]
    gold = spark.createDataFrame(rows, "patient_id string, observation_count bigint, birth_date date, patient_age_years bigint")
    warehouse.write("gold", "observations_per_patient", gold)
    assert sorted(map(tuple, warehouse.read("gold", "observations_per_patient").collect())) == rows
    warehouse.write("gold", "observations_per_patient", spark.range(7))
    assert warehouse.read("gold", "observations_per_patient").columns == ["id"]
    assert summary(spark, "gold") == {"gold.observations_per_patient": 7}


def test_table_names_sample_and_drop(spark, warehouse):
    warehouse.write_all("silver", {"b": spark.range(20), "a": spark.range(3)})
    spark.range(1).createOrReplaceTempView("temporary")
    spark.sql("CREATE VIEW silver.seen AS SELECT 1 AS x")
    assert tables.get_table_names(spark, "silver") == ["a", "b"]
    assert tables.get_table_names(spark, "missing") == []
    assert tables.sample_table(spark, "silver", "b").count() == 10
    assert [row["table"] for row in tables.largest_first(tables.get_table_summary(spark, "silver")).collect()] == ["silver.b", "silver.a"]
    tables.drop_table_if_exists(spark, "silver", "a")
    tables.drop_table_if_exists(spark, "silver", "a")
    assert tables.get_table_names(spark, "silver") == ["b"]
    assert summary(spark, "gold") == {}


def test_bronze_has_a_table_per_type(spark, warehouse, bundle_dir):
    counts = run_bronze(warehouse, str(bundle_dir))
    assert {row["table"]: row["rows"] for row in counts.collect()} == {
        "bronze.foo_bar__1": 3,
        "bronze.observation": 3,
        "bronze.patient": 3,
    }
    for file in bundle_dir.iterdir():
        file.write_text(json.dumps({"id": "n", "entry": [{"resource": {"resourceType": "Patient", "id": "new"}}]}))
    again = {row["table"]: row["rows"] for row in run_bronze(warehouse, str(bundle_dir)).collect()}
    assert again["bronze.patient"] == 3 and again["bronze.observation"] == 3
    ids = warehouse.bronze("Patient").selectExpr("resource:id::string AS id").distinct().collect()
    assert [row.id for row in ids] == ["new"]


def test_silver_of_missing_types_is_empty(warehouse, bundle_dir):
    run_bronze(warehouse, str(bundle_dir))
    silver = run_silver(warehouse)
    assert silver.condition.count() == 0
    assert silver.patient.count() == 3
    gold = run_gold(silver, datetime.date(2025, 1, 1))
    assert sorted(map(tuple, gold.collect())) == [
        ("p0", 3, datetime.date(2000, 1, 1), 25),
        ("p1", 0, datetime.date(2000, 1, 1), 25),
        ("p2", 0, datetime.date(2000, 1, 1), 25),
    ]


def test_pipeline_and_reopening(spark, warehouse, bundle_dir, capsys):
    for debug in (False, True):
        run_pipeline(spark, str(bundle_dir), warehouse.root, debug=debug, as_of=datetime.date(2025, 1, 1))
        assert tables.get_table_names(spark, "silver") == (["condition", "observation", "patient"] if debug else [])
    printed = capsys.readouterr().out
    assert "9 resources of 3 types" in printed
    assert "with_gender: 3 (100%)" in printed
    assert "valid: 0, invalid: 3 (0.0% valid)" in printed
    assert "has_name: 3" in printed
    for schema in ("bronze", "silver", "gold"):
        spark.sql(f"DROP DATABASE {schema} CASCADE")
    reopened = Warehouse(spark, warehouse.root)
    assert tables.get_table_names(spark, "bronze") == []
    assert reopened.bronze("Foo/Bar %1").count() == 3
    reopened.attach()
    assert summary(spark, "bronze")["bronze.patient"] == 3
    assert summary(spark, "silver")["silver.observation"] == 3
    assert summary(spark, "gold") == {"gold.observations_per_patient": 3}


def test_stored_silver_equals_the_plan(warehouse, bundle_dir):
    run_bronze(warehouse, str(bundle_dir))
    silver = run_silver(warehouse)
    stored = save_silver_tables(warehouse, silver)
    assert sorted(map(str, stored.observation.collect())) == sorted(map(str, silver.observation.collect()))


def test_stored_bronze_gives_the_rows_of_the_json(spark, warehouse):
    """Reading fields from shredded Parquet, with values of mixed JSON types, as from the parsed text."""
    odd = [
        {"valueQuantity": {"value": 1}}, {"valueQuantity": {"value": "2"}}, {"valueQuantity": {"value": 2.50}}, {"valueQuantity": []},
        {"valueQuantity": {"value": True}, "valueBoolean": "true"}, {"valueBoolean": True}, {"valueInteger": 3.5}, {"valueInteger": 3},
        {"category": ["x", None, {"coding": [3, {"code": "a"}]}], "performer": {"reference": "P/1"}, "code": "text"},
        {"component": [None, 7, {"valueString": "s"}, {"code": {"text": "t"}, "valueQuantity": {"value": "Infinity"}}]},
        {"subject": "P/1", "effectivePeriod": {"start": None, "end": "e"}, "status": 5}, {"subject": {"reference": 7}, "id": None},
        {"name": [{"given": ["A", None, 3]}, {"given": "B"}], "address": [{"line": "one line"}], "telecom": [{"system": "phone", "value": 5}]},
        {"name": {"family": "no list"}, "extension": [{"url": 1}, None], "_onsetDateTime": {"value": "2020-01-01"}},
        {"name": ["x", {"family": ["F", "G"]}], "birthDate": 2000, "identifier": [[], {"system": "s"}]},
    ]
    flatten = {"Patient": flatten_patient, "Condition": flatten_condition, "Observation": flatten_observation}
    entry = [{"resource": {"resourceType": t, "id": f"{i}"} | fields} for t in flatten for i, fields in enumerate(odd * 20)]
    text = spark.createDataFrame([("f", json.dumps({"id": "b", "entry": entry}))], "source_file string, bundle string")
    entries = explode_entries(parse_bundles(text))
    warehouse.write_bronze(entries)
    for resource_type, function in flatten.items():
        expected = sorted(map(str, function(of_type(entries, resource_type)).collect()))
        assert len(expected) == len(odd) * 20
        assert sorted(map(str, function(warehouse.bronze(resource_type)).collect())) == expected
        assert sorted(map(str, function(of_type(entries, resource_type), at_once=True).collect())) == expected


def test_two_warehouses_keep_their_rows(spark, warehouse, tmp_path):
    warehouse.write("gold", "t", spark.range(3))
    other = Warehouse(spark, str(tmp_path / "other"))
    with pytest.raises(ValueError, match="another prefix"):
        other.write("gold", "t", spark.range(5))
    second = Warehouse(spark, other.root, prefix="second_")
    second.write("gold", "t", spark.range(5))
    assert [w.read("gold", "t").count() for w in (warehouse, second)] == [3, 5]
    assert [spark.table(t).count() for t in ("gold.t", "second_gold.t")] == [3, 5]
    assert {row["table"]: row["rows"] for row in second.summary("gold").collect()} == {"gold.t": 5}
    assert second.bronze("Patient").count() == 0 and second.summary("bronze").count() == 0
    for schema in ("bronze", "silver", "gold"):
        spark.sql(f"DROP DATABASE second_{schema} CASCADE")


def test_bronze_needs_adaptive_execution(spark, warehouse):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        with pytest.raises(ValueError, match="adaptive"):
            warehouse.write_bronze(spark.createDataFrame([], "bronze_table string, resource string"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_settings_of_a_running_session_stay(spark):
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", "12345")
    try:
        build_session()
        assert spark.conf.get("spark.sql.files.openCostInBytes") == "12345"
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", before)


def test_missing_input_ends_with_a_message(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("sys.argv", ["caretiers", str(tmp_path / "nowhere"), "--db", str(tmp_path / "db")])
    with pytest.raises(SystemExit, match="input does not exist"):
        main()


def bundle(name, *types):
    return json.dumps({"id": name, "entry": [{"resource": {"resourceType": t, "id": f"{name}-{t}"}} for t in types]})


def counts(summary):
    return {row["table"]: row["rows"] for row in summary.collect()}


def test_a_failing_write_leaves_the_old_rows(spark, warehouse):
    warehouse.write("gold", "t", spark.range(3))
    bad = spark.range(5).selectExpr("id", "if(id = 4, raise_error('stop'), 1) AS x")
    with pytest.raises(Exception, match="stop"):
        warehouse.write("gold", "t", bad)
    assert warehouse.read("gold", "t").columns == ["id"]
    assert [warehouse.read("gold", "t").count(), spark.table("gold.t").count(), Warehouse(spark, warehouse.root).read("gold", "t").count()] == [3] * 3
    reader = warehouse.read("gold", "t")
    warehouse.write("gold", "t", reader.union(reader))
    assert [warehouse.read("gold", "t").count(), spark.table("gold.t").count()] == [6, 6]
    assert reader.count() == 3  # the version before stays for those who read it
    warehouse.write("gold", "t", spark.range(1))
    assert len(files.directories(spark, f"{warehouse.root}/gold/t")) == 2  # what failed and the first version are gone


def test_a_failing_bronze_load_leaves_all_types(spark, warehouse, bundle_dir):
    before = counts(run_bronze(warehouse, str(bundle_dir)))
    (bundle_dir / "3.json").write_text('{"id": "b", "entry": [')
    with pytest.raises(Exception, match="(?i)malformed"):
        run_bronze(warehouse, str(bundle_dir))
    assert counts(warehouse.summary("bronze")) == before == summary(spark, "bronze")


def test_a_bronze_load_replaces_only_its_types(spark, warehouse, tmp_path):
    warehouse.write_bronze(explode_entries(parse_bundles(spark.createDataFrame([("f", bundle("a", "Patient", "Condition"))], "source_file string, bundle string"))))
    warehouse.write_bronze(explode_entries(parse_bundles(spark.createDataFrame([("f", bundle("b", "Patient", "Patient"))], "source_file string, bundle string"))))
    assert counts(warehouse.summary("bronze")) == {"bronze.condition": 1, "bronze.patient": 2}
    assert summary(spark, "bronze") == {"bronze.condition": 1, "bronze.patient": 2}


@pytest.mark.parametrize("name", ["day", "day[1]"])
def test_new_files_are_added_once(spark, warehouse, tmp_path, name):
    source = tmp_path / name
    source.mkdir()
    (source / "a.json").write_text(bundle("a", "Patient", "Observation"))
    (source / "notes.txt").write_text("no bundle")
    path = str(source)
    assert counts(run_bronze_new(warehouse, path)) == {"bronze.observation": 1, "bronze.patient": 1}
    assert counts(run_bronze_new(warehouse, path)) == {"bronze.observation": 1, "bronze.patient": 1}
    (source / "b.json").write_text(bundle("b", "Patient"))
    os.utime(source / "b.json", (0, 0))  # as old as it may be
    (source / "c.json").write_text(bundle("c", "Condition"))
    assert counts(run_bronze_new(warehouse, path)) == {"bronze.observation": 1, "bronze.patient": 2, "bronze.condition": 1}
    assert summary(spark, "bronze") == {"bronze.observation": 1, "bronze.patient": 2, "bronze.condition": 1}
    again = Warehouse(spark, warehouse.root)
    again.attach()
    assert counts(run_bronze_new(again, path)) == counts(again.summary("bronze")) == summary(spark, "bronze")
    again.compact_bronze("Patient")
    assert len(again.places("bronze", "patient")) == 1
    assert sorted(r[0] for r in again.bronze("patient").selectExpr("resource:id::string").collect()) == ["a-Patient", "b-Patient"]


@pytest.mark.parametrize("point", ["before", "within", "after"])
def test_a_failed_run_adds_nothing_twice(spark, warehouse, tmp_path, monkeypatch, point):
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.json").write_text(bundle("a", "Patient", "Observation"))
    run_bronze_new(warehouse, str(source))
    (source / "b.json").write_text(bundle("b", "Patient", "Observation"))
    with monkeypatch.context() as failing:
        commit = warehouse._commit

        def fail(*args):
            if point == "within":
                files.replace_text(spark, f"{warehouse.root}/bronze/load=left/bronze_table=patient/x", "cut off")
            if point == "after":
                commit(*args)
            raise OSError("lost")

        failing.setattr(warehouse, "_commit", fail)
        with pytest.raises(Exception, match="lost"):
            run_bronze_new(warehouse, str(source))
    assert warehouse.bronze("patient").count() == (2 if point == "after" else 1)
    (source / "c.json").write_text(bundle("c", "Patient"))
    assert counts(run_bronze_new(warehouse, str(source))) == {"bronze.patient": 3, "bronze.observation": 2}
    assert {r[0] for r in warehouse.bronze("patient").selectExpr("resource:id::string").collect()} == {"a-Patient", "b-Patient", "c-Patient"}
    assert not files.exists(spark, f"{warehouse.root}/bronze/load=left")


def test_new_files_of_a_common_type_are_many_tasks(spark, warehouse, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    rng = random.Random(0)
    for k in range(4):
        (source / f"{k}.ndjson").write_text("\n".join(json.dumps({"id": f"{k}", "entry": [{"resource": {"resourceType": "Patient", "id": rng.randbytes(400).hex()}}] * 3}) for _ in range(100)))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "32k")
    try:
        run_bronze_new(warehouse, str(source), lines=True, names="*.ndjson", files_at_once=2)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    places = warehouse.places("bronze", "patient")
    assert len(places) == 2 and warehouse.bronze("patient").count() == 1200
    assert all(len([f for f in os.listdir(p.removeprefix("file:")) if f.endswith(".parquet")]) > 1 for p in places)


def test_malformed_bundles_are_kept_aside(spark, warehouse, bundle_dir, capsys):
    texts = {"x.json": '{"id": "b", "entry": [{"resource": {"resourceType": "Patient", "id": "lost"}}, {', "y.json": "no json", "z.json": '{"entry": {"resource": 1}}'}
    for name, text in texts.items():
        (bundle_dir / name).write_text(text)
    (bundle_dir / "empty.json").write_text("")
    found = counts(run_bronze(warehouse, str(bundle_dir), quarantine=True))
    assert found == {"bronze.foo_bar__1": 3, "bronze.observation": 3, "bronze.patient": 3}
    assert dict(map(tuple, warehouse.malformed().collect())) == texts
    assert sorted(summary(spark, "bronze")) == sorted(found)
    run_pipeline(spark, str(bundle_dir), warehouse.root, new=True, quarantine=True)
    assert "malformed bundles: 6" in capsys.readouterr().out  # those of the first load and the same files, added


def test_malformed_lines_are_kept_aside(spark, tmp_path):
    (tmp_path / "a.json").write_text("\n".join([bundle("a", "Patient"), "{bad", bundle("b", "Patient"), '{"id": "c"}']))
    warehouse = Warehouse(spark, str(tmp_path / "db"), prefix="lines_")
    assert warehouse.malformed().count() == 0
    assert counts(run_bronze(warehouse, str(tmp_path / "a.json"), lines=True, quarantine=True)) == {"bronze.patient": 2}
    assert [tuple(r) for r in warehouse.malformed().collect()] == [("a.json", "{bad")]
    for schema in ("bronze", "silver", "gold"):
        spark.sql(f"DROP DATABASE lines_{schema} CASCADE")


def test_reports_collected_while_silver_is_written(spark, warehouse):
    place = f"{warehouse.root}/in"
    for make in (patient_bundles, observation_bundles, condition_bundles):
        make(spark, "/root/testdata/sf0.001").select("bundle").write.mode("append").text(place)
    run_bronze(warehouse, place, lines=True, names="*.txt")
    silver = run_silver(warehouse)
    _, found = save_and_report(warehouse, silver)
    for name, report in (("patient", reports.patient_report), ("condition", reports.condition_report), ("observation", reports.observation_report)):
        assert found[name] == report(getattr(silver, name)).first().asDict(recursive=True), name


def test_nested_columns_of_stored_rows_run_no_job(spark, warehouse, bundle_dir):
    (bundle_dir / "odd.json").write_text(json.dumps({"id": "o", "entry": [{"resource": {"resourceType": "Patient", "id": "q", "a,b>`c": {"x<": [1, 2.5]}, "n": 1.25}}]}))
    run_bronze(warehouse, str(bundle_dir))
    context = spark.sparkContext
    context.setJobGroup("nested", "")
    nested = {t: warehouse.nested(t) for t in ("Patient", "Observation", "Foo/Bar %1", "None")}
    assert not context.statusTracker().getJobIdsForGroup("nested")
    context.setLocalProperty("spark.jobGroup.id", None)
    for t in ("Patient", "Observation", "Foo/Bar %1"):
        expected = nested_columns(warehouse.bronze(t))
        # Numbers of one field are stored in one type, so the schema of the stored rows may have a narrower decimal.
        assert nested[t].columns == expected.columns
        assert sorted(map(str, nested[t].collect())) == sorted(map(str, expected.collect()))
    assert nested["None"].count() == 0
    warehouse.add_bronze(explode_entries(parse_bundles(spark.createDataFrame([("f", bundle("z", "Patient"))], "source_file string, bundle string"))), "more")
    assert warehouse.nested("Patient").count() == 5 and "birthDate" in warehouse.nested("Patient").columns


def test_counts_come_from_footers(spark, warehouse, bundle_dir):
    found = run_bronze(warehouse, str(bundle_dir))
    text = found._jdf.queryExecution().executedPlan().toString()
    assert text.count("PushedAggregation: [COUNT(*)]") == 3 and "resource" not in text
    warehouse.write_all("silver", {"a": spark.range(7), "b": spark.range(0)})
    assert counts(warehouse.summary("silver")) == {"silver.a": 7, "silver.b": 0}
    assert counts(warehouse.summary("gold")) == {}
