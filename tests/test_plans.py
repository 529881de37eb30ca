"""What the plans must and must not do."""

import datetime
import re

import pytest

from caretiers.operators.flatten import flatten_condition, flatten_observation, flatten_patient
from caretiers.operators.validation import validate_observation, validate_patient
from caretiers.plans.gold import build_observations_per_patient
from caretiers.sources.bundles import explode_entries, parse_bundles
from caretiers.sources.tables import Warehouse
from workload.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return getattr(df, "df", df)._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def bronze(spark, tmp_path_factory):
    text = """{"id":"b","entry":[
      {"resource":{"resourceType":"Patient","id":"p","birthDate":"2000-01-01","name":[{"family":"F","given":["A"]}]}},
      {"resource":{"resourceType":"Observation","id":"o","subject":{"reference":"Patient/p"},
        "code":{"coding":[{"code":"c"}]},"component":[{"valueString":"s"}]}}]}"""
    bundles = spark.createDataFrame([("f", text)], "source_file string, bundle string")
    warehouse = Warehouse(spark, str(tmp_path_factory.mktemp("db")))
    warehouse.write_bronze(explode_entries(parse_bundles(bundles)))
    return warehouse


@pytest.mark.parametrize("name", [name for name in QUERIES if name not in ("bronze_table_patient", "table_summary", "sample_table")])
def test_queries_stay_in_the_jvm(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert not re.search(r"Python|CartesianProduct|BroadcastNestedLoopJoin|LocalLimit|CollectLimit", text)
    assert text.count("from_json") <= 3
    assert "REPARTITION_BY_NUM" not in text


def test_variant_paths_reach_the_scan(bronze):
    ids = plan(flatten_observation(bronze.bronze("observation")).select("id", "subject_id"))
    assert "ReadSchema: struct<resource:struct<0:string,1:string>>" in ids
    name = plan(flatten_patient(bronze.bronze("patient")).select("birth_date"))
    assert "ReadSchema: struct<resource:struct<0:string>>" in name


def test_gold_reads_two_fields_per_side(bronze):
    patients = validate_patient(flatten_patient(bronze.bronze("patient")))
    observations = validate_observation(flatten_observation(bronze.bronze("observation")))
    text = plan(build_observations_per_patient(patients, observations, as_of=datetime.date(2025, 1, 1)))
    assert text.count("ReadSchema: struct<resource:struct<0:string,1:string>>") == 2
    assert "validation_errors" not in text


def test_bronze_tables_are_read_from_their_own_directory(bronze):
    assert "bronze_table=patient]" in plan(bronze.bronze("patient"))


def test_each_json_field_is_read_once(bronze):
    text = plan(flatten_condition(bronze.bronze("observation")))
    assert "try_variant_get" not in text.split("FileScan")[0]


def test_clean_reads_used_columns_only(spark):
    text = plan(QUERIES["read_and_clean"](spark, SF_DIR).select("lang"))
    assert "ReadSchema: struct<lang:string>" in text
