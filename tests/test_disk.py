"""What loads and the queries over stored tables leave on the disks."""

import json
import os
import uuid

import pytest

from caretiers.plans.pipeline import run_bronze, run_bronze_new
from caretiers.sources import files
from caretiers.sources.tables import Warehouse
from workload import queries
from workload.bundles import condition_bundles, observation_bundles, patient_bundles
from workload.check import differences

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def warehouse(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "db"), prefix="disk_")
    yield warehouse
    for schema in ("bronze", "silver", "gold"):
        spark.sql(f"DROP DATABASE disk_{schema} CASCADE")


def write_bundles(source, count, rows=60):
    """Files of patients; the first bundle of each file also has a rare type."""
    source.mkdir(exist_ok=True)
    for k in range(count):
        lines = []
        for i in range(rows):
            entry = [{"resource": {"resourceType": "Patient", "id": f"{k}-{i}-{j}", "note": os.urandom(200).hex()}} for j in range(3)]
            entry += [{"resource": {"resourceType": "Rare", "id": f"{k}", "size": k}}] * (i == 0) + [{"resource": {"resourceType": None, "id": "none"}}]
            lines.append(json.dumps({"id": f"{k}", "entry": entry}))
        (source / f"{len(os.listdir(source))}.ndjson").write_text("\n".join(lines))


def shuffles(spark, job):
    """How many shuffles a job makes."""
    context = spark.sparkContext._jsc.sc()
    before = context.newShuffleId()
    job()
    return context.newShuffleId() - before - 1


def parts(warehouse, resource_type):
    return [f for place in warehouse.places("bronze", resource_type) for f in os.listdir(place.removeprefix("file:")) if f.endswith(".parquet")]


def counts(summary):
    return {row["table"]: row["rows"] for row in summary.collect()}


@pytest.fixture
def tasks_of_a_file(spark):
    """Each file is a task, and such files are not small."""
    for key, value in {"spark.sql.files.maxPartitionBytes": "48k", "spark.sql.files.openCostInBytes": "40k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k"}.items():
        spark.conf.set(key, value)
    yield
    for key in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes"):
        spark.conf.unset(key)


def test_a_load_needs_no_disk_beside_its_tables(spark, warehouse, tmp_path, tasks_of_a_file):
    source = tmp_path / "in"
    write_bundles(source, 12)
    assert shuffles(spark, lambda: run_bronze(warehouse, str(source), lines=True, names="*.ndjson")) == 0
    assert counts(warehouse.summary("bronze")) == {"bronze.patient": 12 * 180, "bronze.rare": 12}
    # The common type keeps the files of its tasks, the rare one is packed, and its small files are gone.
    assert len(parts(warehouse, "patient")) >= 12 and len(parts(warehouse, "rare")) == 1
    below = [f"{load}/{table}" for load in files.directories(spark, warehouse.path("bronze")) for table in files.directories(spark, f"{warehouse.path('bronze')}/{load}")]
    assert sorted(below) == sorted(place for places in warehouse.manifest("bronze").values() for place in places)
    rare = warehouse.bronze("Rare").selectExpr("_source_bundle", "resource:id::string AS id", "resource:size::int AS size").collect()
    assert sorted(map(tuple, rare)) == sorted((f"{k}", f"{k}", k) for k in range(12))
    assert sorted(warehouse.nested("Rare").columns) == sorted([*warehouse.bronze("Rare").columns[:3], "id", "resourceType", "size"])
    assert {row["rows"] for row in spark.sql("SELECT count(*) AS rows FROM disk_bronze.rare").collect()} == {12}


def test_files_that_are_added_need_no_disk_beside_the_tables(spark, warehouse, tmp_path, tasks_of_a_file):
    source = tmp_path / "in"

    def add():
        run_bronze_new(warehouse, str(source), lines=True, names="*.ndjson")

    for k in (1, 2):
        write_bundles(source, 8)
        assert shuffles(spark, add) == 0
        assert counts(warehouse.summary("bronze")) == {"bronze.patient": k * 8 * 180, "bronze.rare": k * 8}
    add()
    assert len(parts(warehouse, "rare")) == 2  # of two loads
    assert counts(warehouse.summary("bronze")) == {"bronze.patient": 16 * 180, "bronze.rare": 16}


def test_a_load_of_packed_types_only_is_added_once(spark, warehouse, tmp_path, tasks_of_a_file):
    source = tmp_path / "in"
    write_bundles(source, 12)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64m")
    for _ in range(2):
        warehouse.add_bronze(queries.bundles.load_bronze_bundles(spark, str(source), True, names="*.ndjson"), "one")
        assert all(place.startswith("load=one.packed/") for places in warehouse.manifest("bronze").values() for place in places)
        assert counts(warehouse.summary("bronze")) == {"bronze.patient": 12 * 180, "bronze.rare": 12}
    assert all(len(parts(warehouse, name)) == 1 for name in ("patient", "rare"))


def test_rows_of_few_tasks_are_dealt_by_type(spark, warehouse, tmp_path):
    """A file that cannot be split is read by one task, but written by one for each type."""
    source = tmp_path / "in"
    source.mkdir()
    entry = [{"resource": {"resourceType": name, "id": f"{i}", "note": os.urandom(200).hex()}} for i in range(200) for name in ("Patient", "Group", "Device")]
    (source / "a.json").write_text(json.dumps({"id": "a", "entry": entry}, indent=1))
    assert shuffles(spark, lambda: run_bronze(warehouse, str(source))) == 1
    assert counts(warehouse.summary("bronze")) == {f"bronze.{name}": 200 for name in ("patient", "group", "device")}


def test_bundles_of_the_tables_are_stored_compressed(spark, tmp_path):
    makers = (patient_bundles, observation_bundles, condition_bundles)
    queries._write_lines(spark, SF_DIR, str(tmp_path / "in"), *makers)
    texts = [row.bundle for make in makers for row in make(spark, SF_DIR).select("bundle").collect()]
    stored = sum(p.stat().st_size for p in (tmp_path / "in").glob("*.gz"))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "in")).collect()) == sorted(texts)
    assert 0 < stored < sum(map(len, texts)) / 5


@pytest.mark.parametrize("name", ["stored_gold", "stored_observation_report", "stored_silver_condition"])
def test_imported_bundles_make_room_for_tables(spark, tmp_path, monkeypatch, name):
    """The bundles' files are gone when the tables made of them are written and read; their rows are all there."""
    folder = tmp_path / uuid.uuid4().hex
    monkeypatch.setattr(queries, "_new_folder", lambda spark: str(folder))
    queries._imported.cache_clear()
    try:
        assert differences(spark, name, SF_DIR) == []
        assert os.listdir(folder) == ["db"]
        stored = [p for p in folder.rglob("*.parquet") if p.is_file()]
        assert stored and all(p.name.endswith(".zstd.parquet") for p in stored)
    finally:
        queries._imported.cache_clear()
