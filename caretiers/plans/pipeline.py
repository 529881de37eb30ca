"""The jobs: bundles to bronze, bronze to silver, silver to gold, with reports."""

from __future__ import annotations

import datetime
import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caretiers import contracts as C
from caretiers.operators.flatten import flatten_condition, flatten_observation, flatten_patient
from caretiers.operators.validation import validate_condition, validate_observation, validate_patient
from caretiers.plans import reports
from caretiers.plans.gold import build_observations_per_patient
from caretiers.sources import files
from caretiers.sources.bundles import explode_entries, load_bronze_bundles, stream_bundles
from caretiers.sources.tables import Warehouse

GOLD_TABLE = "observations_per_patient"


@dataclass(frozen=True)
class Silver:
    """The validated frames. They are plans over bronze, not stored rows."""

    patient: C.Patient
    condition: C.Condition
    observation: C.Observation


def run_bronze(warehouse: Warehouse, path: str, lines: bool = False, quarantine: bool = False, names: str = "*.json") -> DataFrame:
    """Load bundles into the bronze tables; gives rows per table. ``warehouse.malformed()`` has what ``quarantine`` kept."""
    warehouse.write_bronze(load_bronze_bundles(warehouse.spark, path, lines, quarantine, names))
    return warehouse.summary(C.Schema.BRONZE)


def run_bronze_new(
    warehouse: Warehouse,
    path: str,
    lines: bool = False,
    quarantine: bool = False,
    names: str = "*.json",
    files_at_once: int = 100_000,
) -> DataFrame:
    """Add the files of a directory that no earlier call has added; gives rows per table.

    Which files were added is kept beside the tables, for each directory of bundles. At most ``files_at_once``
    files are one load. A call that fails may be repeated: a load is in the tables whole or not at all, and
    only once. A file that changes after it was added is not read again, and ``run_bronze`` does not count as
    adding, so use one or the other for a directory.
    """
    spark, entries = warehouse.spark, explode_entries(stream_bundles(warehouse.spark, path, lines, quarantine, names, files_at_once))
    source = hashlib.sha256(files.qualified(spark, path.rstrip("/")).encode()).hexdigest()[:16]

    def add(batch: DataFrame, number: int) -> None:
        # A stream's own session has this off, for state; there is none here.
        batch.sparkSession.conf.set("spark.sql.adaptive.enabled", spark.conf.get("spark.sql.adaptive.enabled"))
        warehouse.add_bronze(batch, f"{source}-{number}")

    added = entries.writeStream.foreachBatch(add)
    checkpoint = f"{warehouse.path(C.Schema.BRONZE)}/_added/{source}"
    added.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return warehouse.summary(C.Schema.BRONZE)


def bronze_totals(counts: DataFrame) -> DataFrame:
    """One row, ``types`` and ``resources``, of rows per table or type."""
    return counts.agg(F.count("*").alias("types"), F.coalesce(F.sum("rows"), F.lit(0)).alias("resources"))


def run_silver(warehouse: Warehouse) -> Silver:
    """Silver frames over the bronze tables. A type without a table gives an empty frame."""
    return Silver(
        patient=validate_patient(flatten_patient(warehouse.bronze("patient"))),
        condition=validate_condition(flatten_condition(warehouse.bronze("condition"))),
        observation=validate_observation(flatten_observation(warehouse.bronze("observation"))),
    )


def save_silver_tables(warehouse: Warehouse, silver: Silver) -> Silver:
    """Store the silver frames and give them back as tables, so later steps read the stored rows."""
    return save_and_report(warehouse, silver)[0]


def save_and_report(warehouse: Warehouse, silver: Silver) -> tuple[Silver, dict[str, dict[str, object]]]:
    """Store the silver frames; the tables, and each frame's report, collected while its rows were written."""
    tables, found = {}, {}
    for name, frame in (("patient", silver.patient), ("condition", silver.condition), ("observation", silver.observation)):
        rows, report = reports.observed(name, frame)
        warehouse.write(C.Schema.SILVER, name, rows)
        tables[name], found[name] = type(frame).from_df(warehouse.read(C.Schema.SILVER, name)), report()
    return Silver(**tables), found


def run_gold(silver: Silver, as_of: datetime.date | None = None) -> C.ObservationsPerPatient:
    return build_observations_per_patient(silver.patient, silver.observation, as_of=as_of)


def print_bronze_summary(summary: DataFrame) -> None:
    totals = bronze_totals(summary).first()
    print(f"{totals['resources']} resources of {totals['types']} types")
    for row in summary.collect():
        print(f"  {row['table']}: {row['rows']}")


def print_report(title: str, report: DataFrame | dict[str, object]) -> None:
    """Print a summary and validation report: a frame of one row, or its columns and values."""
    row = report if isinstance(report, dict) else report.first().asDict()
    total_name = next(iter(row))
    total = row[total_name]
    print(f"{title}: {total}")
    for name, count in row.items():
        if name.startswith("with_"):
            print(f"  {name}: {count} ({100 * count / total if total else 0:.0f}%)")
    print(f"  valid: {row['valid_records']}, invalid: {row['invalid_records']} ({row['validity_rate']:.1%} valid)")
    for error in row["errors_by_rule"]:
        print(f"    {error['error']}: {error['count']}")


def run_pipeline(
    spark: SparkSession,
    path: str,
    root: str,
    *,
    lines: bool = False,
    debug: bool = False,
    as_of: datetime.date | None = None,
    new: bool = False,
    quarantine: bool = False,
) -> None:
    """All layers with their reports. Silver is stored only with ``debug``.

    ``new`` adds the bundles of new files to those of earlier calls. ``quarantine`` keeps malformed bundles aside.
    Nothing is cached: bronze is stored shredded, and each report or gold pass reads only the
    JSON fields it needs from it.
    """
    warehouse = Warehouse(spark, root)
    print_bronze_summary((run_bronze_new if new else run_bronze)(warehouse, path, lines, quarantine))
    if quarantine:
        print(f"malformed bundles: {warehouse.malformed().count()}")
    silver = run_silver(warehouse)
    found = {
        "patient": reports.patient_report(silver.patient),
        "condition": reports.condition_report(silver.condition),
        "observation": reports.observation_report(silver.observation),
    }
    if debug:
        silver, found = save_and_report(warehouse, silver)
    for name, report in found.items():
        print_report(name, report)
    warehouse.write(C.Schema.GOLD, GOLD_TABLE, run_gold(silver, as_of))
    print(f"gold.{GOLD_TABLE}: {warehouse.read(C.Schema.GOLD, GOLD_TABLE).count()}")
