"""One query per operator, each over the whole of its input tables."""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Callable
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caretiers import Col, TypedDataFrame
from caretiers.contracts import NATIONALITY_EXTENSION
from caretiers.functions import booleans, dates, fhir, holidays
from caretiers.functions.text import normalize_municipality_name
from caretiers.operators import cleaning
from caretiers.operators.columns import with_columns
from caretiers.operators.flatten import flatten_components, flatten_condition, flatten_observation, flatten_patient
from caretiers.operators.validation import is_finite, validate_condition, validate_observation, validate_patient
from caretiers.plans import codes, gold, pipeline, reports
from caretiers.sources import bundles, files, parquet, tables
from workload.bundles import condition_bundles, every, observation_bundles, patient_bundles, table

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = datetime.date(2025, 1, 1)
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
DATABASE = "test_tables"

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


class Order(TypedDataFrame):
    o_orderkey: Col[int]
    o_custkey: Col[int]
    o_orderstatus: Col[str | None]


class PricedOrder(Order):
    o_totalprice: Col[float]


class Prioritised(TypedDataFrame):
    o_orderpriority: Col[str | None]


class FullOrder(PricedOrder, Prioritised):
    pass


# Bronze and silver frames made from the tables.


def _entries(spark: SparkSession, sf_dir: str, make: Callable[[SparkSession, str], DataFrame]) -> DataFrame:
    return bundles.explode_entries(bundles.parse_bundles(make(spark, sf_dir)))


def _all_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    patients, observations, conditions = (
        _entries(spark, sf_dir, make) for make in (patient_bundles, observation_bundles, condition_bundles)
    )
    return patients.unionByName(observations).unionByName(conditions)


def _bronze_patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bundles.of_type(_entries(spark, sf_dir, patient_bundles), "Patient")


def _bronze_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bundles.of_type(_entries(spark, sf_dir, observation_bundles), "Observation")


def _bronze_conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bundles.of_type(_entries(spark, sf_dir, condition_bundles), "Condition")


def _patients(spark: SparkSession, sf_dir: str) -> TypedDataFrame:
    return validate_patient(flatten_patient(_bronze_patients(spark, sf_dir)))


def _observations(spark: SparkSession, sf_dir: str) -> TypedDataFrame:
    return validate_observation(flatten_observation(_bronze_observations(spark, sf_dir)))


def _conditions(spark: SparkSession, sf_dir: str) -> TypedDataFrame:
    return validate_condition(flatten_condition(_bronze_conditions(spark, sf_dir)))


def _gold(spark: SparkSession, sf_dir: str) -> TypedDataFrame:
    return gold.build_observations_per_patient(_patients(spark, sf_dir), _observations(spark, sf_dir), as_of=AS_OF)


def _joined(column: str) -> Column:
    return F.array_join(column, "|").alias(column)


# Bronze.


@query
def bronze_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _all_entries(spark, sf_dir).select(
        "bronze_table", "_source_file", "_source_bundle", "_full_url", fhir.read(F.col("resource"), "id").alias("id")
    )


@query
def bronze_resource_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bundles.resource_counts(_all_entries(spark, sf_dir))


@query
def bronze_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipeline.bronze_totals(bundles.resource_counts(_all_entries(spark, sf_dir)))


@query
def extension_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    extensions = F.try_variant_get("resource", "$.extension", "array<variant>")
    code = fhir.extract_extension_value(extensions, NATIONALITY_EXTENSION, ["valueCodeableConcept", "coding", 0, "code"])
    return _bronze_patients(spark, sf_dir).select(F.col("_source_bundle").alias("source_bundle"), code.alias("code"))


@query
def bronze_table_patient(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = bundles.nested_columns(_bronze_patients(spark, sf_dir))
    return nested.select(
        "_source_bundle",
        "resourceType",
        "id",
        "birthDate",
        F.get("telecom", F.lit(1)).value.alias("phone"),
        F.array_join(F.get("address", F.lit(0)).line, "|").alias("address_line"),
        F.size("name").alias("names"),
    )


@query
def obs_per_source_file_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = _bronze_observations(spark, sf_dir).groupBy("_source_file").agg(F.count("*").alias("observations"))
    return counts.orderBy(F.desc("observations"), "_source_file").limit(5)


@query
def raw_summary_patient(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.bronze_patient_summary(_bronze_patients(spark, sf_dir))


@query
def raw_summary_condition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.bronze_condition_summary(_bronze_conditions(spark, sf_dir))


@query
def raw_summary_observation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.bronze_observation_summary(_bronze_observations(spark, sf_dir))


# Silver.


def _all_columns(validate: Callable[[DataFrame], TypedDataFrame], flatten: Callable[..., DataFrame], bronze: DataFrame) -> TypedDataFrame:
    """Silver with all its columns, from resources that were just parsed."""
    return validate(flatten(bronze, at_once=True))


@query
def silver_patient(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _all_columns(validate_patient, flatten_patient, _bronze_patients(spark, sf_dir)).withColumn("validation_errors", _joined("validation_errors"))


@query
def silver_condition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _all_columns(validate_condition, flatten_condition, _bronze_conditions(spark, sf_dir)).withColumn("validation_errors", _joined("validation_errors"))


@query
def silver_observation(spark: SparkSession, sf_dir: str) -> DataFrame:
    observations = _all_columns(validate_observation, flatten_observation, _bronze_observations(spark, sf_dir))
    return observations.withColumns(
        {name: _joined(name) for name in ("performer_references", "performer_ids", "validation_errors")}
        | {name: F.size(name) for name in ("code_codings", "category_codings", "components")}
    )


@query
def silver_patient_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _patients(spark, sf_dir).select("source_bundle", F.explode("validation_errors").alias("error"))


@query
def silver_condition_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _conditions(spark, sf_dir).select("source_bundle", F.explode("validation_errors").alias("error"))


@query
def silver_observation_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _observations(spark, sf_dir).select("id", F.explode("validation_errors").alias("error"))


def _select_observation(*columns: str) -> Query:
    return lambda spark, sf_dir: flatten_observation(_bronze_observations(spark, sf_dir)).select("id", *columns)


def _select_patient(*columns: str) -> Query:
    return lambda spark, sf_dir: flatten_patient(_bronze_patients(spark, sf_dir)).select("source_bundle", *columns)


QUERIES["reference_id"] = _select_observation("subject_reference", "subject_id")
QUERIES["effective_datetime"] = _select_observation("effective_datetime")
QUERIES["value_type"] = _select_observation("value_type", "value_string", "value_boolean", "value_integer")
QUERIES["quantity_value"] = _select_observation("value_quantity_value", "value_quantity_unit")
QUERIES["telecom_phone"] = _select_patient("phone")
QUERIES["identifier_by_system"] = _select_patient("identifier_eci", "identifier_mr")
QUERIES["given_names_join"] = _select_patient("family_name", "given_names", "full_name")
QUERIES["nationality"] = _select_patient("nationality_code")


@query
def first_coding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_condition(_bronze_conditions(spark, sf_dir)).select("id", "code_system", "code", "code_display")


@query
def performer_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    observations = flatten_observation(_bronze_observations(spark, sf_dir))
    return observations.select("id", F.explode("performer_ids").alias("performer_id"))


@query
def coding_unnest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_observation(_bronze_observations(spark, sf_dir)).select("id", F.inline("code_codings"))


@query
def category_codings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_observation(_bronze_observations(spark, sf_dir)).select("id", F.inline("category_codings"))


@query
def components_unnest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_components(_bronze_observations(spark, sf_dir))


@query
def components_inline(spark: SparkSession, sf_dir: str) -> DataFrame:
    observations = flatten_observation(_bronze_observations(spark, sf_dir))
    return observations.select("id", F.inline("components"))


@query
def quantity_finite(spark: SparkSession, sf_dir: str) -> DataFrame:
    observations = flatten_observation(_bronze_observations(spark, sf_dir))
    return observations.select("id", is_finite(F.col("value_quantity_value")).alias("finite"))


# Reports.


@query
def valid_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.valid_records(_observations(spark, sf_dir)).select("id", "status", "subject_id")


@query
def validation_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.validation_summary(_observations(spark, sf_dir))


def _with_error_text(report: DataFrame) -> DataFrame:
    lines = F.transform("errors_by_rule", lambda e: F.concat_ws(":", e.error, e["count"]))
    return report.withColumn("errors_by_rule", F.array_join(lines, "|"))


@query
def validation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_error_text(reports.validation_report(_observations(spark, sf_dir)))


@query
def patient_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_error_text(reports.patient_report(_patients(spark, sf_dir)))


@query
def summary_patient(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.patient_summary(_patients(spark, sf_dir))


@query
def summary_condition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.condition_summary(_conditions(spark, sf_dir))


@query
def summary_observation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.observation_summary(_observations(spark, sf_dir))


@query
def quality_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.quality_percentages(summary_observation(spark, sf_dir))


# Gold.


@query
def gold_observations_per_patient(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gold(spark, sf_dir).df


@query
def gold_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.ranked_by_count(_gold(spark, sf_dir))


@query
def top20_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.concentration(_gold(spark, sf_dir))


# Codes and their lists.


@query
def codes_outside_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = {
        "patient": _patients(spark, sf_dir),
        "condition": _conditions(spark, sf_dir),
        "observation": _observations(spark, sf_dir),
    }
    return codes.codes_outside_lists(spark, frames)


@query
def condition_status_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.used_codes({"condition_status": codes.condition_statuses(_bronze_conditions(spark, sf_dir))})


# Bundles in files, imported into stored tables.


def _new_folder(spark: SparkSession) -> str:
    """A new folder that driver and executors share; it goes when the application ends."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    path = f"{root.rstrip('/')}/_workload/{uuid.uuid4().hex}"
    files.delete_on_exit(spark, path)
    return path


#: Names of the files of ``_write_lines``.
LINES = "*.txt.gz"


def _write_lines(spark: SparkSession, sf_dir: str, path: str, *makers: Callable[[SparkSession, str], DataFrame]) -> None:
    """Bundles of all rows of the tables, one per line, in compressed files: the lines take some forty times the tables' bytes.

    What dealing the rows out has left on the disks goes with each write.
    """
    with tables.setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        for make in makers:
            make(spark, sf_dir).select(F.col("bundle").alias("value")).write.mode("append").text(path, compression="gzip")


def _warehouse(spark: SparkSession, folder: str) -> tables.Warehouse:
    return tables.Warehouse(spark, f"{folder}/db", prefix=f"w{folder[-12:]}_")


@cache
def _imported(spark: SparkSession, sf_dir: str) -> tables.Warehouse:
    """The tables of all bundles, imported from files; once a session, since the tables do not change.

    The files go when they are imported: nothing reads them again, and the queries store more tables.
    """
    folder = _new_folder(spark)
    _write_lines(spark, sf_dir, f"{folder}/in", patient_bundles, observation_bundles, condition_bundles)
    warehouse = _warehouse(spark, folder)
    pipeline.run_bronze(warehouse, f"{folder}/in", lines=True, names=LINES)
    files.delete(spark, f"{folder}/in")
    return warehouse


@query
def stored_bronze_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _imported(spark, sf_dir).summary("bronze")


@query
def stored_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse = _imported(spark, sf_dir)
    warehouse.write("gold", pipeline.GOLD_TABLE, pipeline.run_gold(pipeline.run_silver(warehouse), AS_OF))
    return warehouse.read("gold", pipeline.GOLD_TABLE)


@query
def stored_observation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_error_text(reports.observation_report(pipeline.run_silver(_imported(spark, sf_dir)).observation))


@query
def stored_silver_condition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver stored and read back, without the names of the files, which the writer has chosen."""
    warehouse = _imported(spark, sf_dir)
    conditions = pipeline.save_silver_tables(warehouse, pipeline.run_silver(warehouse)).condition
    return conditions.drop("source_file").withColumn("validation_errors", _joined("validation_errors"))


@query
def added_bronze_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads of a directory that grows: the second adds the new files only. Then a third that finds none."""
    folder = _new_folder(spark)
    warehouse = _warehouse(spark, folder)
    for makers in ((patient_bundles, condition_bundles), (observation_bundles,), ()):
        _write_lines(spark, sf_dir, f"{folder}/in", *makers)
        pipeline.run_bronze_new(warehouse, f"{folder}/in", lines=True, names=LINES)
    return warehouse.summary("bronze")


@query
def malformed_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fifth order's bundle is cut off: what is kept aside, beside the rows of the others."""
    folder = _new_folder(spark)
    made = observation_bundles(spark, sf_dir).select(F.col("bundle").alias("value"))
    cut = F.col("value").rlike('"id":"order-[0-9]*[05]"')
    made.select(F.when(cut, F.expr("left(value, length(value) - 2)")).otherwise(F.col("value")).alias("value")).write.text(f"{folder}/in")
    warehouse = _warehouse(spark, folder)
    pipeline.run_bronze(warehouse, f"{folder}/in", lines=True, quarantine=True, names="*.txt")
    bad = warehouse.malformed().select(F.regexp_extract("text", '"id":"(order-[0-9]+)"', 1).alias("bundle"), F.lit("malformed").alias("kind"))
    good = warehouse.bronze("Observation").select(F.col("_source_bundle").alias("bundle"), F.lit("loaded").alias("kind"))
    return bad.unionByName(good)


# Tables and Parquet files.


def _register_tables(spark: SparkSession, sf_dir: str) -> None:
    tables.ensure_schema(spark, DATABASE)
    for name in TABLES:
        tables.drop_table_if_exists(spark, DATABASE, name)
        spark.catalog.createTable(tables.quote(DATABASE, name), path=f"{sf_dir}/{name}.parquet", source="parquet")


@query
def table_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    _register_tables(spark, sf_dir)
    return tables.largest_first(tables.get_table_summary(spark, DATABASE))


@query
def sample_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Any ten rows are right, so the result is their number and how many of them the table has."""
    _register_tables(spark, sf_dir)
    sample = tables.sample_table(spark, DATABASE, "orders")
    kept = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key"), F.col("o_totalprice").alias("price"))
    found = sample.join(kept, (F.col("o_orderkey") == F.col("key")) & (F.col("o_totalprice") == F.col("price")), "left")
    return found.agg(F.count("*").alias("sampled"), F.count("key").alias("found"))


@query
def scan_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = parquet.read_from_parquet(spark, f"{sf_dir}/orders.parquet")
    return orders.select("o_orderkey", "o_custkey", "o_orderstatus")


@query
def read_and_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parquet.read_from_parquet_and_clean(spark, f"{sf_dir}/documents.parquet")


# Cleaning.


def _dirty_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with padded and blank text."""
    name = F.col("c_name")
    padded = (
        F.when(every("c_custkey", 4), F.concat(F.lit("  "), name, F.lit(" ")))
        .when(every("c_custkey", 4, 1), F.concat(F.lit("\t\n"), name, F.lit("\u00a0\u2003")))
        .when(every("c_custkey", 4, 2), F.lit("   "))
        .otherwise(name)
    )
    blank = F.when(every("c_custkey", 3), F.lit("")).otherwise(F.col("c_mktsegment"))
    customers = table(spark, sf_dir, "customer")
    return customers.select(F.col("c_custkey"), padded.alias("c_name"), blank.alias("c_mktsegment"), "c_acctbal")


@query
def lowercase_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    return cleaning.lowercase_columns(customers.toDF(*[name.upper() for name in customers.columns]))


@query
def trim_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.trim_string_columns(_dirty_customers(spark, sf_dir))


@query
def nullify_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.nullify_string_columns(_dirty_customers(spark, sf_dir))


@query
def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = _dirty_customers(spark, sf_dir)
    return cleaning.clean(customers.toDF(*[name.upper() for name in customers.columns]))


# Scalar functions.


@query
def string_to_boolean(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus")
    return booleans.convert_strings_to_boolean(lines, ["l_returnflag", "absent"], ["R"], ["N"])


@query
def map_to_boolean(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    return labels.select(
        "doc_id",
        booleans.map_to_boolean(F.col("toxic"), "1", "0").alias("toxic"),
        booleans.map_to_boolean(F.col("quality"), ["1", "yes"], ["no"]).alias("quality"),
    )


@query
def normalize_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.replace(F.upper("p_name"), F.lit(" "), F.lit("-"))
    return table(spark, sf_dir, "part").select("p_partkey", normalize_municipality_name(name).alias("name"))


def _shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = F.to_date("l_shipdate")
    length = F.col("l_quantity").cast("int")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        start.alias("start"),
        F.when(F.col("l_linenumber") != 3, F.date_add(start, length - 10)).alias("end"),
    )


@query
def datediff(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = dates.datediff(F.col("start"), F.col("end"))
    return _shipments(spark, sf_dir).select("l_orderkey", "l_linenumber", days.alias("days"))


@query
def datediff_business(spark: SparkSession, sf_dir: str) -> DataFrame:
    start, end = F.col("start"), F.col("end")
    first_days = F.array(F.trunc(start, "month"), F.trunc(end, "month"), start, start)
    ignored = F.when(F.col("l_linenumber") != 2, first_days)
    days = dates.datediff(start, end, ignored)
    return _shipments(spark, sf_dir).select("l_orderkey", "l_linenumber", days.alias("days"))


@query
def datediff_holidays(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = dates.datediff(F.col("start"), F.col("end"), holidays.get_finnish_holidays(spark, 2002, 1994))
    return _shipments(spark, sf_dir).select("l_orderkey", "l_linenumber", days.alias("days"))


@query
def holiday_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders on each Finnish holiday of the years that have orders."""
    per_day = table(spark, sf_dir, "orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count("*").alias("n"))
    years = per_day.select(F.year("day").alias("year")).distinct()
    calendar = holidays.holidays_of_years(years)
    return calendar.join(per_day, F.col("date") == F.col("day"), "left").select(
        "date", "name", "is_eve", F.coalesce("n", F.lit(0)).alias("orders")
    )


@query
def int_to_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.date_format("o_orderdate", "yyyyMMdd").cast("int")
    as_int = F.when(every("o_orderkey", 5), day + 9000).when(every("o_orderkey", 7), day % 10000000).otherwise(day)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", as_int.alias("order_day"))
    return dates.convert_ints_to_dates(orders, ["order_day"])


@query
def timestamp_to_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "ts", F.date_format("ts", "dd.MM.yyyy HH:mm").alias("text"))
    with_dates = dates.convert_timestamps_to_dates(events, ["ts", "absent"])
    return dates.convert_timestamps_to_dates(with_dates, ["text"], "%d.%m.%Y %H:%M")


# Typed frames.


@query
def typed_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = Order.from_df(table(spark, sf_dir, "orders"))
    return orders.select(Order.o_orderkey, orders.o_orderstatus).where(Order.o_custkey > 10)


@query
def typed_inheritance(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = FullOrder.from_df(table(spark, sf_dir, "orders"))
    return orders.select(*FullOrder.as_spark_schema().names)


@query
def typed_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").drop("o_orderdate")
    return FullOrder.from_df(orders, strict=True).df


@query
def typed_self_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    left, right = Order.from_df(orders.drop("o_orderstatus"), validate=False), Order.from_df(orders.drop("o_custkey"), validate=False)
    return left.join(right, on=Order.o_orderkey, how="inner").select(
        Order.o_orderkey, Order.o_custkey.alias("left_custkey"), Order.o_orderstatus.alias("right_status")
    )


class Segment(TypedDataFrame):
    c_mktsegment: Col[str]
    code: Col[int]


@query
def typed_from_dicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer with the code of its market segment, the codes as a typed frame from dictionaries."""
    names = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
    segments = Segment.from_dicts([{"c_mktsegment": name, "code": code} for code, name in enumerate(names)])
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return customers.join(segments.df, "c_mktsegment", "left").select("c_custkey", "code")


def _with_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    return with_columns(customers, F.upper("c_name").alias("c_name"), key_and_nation=F.concat_ws("/", "c_custkey", "c_nationkey"))


QUERIES["with_columns"] = _with_columns
