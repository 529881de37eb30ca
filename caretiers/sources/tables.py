"""Tables of the bronze, silver and gold databases."""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from caretiers.contracts import Schema
from caretiers.sources import files
from caretiers.sources.bundles import BRONZE, MALFORMED, nested_columns, schema_of_types, schemas_by_type, table_name_of
from caretiers.typed import TypedDataFrame, plain


#: Of each layer, which directories are its tables' rows. Files with such names are not read as data.
MANIFEST = "_manifest.json"

#: Codec of the stored files.
COMPRESSION = "zstd"

#: Types whose files a task writes side by side; it sorts the rows of further ones.
TYPES_AT_ONCE = 16

#: A type whose files are smaller on average than this part of the advisory partition size is packed into fewer.
SMALL_FILE = 1 / 16

#: The part of that size which a packed file has.
PACKED_FILE = 1 / 4

#: Ends the name of a load's directory that holds its packed types.
PACKED = ".packed"


def quote(*parts: str) -> str:
    """Quoted, dotted SQL name."""
    return ".".join("`" + part.replace("`", "``") + "`" for part in parts)


def _literal(text: str) -> str:
    """Text as a literal of SQL."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def ensure_schema(spark: SparkSession, schema: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quote(schema)}")


def drop_table_if_exists(spark: SparkSession, schema: str, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {quote(schema, table)}")


def get_table_names(spark: SparkSession, schema: str) -> list[str]:
    """Names of the tables in a database, without views and temporary tables, sorted."""
    if not spark.catalog.databaseExists(schema):
        return []
    tables = spark.catalog.listTables(schema)
    return sorted(t.name for t in tables if not t.isTemporary and "VIEW" not in (t.tableType or ""))


def get_table_summary(spark: SparkSession, schema: str) -> DataFrame:
    """Rows of every table in a database, as (``table``, ``rows``); one job for all of them."""
    counts = [
        spark.table(quote(schema, name)).agg(F.count("*").alias("rows")).select(F.lit(f"{schema}.{name}").alias("table"), "rows")
        for name in get_table_names(spark, schema)
    ]
    if not counts:
        return spark.createDataFrame([], "table string, rows bigint")
    return reduce(DataFrame.unionByName, counts)


def count_rows(spark: SparkSession, tables: Mapping[str, Sequence[str]], schema: str | None = None) -> DataFrame:
    """Rows of tables given by their Parquet directories, as (``table``, ``rows``).

    The numbers come from the files' footers: counting is pushed down into the scan, which only the newer readers
    do. So the frame has a session of its own, with the same catalog.
    """
    footers = spark.newSession()
    footers.conf.set("spark.sql.sources.useV1SourceList", "")
    footers.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    reader = footers.read.schema(schema) if schema else footers.read
    counts = [reader.parquet(*places).agg(F.count("*").alias("rows")).select(F.lit(name).alias("table"), "rows") for name, places in tables.items()]
    if not counts:
        return footers.createDataFrame([], "table string, rows bigint")
    # A count that was pushed down is null for a table without rows.
    return reduce(DataFrame.unionByName, counts).groupBy("table").agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"))


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """The session's setting while the block runs."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def largest_first(summary: DataFrame) -> DataFrame:
    return summary.orderBy(F.desc("rows"), "table")


def sample_table(spark: SparkSession, schema: str, table: str, rows: int = 10) -> DataFrame:
    return spark.table(quote(schema, table)).limit(rows)


class Warehouse:
    """The layers' tables as Parquet directories under ``root``, registered in the catalog.

    Rows are written to new directories and become a table's rows when the layer's manifest, a small file
    that lists each table's directories, is replaced. A write that fails changes nothing: readers and later
    sessions see the rows from before it. What the manifest of the write before last listed, and what failed
    writes left, is deleted by the next one. One application writes to a layer at a time.

    Bronze has a directory for each load and type. A type's tables in the catalog are partitioned by ``load``.
    The catalog's tables are in databases named ``prefix`` and the layer, for SQL; a table of that name which
    lies elsewhere is never replaced. Opening the same root in another session finds its rows again.
    """

    def __init__(self, spark: SparkSession, root: str, prefix: str = ""):
        self.spark = spark
        self.root = root.rstrip("/")
        self.prefix = prefix
        for schema in Schema:
            ensure_schema(spark, self.database(schema))

    def database(self, schema: str) -> str:
        return f"{self.prefix}{schema}"

    def path(self, schema: str) -> str:
        return f"{self.root}/{schema}"

    def manifest(self, schema: str) -> dict[str, list[str]]:
        """The directories of each table, relative to the layer's."""
        return self._kept(schema)["tables"]

    def _kept(self, schema: str) -> dict[str, dict]:
        """The manifest: ``tables``, and of bronze's directories the ``schemas`` of their resources."""
        text = files.read_text(self.spark, f"{self.path(schema)}/{MANIFEST}")
        return json.loads(text) if text else {"tables": {}, "schemas": {}}

    def places(self, schema: str, table: str) -> list[str]:
        return [f"{self.path(schema)}/{place}" for place in self.manifest(schema).get(table, [])]

    def tables(self, schema: str) -> list[str]:
        """Names of the layer's stored tables; no data is read."""
        return sorted(table for table in self.manifest(schema) if table != MALFORMED)

    def write(self, schema: str, table: str, df: DataFrame | TypedDataFrame) -> None:
        """Create the table or replace it, schema included. ``df`` may be made of the table's own rows."""
        self._own_name(schema, table)
        place = f"{table}/version={uuid.uuid4().hex}"
        plain(df).write.parquet(f"{self.path(schema)}/{place}", compression=COMPRESSION)
        self._commit(schema, {table: [place]})

    def write_all(self, schema: str, frames: Mapping[str, DataFrame | TypedDataFrame]) -> None:
        for table, df in frames.items():
            self.write(schema, table, df)

    def read(self, schema: str, table: str) -> DataFrame:
        reader = self.spark.read.schema(BRONZE) if schema == Schema.BRONZE else self.spark.read
        places = self.places(schema, table)
        if not places:
            raise ValueError(f"{self.root} has no table {schema}.{table}")
        return reader.parquet(*places)

    def summary(self, schema: str) -> DataFrame:
        """Rows of every stored table of a layer, as (``table``, ``rows``), from the files' footers; one job for all."""
        places = {f"{schema}.{name}": self.places(schema, name) for name in self.tables(schema)}
        return count_rows(self.spark, places, BRONZE if schema == Schema.BRONZE else None)

    def write_bronze(self, entries: DataFrame) -> None:
        """Write all resource types in one job; each type's rows replace its earlier ones.

        Types that are not in this load keep their earlier rows.
        """
        added, schemas = self._load(entries, uuid.uuid4().hex)
        self._commit(Schema.BRONZE, {table: [place] for table, place in added.items()}, schemas)

    def add_bronze(self, entries: DataFrame, load: str) -> None:
        """Write all resource types in one job, beside the rows of earlier loads.

        A load that is already there is not added again, so a load may be repeated after a failure.
        """
        before = self.manifest(Schema.BRONZE)
        if any(place.startswith((f"load={load}/", f"load={load}{PACKED}/")) for places in before.values() for place in places):
            return
        added, schemas = self._load(entries, load)
        self._commit(Schema.BRONZE, {table: [*before.get(table, []), place] for table, place in added.items()}, schemas)

    def compact_bronze(self, resource_type: str) -> None:
        """Write a type's rows of many loads as those of one."""
        name = table_name_of(resource_type)
        rows = self.bronze(resource_type).withColumn("bronze_table", F.lit(name))
        added, schemas = self._load(rows, uuid.uuid4().hex)
        self._commit(Schema.BRONZE, {name: [place] for place in added.values()}, schemas)

    def _load(self, entries: DataFrame, load: str) -> tuple[dict[str, str], dict[str, str]]:
        """Write a load; gives the directory of each type in it, and the schema of the resources in each directory.

        Schemas are merged while the rows go by on their way to the files.

        Tasks write the rows they have read, a file for each type among them, so a load needs no disk beside its
        tables, and a type that holds most rows is written by many tasks. Types of small files are packed then, so a
        rare one does not keep a file per task. Where fewer tasks read than there are cores (a large file that cannot
        be split is one), and for other plans than a read, rows are rebalanced by type on their real sizes first, so
        that types are written by different tasks. That is adaptive execution's work and needs it.
        """
        spark = entries.sparkSession
        if self.spark.conf.get("spark.sql.adaptive.enabled") != "true":
            raise ValueError("writing bronze needs spark.sql.adaptive.enabled, or one task would write all rows of a type")
        path = f"{self.path(Schema.BRONZE)}/load={load}"
        seen = Observation()
        rows = entries.observe(seen, schema_of_types().alias("types"))
        if files.tasks_reading(entries) < spark.sparkContext.defaultParallelism:
            rows = rows.hint("rebalance", "bronze_table")
        with setting(spark, "spark.sql.maxConcurrentOutputFileWriters", str(TYPES_AT_ONCE)):
            rows.write.partitionBy("bronze_table").mode("overwrite").parquet(path, compression=COMPRESSION)
        start = "bronze_table="
        names = [name for name in files.directories(self.spark, path) if name.startswith(start)]
        places = {name.removeprefix(start): f"load={load}/{name}" for name in names}
        schemas = schemas_by_type(seen.get["types"]) if places else {}
        places |= self._packed(load, places)
        return places, {place: schemas[table] for table, place in places.items()}

    def _packed(self, load: str, places: Mapping[str, str]) -> dict[str, str]:
        """Write the types whose files are small as fewer files; gives their new directories.

        One job without a shuffle: a task reads files of one type. The files it has read go with the commit.
        """
        advisory = files.bytes_of(self.spark, self.spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes"))
        root, small = self.path(Schema.BRONZE), []
        for table, place in places.items():
            sizes = files.sizes(self.spark, f"{root}/{place}", ".parquet")
            if len(sizes) > 1 and sum(sizes) < SMALL_FILE * advisory * len(sizes):
                rows = self.spark.read.schema(BRONZE).parquet(f"{root}/{place}").coalesce(math.ceil(sum(sizes) / (PACKED_FILE * advisory)))
                small.append((table, rows.withColumn("bronze_table", F.lit(table))))
        if not small:
            return {}
        rows = reduce(DataFrame.unionByName, [rows for _, rows in small])
        with setting(self.spark, "spark.sql.maxConcurrentOutputFileWriters", str(TYPES_AT_ONCE)):
            rows.write.partitionBy("bronze_table").mode("overwrite").parquet(f"{root}/load={load}{PACKED}", compression=COMPRESSION)
        return {table: f"load={load}{PACKED}/bronze_table={table}" for table, _ in small}

    def bronze(self, resource_type: str) -> DataFrame:
        """Bronze rows of one type; no rows if there is no such table."""
        name = table_name_of(resource_type)
        if not self.places(Schema.BRONZE, name):
            return self.spark.createDataFrame([], BRONZE)
        return self.read(Schema.BRONZE, name)

    def nested(self, resource_type: str) -> DataFrame:
        """Bronze rows of one type with a column for each JSON field.

        The schema was kept when the rows were written. Only where loads with different schemas lie side by side
        is it merged over the rows; ``compact_bronze`` makes them one.
        """
        name, rows = table_name_of(resource_type), self.bronze(resource_type)
        kept = self._kept(Schema.BRONZE)
        schemas = {kept["schemas"].get(place) for place in kept["tables"].get(name, [])}
        if not schemas:
            return nested_columns(rows, "OBJECT<>")
        return nested_columns(rows, schemas.pop() if len(schemas) == 1 else None)

    def malformed(self) -> DataFrame:
        """Bundles that could not be parsed, where loads were told to keep them: ``source_file`` and ``text``."""
        columns = ["_source_file AS source_file", "try_variant_get(resource, '$', 'string') AS text"]
        if not self.places(Schema.BRONZE, MALFORMED):
            return self.spark.createDataFrame([], "source_file string, text string")
        return self.read(Schema.BRONZE, MALFORMED).selectExpr(*columns)

    def attach(self) -> None:
        """Register the tables an earlier session left under ``root``."""
        for schema in Schema:
            for table in self.tables(schema):
                self._register(schema, table)

    def _commit(self, schema: str, changed: dict[str, list[str]], schemas: Mapping[str, str] | None = None) -> None:
        """The directories become the tables' rows. Until the manifest is replaced nothing has changed."""
        kept = self._kept(schema)
        before = kept["tables"]
        after = before | changed
        current = {place for places in after.values() for place in places}
        known = {place: text for place, text in (kept["schemas"] | dict(schemas or {})).items() if place in current}
        files.replace_text(self.spark, f"{self.path(schema)}/{MANIFEST}", json.dumps({"tables": after, "schemas": known}, indent=1))
        for table in changed:
            if table != MALFORMED:
                self._register(schema, table)
        used = current | {place for places in before.values() for place in places}
        for directory in files.directories(self.spark, self.path(schema)):
            if directory.startswith("_"):
                continue
            below = [f"{directory}/{name}" for name in files.directories(self.spark, f"{self.path(schema)}/{directory}")]
            for place in below:
                if place not in used and not place.endswith("/_temporary"):
                    files.delete(self.spark, f"{self.path(schema)}/{place}")
            if not used.intersection(below):
                files.delete(self.spark, f"{self.path(schema)}/{directory}")

    def _register(self, schema: str, table: str) -> None:
        """Make the catalog's table the rows that the manifest lists."""
        name = self._own_name(schema, table)
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        places = self.places(schema, table)
        if schema != Schema.BRONZE:
            self.spark.catalog.createTable(name, path=places[0], source="parquet", schema=self.read(schema, table).schema)
            return
        root = files.qualified(self.spark, self.path(schema))
        self.spark.sql(f"CREATE TABLE {name} ({BRONZE}, `load` string) USING parquet PARTITIONED BY (`load`) LOCATION {_literal(root)}")
        for place in places:
            load = place.split("/")[-2].removeprefix("load=")
            at = files.qualified(self.spark, place)
            self.spark.sql(f"ALTER TABLE {name} ADD PARTITION (`load` = {_literal(load)}) LOCATION {_literal(at)}")

    def _own_name(self, schema: str, table: str) -> str:
        """The table's name in the catalog; an error if another place has it."""
        name = quote(self.database(schema), table)
        if self.spark.catalog.tableExists(name):
            about = self.spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").first()
            place = files.qualified(self.spark, about["data_type"]) if about else "a view"
            if not f"{place}/".startswith(f"{files.qualified(self.spark, self.path(schema))}/"):
                raise ValueError(f"{name} is {place}, not of the warehouse {self.root}; give this warehouse another prefix")
        return name
