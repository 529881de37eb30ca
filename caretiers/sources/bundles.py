"""FHIR Bundle JSON to bronze rows: one row per resource, with lineage.

The resource stays a VARIANT, so no field is lost to schema inference, and a table of one
resource type is a filter on ``bronze_table``.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caretiers.operators.flatten import LINEAGE
from caretiers.sources import files

BUNDLE = "id string, entry array<struct<fullUrl:string,resource:variant>>"
BRONZE = "_source_file string, _source_bundle string, _full_url string, resource variant"


def _file_name() -> Column:
    # The metadata column is percent-encoded; a plus sign in it is a plus sign.
    return F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))


#: Where the rows of malformed bundles go. No table of a resource type has this name.
MALFORMED = "malformed-bundles"


def _options(lines: bool, quarantine: bool) -> dict[str, str]:
    mode = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "malformed"} if quarantine else {"mode": "FAILFAST"}
    return mode | {"multiLine": str(not lines)}


def _schema(quarantine: bool) -> str:
    return f"{BUNDLE}, malformed string" if quarantine else BUNDLE


def _columns(quarantine: bool) -> list[Column | str]:
    return [_file_name().alias("source_file"), "id", "entry", *["malformed"] * quarantine]


def read_bundle_files(spark: SparkSession, pattern: str, lines: bool = False, quarantine: bool = False) -> DataFrame:
    """Bundles of all files that a path pattern matches. Other arguments are those of ``read_bundles``."""
    return spark.read.schema(_schema(quarantine)).options(**_options(lines, quarantine)).json(pattern).select(*_columns(quarantine))


def read_bundles(spark: SparkSession, path: str, lines: bool = False, quarantine: bool = False, names: str = "*.json") -> DataFrame:
    """Bundles of all files in a directory whose names match ``names`` (subdirectories are not read),
    or of one file of any name.

    ``lines`` reads files with one bundle per line. They can be split over tasks, so prefer them
    for large imports. Malformed JSON fails the job; with ``quarantine`` it becomes a row whose column
    ``malformed`` has the text (of the file, or of the line), and that is null for good bundles.
    """
    pattern = files.escaped(path.rstrip("/"))
    if files.is_directory(spark, path):
        pattern = f"{pattern}/{names}"
        if not files.matches(spark, pattern):
            return spark.createDataFrame([], f"source_file string, {_schema(quarantine)}")
    return read_bundle_files(spark, pattern, lines, quarantine)


def stream_bundles(
    spark: SparkSession, path: str, lines: bool = False, quarantine: bool = False, names: str = "*.json", files_at_once: int = 100_000
) -> DataFrame:
    """The files of a directory as a stream, as ``read_bundles`` reads them, at most ``files_at_once`` in a batch."""
    reader = spark.readStream.schema(_schema(quarantine)).options(**_options(lines, quarantine)).option("maxFilesPerTrigger", files_at_once)
    # Without an age limit a file that is much older than the newest one would be left out.
    reader = reader.option("maxFileAge", "36500d")
    directory = files.escaped(path.rstrip("/"))
    if directory != path.rstrip("/"):
        # Spark 4.1 reads every file of a batch once for each file in it, if the directory's name has pattern characters.
        reader = reader.option("maxFilesPerTrigger", 1)
    return reader.json(f"{directory}/{names}").select(*_columns(quarantine))


def parse_bundles(df: DataFrame, text: str = "bundle", source_file: str = "source_file") -> DataFrame:
    """Bundles held as JSON text in a column."""
    bundle = F.from_json(F.col(text), BUNDLE, {"mode": "FAILFAST"})
    return df.select(F.col(source_file).alias("source_file"), bundle.alias("bundle")).select("source_file", "bundle.*")


NOT_IN_NAMES = "[^a-z0-9_]"


def table_name(resource_type: Column) -> Column:
    """Bronze table of a resource type: lower case, with _ for what a table name cannot hold."""
    return F.regexp_replace(F.lower(resource_type), NOT_IN_NAMES, "_")


def table_name_of(resource_type: str) -> str:
    """``table_name`` of a type known in advance."""
    return re.sub(NOT_IN_NAMES, "_", resource_type.lower())


def explode_entries(bundles: DataFrame) -> DataFrame:
    """Bronze rows of all bundles: ``bronze_table``, lineage and the resource.

    Entries without a resource type are left out. A resource that itself has a field named like a
    lineage column keeps its own value. A malformed bundle is one row of the table ``MALFORMED``, with its
    text as the resource.
    """
    malformed = ["malformed"] if "malformed" in bundles.columns else []
    # The outer form, because the optimiser filters on the array before a plain explode, and
    # would parse bundles held as text once more for that. The empty rows have no type.
    # What could be read of a malformed bundle is not used: it is one row.
    entry = "explode_outer(if(malformed IS NULL, entry, NULL)) AS entry" if malformed else "explode_outer(entry) AS entry"
    entries = bundles.selectExpr("source_file", "id", entry, *malformed).selectExpr(
        "source_file",
        "id",
        *malformed,
        "entry.fullUrl AS full_url",
        "entry.resource AS resource",
        "try_variant_get(entry.resource, '$.resourceType', 'string') AS resource_type",
    )
    own = "struct<" + ",".join(f"{name}:variant" for name in LINEAGE) + ">"
    wanted = "resource_type <> ''" + (" OR malformed IS NOT NULL" if malformed else "")
    typed = entries.where(wanted).selectExpr("*", f"try_variant_get(resource, '$', '{own}') AS own")
    lineage = [
        f"CASE WHEN own.{name} IS NULL THEN {given} ELSE try_variant_get(own.{name}, '$', 'string') END AS {name}"
        for name, given in zip(LINEAGE, ["source_file", "id", "full_url"], strict=True)
    ]
    if not malformed:
        return typed.select(table_name(F.col("resource_type")).alias("bronze_table"), *[F.expr(column) for column in lineage], "resource")
    bad = F.col("malformed").isNotNull()
    return typed.select(
        F.when(bad, MALFORMED).otherwise(table_name(F.col("resource_type"))).alias("bronze_table"),
        *[F.expr(column) for column in lineage],
        F.when(bad, F.col("malformed").cast("variant")).otherwise(F.col("resource")).alias("resource"),
    )


def load_bronze_bundles(spark: SparkSession, path: str, lines: bool = False, quarantine: bool = False, names: str = "*.json") -> DataFrame:
    """Bronze rows of a directory of bundles (or one file), all resource types in one frame."""
    return explode_entries(read_bundles(spark, path, lines, quarantine, names))


load_bronze_bundle_file = load_bronze_bundles


def of_type(entries: DataFrame, resource_type: str) -> DataFrame:
    """Bronze rows of one resource type."""
    return entries.where(F.col("bronze_table") == table_name(F.lit(resource_type))).drop("bronze_table")


def frames_by_type(entries: DataFrame) -> dict[str, DataFrame]:
    """One frame per resource type found. Finding them reads the data once; only the names are collected."""
    names = sorted(row[0] for row in entries.select("bronze_table").distinct().collect())
    return {name: of_type(entries, name) for name in names}


def resource_counts(entries: DataFrame) -> DataFrame:
    """Rows per resource type."""
    return entries.groupBy("bronze_table").agg(F.count("*").alias("rows"))


#: Field names (quoted, or before a colon) and the types that columns cannot have.
_NAME_OR_TYPE = re.compile(r"`(?:[^`]|``)*`|\w+(?=\s*:)|OBJECT(?=<)|VOID")


def column_types(variant_schema: str) -> str:
    """The schema of a variant as column types: objects are structs, and what is null in all rows stays a variant."""
    types = {"OBJECT": "STRUCT", "VOID": "VARIANT"}

    def column_type(found: re.Match) -> str:
        named = found[0].startswith("`") or variant_schema[found.end() :].lstrip().startswith(":")
        return found[0] if named else types[found[0]]

    return _NAME_OR_TYPE.sub(column_type, variant_schema)


def schema_of_types() -> Column:
    """An aggregate over bronze rows of all types: an object with a field for each type, its resources' merged schema."""
    return F.schema_of_variant_agg(F.to_variant_object(F.create_map("bronze_table", "resource")))


def schemas_by_type(merged: str | None) -> dict[str, str]:
    """The schema of each type from ``schema_of_types``."""
    found, start = {}, len("OBJECT<")
    while merged and start < len(merged):
        name, colon = _field_name(merged, start)
        end = _end_of_type(merged, colon)
        found[name] = merged[colon:end].strip()
        start = end + 1
    return found


def _field_name(schema: str, start: int) -> tuple[str, int]:
    """The name of the field that begins there, and where its type begins."""
    found = re.compile(r"\s*(?:`((?:[^`]|``)*)`|([^:`]+))\s*:\s*").match(schema, start)
    return (found[2] or found[1].replace("``", "`")).strip(), found.end()


def _end_of_type(schema: str, start: int) -> int:
    """Where the type that begins there ends: at a comma or a closing bracket of the object around it."""
    depth, quoted = 0, False
    for i in range(start, len(schema)):
        c = schema[i]
        quoted ^= c == "`"
        if quoted:
            continue
        if depth == 0 and c in ",>":
            return i
        # A decimal's brackets hold a comma too.
        depth += (c in "<(") - (c in ">)")
    return len(schema)


def nested_columns(bronze: DataFrame, schema: str | None = None) -> DataFrame:
    """The resource as nested columns, one per JSON field, with the schema merged over all rows.

    Without ``schema``, as ``schema_of_variant_agg`` gives it, finding it is one aggregate over the data. To
    skip that, read the fields you need with ``functions.fhir.read``; of stored bronze, ``Warehouse.nested`` knows it.
    """
    if schema is None:
        schema = bronze.agg(F.schema_of_variant_agg("resource")).first()[0]
    if not schema.startswith("OBJECT<") or schema == "OBJECT<>":
        return bronze.select(*LINEAGE)
    fields = F.try_variant_get("resource", "$", column_types(schema))
    nested = bronze.select(*LINEAGE, fields.alias("fields"))
    names = [name for name in nested.schema["fields"].dataType.names if name not in LINEAGE]
    return nested.select(*LINEAGE, *[F.col("fields")[name].alias(name) for name in names])
