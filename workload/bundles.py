"""FHIR bundles made from the test tables, one line of JSON per table row.

Customers become patients, orders become observations and line items become conditions. Some
rows get defects by their key, so that every validation rule fires. No row is left out, and no
rows are grouped: a bundle is as large as one table row.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caretiers.contracts import IDENTIFIER_ECI, IDENTIFIER_MR, NATIONALITY_EXTENSION, SYSTEMS
from caretiers.functions.fhir import CODING


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dealt(rows: DataFrame, key: str) -> DataFrame:
    """The rows dealt out by key, at any size; adaptive execution chooses the number of tasks.

    A test table has one row group, which is one task however many cores there are, and making bundles of
    rows takes much longer than reading them. Imported bundles come from many files or splits and are not
    dealt out.
    """
    return rows.repartition(key)


def every(key: str, n: int, remainder: int = 0) -> Column:
    return F.col(key) % n == remainder


def obj(**fields: Column | str | None) -> Column:
    """Struct of the given fields; plain text is a constant."""
    return F.struct(
        *[(value if isinstance(value, Column) else F.lit(value)).alias(name) for name, value in fields.items()]
    )


def _coding(system: Column | str | None, code: Column | str | None, display: Column | str | None) -> Column:
    return obj(system=system, code=code, display=display).cast(CODING)


def _bundle(bundle_id: Column, *entries: Column) -> Column:
    """JSON text of a bundle; ``entries`` are JSON texts, and null ones are left out."""
    return F.concat(
        F.lit('{"resourceType":"Bundle","id":"'), bundle_id, F.lit('","entry":['), F.concat_ws(",", *entries), F.lit("]}")
    ).alias("bundle")


def _entry(resource: Column, full_url: Column | None = None) -> Column:
    url = [F.lit('"fullUrl":"'), full_url, F.lit('",')] if full_url is not None else []
    return F.concat(F.lit("{"), *url, F.lit('"resource":'), resource, F.lit("}"))


# The columns of the bundles hold for any tables, and making them takes longer than a small query, so
# each set is made once.


def patient_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    customers = dealt(table(spark, sf_dir, "customer"), "c_custkey").join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return customers.select(*_of_customers())


@cache
def _of_customers() -> tuple[Column, ...]:
    key = F.col("c_custkey")
    segment = F.col("c_mktsegment")
    gender = (
        F.when(segment == "AUTOMOBILE", "male")
        .when(segment == "BUILDING", "female")
        .when(segment == "FURNITURE", "other")
        .when(segment == "MACHINERY", "unknown")
        .otherwise("invalid")
    )
    born = F.date_add(F.lit("1940-01-01").cast("date"), (key % 25000).cast("int")).cast("string")
    given = F.array(F.lit("A"), F.lit("B"))
    nickname = F.when(every("c_custkey", 7), obj(use="nickname", family=F.lit(None).cast("string"), given=F.lit(None).cast("array<string>")))
    # The nickname has no family name, so the second name is the one to use.
    names = F.array_compact(F.array(nickname, obj(use=F.lit(None).cast("string"), family=F.col("c_name"), given=given)))
    phone = F.when(every("c_custkey", 20), "none").otherwise(F.concat(F.lit("+358 "), key))
    nation_name = F.col("n_name")
    mr = F.when(~every("c_custkey", 6), obj(system=IDENTIFIER_MR, value=F.concat(F.lit("mr-"), key)))
    extension = "struct<url:string,valueCodeableConcept:struct<coding:array<struct<code:string>>>>"
    no_coding = F.array().cast("array<struct<code:string>>")
    patient = obj(
        resourceType="Patient",
        id=F.when(~every("c_custkey", 97), key.cast("string")),
        birthDate=F.when(every("c_custkey", 10, 1), "not-a-date").when(~every("c_custkey", 10, 2), born),
        gender=gender,
        name=F.when(~every("c_custkey", 50), names),
        telecom=F.array(obj(system="email", value="mail@example.org"), obj(system="phone", value=phone)),
        address=F.array(
            obj(
                line=F.array(segment, F.concat(F.lit("door "), key)),
                city=F.concat(nation_name, F.lit(" city")),
                postalCode=F.lpad((key % 100000).cast("string"), 5, "0"),
                country=nation_name,
            )
        ),
        identifier=F.array(obj(system=IDENTIFIER_ECI, value=F.concat(F.lit("eci-"), key)), mr),
        extension=F.array(
            obj(url="http://example.org/other", valueCodeableConcept=None).cast(extension),
            F.when(every("c_custkey", 4), obj(url=NATIONALITY_EXTENSION, valueCodeableConcept=obj(coding=no_coding))),
            obj(url=NATIONALITY_EXTENSION, valueCodeableConcept=obj(coding=F.array(obj(code=nation_name)))),
        ),
    )
    organization = obj(resourceType="Organization", id=F.col("c_nationkey").cast("string"), name=nation_name)
    return (
        F.lit("customers.json").alias("source_file"),
        _bundle(
            F.concat(F.lit("bundle-"), key),
            _entry(F.to_json(patient), F.concat(F.lit("urn:uuid:"), key)),
            _entry(F.to_json(organization)),
        ),
    )


def observation_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dealt(table(spark, sf_dir, "orders"), "o_orderkey").select(*_of_orders())


@cache
def _of_orders() -> tuple[Column, ...]:
    key, status, priority = "o_orderkey", F.col("o_orderstatus"), F.col("o_orderpriority")
    customer, price = F.col("o_custkey"), F.col("o_totalprice")
    order_date = F.to_date("o_orderdate")
    day = order_date.cast("string")
    reference = (
        F.when(every(key, 31), None)
        .when(every("o_custkey", 13), F.concat(F.lit("Patient/former-"), customer))
        .when(every(key, 3), F.concat(F.lit("urn:uuid:"), customer))
        .otherwise(F.concat(F.lit("Patient/"), customer))
    )
    next_day = F.when(~every(key, 8), F.date_add(order_date, 1).cast("string"))
    codings = F.array(
        _coding(SYSTEMS["loinc"], "85354-9", status), _coding("http://example.org/p", F.substring(priority, 1, 1), None)
    )
    has_code = ~every(key, 23)
    laboratory = F.array(_coding(SYSTEMS["observation_category"], "laboratory", "Laboratory"))
    others = F.array(_coding("http://example.org/s", status, None), _coding(None, "extra", None))
    kind = F.col(key) % 7
    text_or_none = F.lit(None).cast("string")
    observation = obj(
        resourceType="Observation",
        id=F.col(key).cast("string"),
        status=F.when(every(key, 41), None).when(status == "F", "final").when(status == "O", "preliminary").otherwise(status),
        issued=F.concat(day, F.lit("T00:00:00Z")),
        subject=F.when(reference.isNotNull(), obj(reference=reference)),
        effectiveDateTime=F.when(every(key, 4), None).when(every(key, 37), "unknown").otherwise(day),
        effectivePeriod=F.when(every(key, 4), obj(start=day, end=next_day)),
        code=obj(text=F.when(has_code, priority), coding=F.when(has_code, codings).otherwise(F.array())),
        # A list may hold something that is no object; it is not counted.
        category=F.array(F.lit(None), obj(text=text_or_none, coding=laboratory), obj(text="second", coding=others)),
        performer=F.array(
            obj(reference=F.concat(F.lit("Practitioner/"), customer % 100)),
            obj(reference=text_or_none),
            obj(reference=F.concat(F.lit("urn:uuid:org-"), status)),
        ),
        valueQuantity=F.when(kind == 0, obj(value=price, unit="EUR", system=SYSTEMS["ucum"], code="EUR")),
        valueCodeableConcept=F.when(
            kind == 2, obj(text=priority, coding=F.array(_coding(SYSTEMS["snomed_ct"], status, None)))
        ),
        valueString=F.when(kind == 3, priority),
        valueBoolean=F.when((kind == 4) & ~every(key, 11), status == "F"),
        valueInteger=F.when((kind == 5) & ~every(key, 11), customer),
        component=F.when(
            ~every(key, 9),
            F.array(
                obj(
                    code=obj(text=text_or_none, coding=F.array(_coding(SYSTEMS["loinc"], "8480-6", "Total"))),
                    valueQuantity=obj(value=price, unit="EUR"),
                    valueString=text_or_none,
                ),
                F.lit(None),
                obj(
                    code=obj(text=priority, coding=F.lit(None).cast(f"array<{CODING}>")),
                    valueQuantity=F.lit(None).cast("struct<value:double,unit:string>"),
                    valueString=status,
                ),
            ),
        ),
    )
    # Values of a JSON type that does not fit the column: numbers as text, and the like.
    number_text = F.when(every(key, 43), "Infinity").otherwise(price.cast("string"))
    misfit = (
        F.when(kind == 1, F.concat(F.lit(',"valueQuantity":{"value":"'), number_text, F.lit('"}}')))
        .when((kind == 4) & every(key, 11), F.lit(',"valueBoolean":"true"}'))
        .when((kind == 5) & every(key, 11), F.lit(',"valueInteger":3.5}'))
        .otherwise(F.lit("}"))
    )
    text = F.to_json(observation)
    resource = F.concat(F.left(text, F.length(text) - 1), misfit)
    # Entries without a resource or a resource type; the loader leaves them out.
    unfinished = F.when(status == "P", F.lit('{"resource":null},{"resource":{"id":"x"}},{"resource":{"resourceType":""}}'))
    return (
        F.concat(F.lit("orders-"), F.substring(day, 1, 7), F.lit(".json")).alias("source_file"),
        _bundle(F.concat(F.lit("order-"), F.col(key)), _entry(resource), unfinished),
    )


def condition_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dealt(table(spark, sf_dir, "lineitem"), "l_orderkey").select(*_of_lines())


@cache
def _of_lines() -> tuple[Column, ...]:
    part, supplier, flag, line = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_returnflag"), F.col("l_linestatus")
    ship_date = F.to_date("l_shipdate")
    day = ship_date.cast("string")
    onset = F.when(every("l_partkey", 17), F.concat(day, F.lit("T10:00:00Z"))).otherwise(day)
    encounter = _coding(SYSTEMS["condition_category"], "encounter-diagnosis", "Encounter")
    problem = _coding(SYSTEMS["condition_category"], "problem-list-item", "Problem")
    system = F.when(flag == "N", SYSTEMS["snomed_ct"]).when(flag == "A", SYSTEMS["icd_10"])
    code = F.when(~every("l_partkey", 21), part.cast("string"))
    display = F.when(~every("l_partkey", 12), F.concat(F.lit("Part "), part))
    has_subject = ~every("l_orderkey", 19)
    condition = obj(
        resourceType="Condition",
        id=F.when(~every("l_orderkey", 101), F.concat_ws("-", "l_orderkey", "l_linenumber")),
        clinicalStatus=F.when(line == "F", obj(text="active")),
        subject=F.when(
            has_subject,
            obj(reference=F.concat(F.lit("Patient/"), supplier), display=F.concat(F.lit("Supplier "), supplier)),
        ),
        category=F.when(
            flag == "R",
            F.array(obj(coding=F.array(_coding(None, None, "no code"))), obj(coding=F.array(encounter))),
        ).otherwise(F.array(obj(coding=F.array(problem)))),
        code=obj(coding=F.array(_coding(system, code, display)), text=F.when(line == "O", "").otherwise("text")),
        onsetDateTime=F.when(~every("l_partkey", 5), onset),
        _onsetDateTime=F.when(every("l_partkey", 5), obj(value=onset)),
        abatementDateTime=F.when(flag == "A", F.date_add(ship_date, 30).cast("string")),
        _abatementDateTime=F.when(flag == "R", obj(value="soon")),
        asserter=F.when(F.col("l_linenumber") == 1, obj(display=F.concat(F.lit("Dr "), supplier))),
    )
    return (
        F.concat(F.lit("lineitem-"), F.year(ship_date), F.lit(".json")).alias("source_file"),
        _bundle(F.concat_ws("-", F.lit("lines"), "l_orderkey"), _entry(F.to_json(condition))),
    )
