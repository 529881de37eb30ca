"""DuckDB SQL for the results of ``queries``, stated straight from the tables."""

from __future__ import annotations

from workload.queries import DATABASE, TABLES

PATIENT = """
patient AS (
  SELECT *, list_filter([
      CASE WHEN id IS NULL THEN 'id_required' END,
      CASE WHEN birth_date = 'not-a-date' THEN 'birth_date_format' END,
      CASE WHEN gender = 'invalid' THEN 'gender_valid' END,
      CASE WHEN phone = 'none' THEN 'phone_format' END,
      CASE WHEN family_name IS NULL THEN 'has_name' END
    ], lambda x: x IS NOT NULL) AS errors
  FROM (
    SELECT
      CASE WHEN c_custkey % 97 <> 0 THEN c_custkey::VARCHAR END AS id,
      'customers.json' AS source_file,
      'bundle-' || c_custkey AS source_bundle,
      CASE WHEN c_custkey % 50 <> 0 THEN c_name END AS family_name,
      CASE WHEN c_custkey % 50 <> 0 THEN 'A B' END AS given_names,
      NULL::VARCHAR AS full_name,
      CASE WHEN c_custkey % 10 = 1 THEN 'not-a-date'
           WHEN c_custkey % 10 <> 2 THEN strftime(DATE '1940-01-01' + (c_custkey % 25000)::INT, '%Y-%m-%d')
      END AS birth_date,
      CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'male' WHEN 'BUILDING' THEN 'female' WHEN 'FURNITURE' THEN 'other'
           WHEN 'MACHINERY' THEN 'unknown' ELSE 'invalid' END AS gender,
      CASE WHEN c_custkey % 20 = 0 THEN 'none' ELSE '+358 ' || c_custkey END AS phone,
      c_mktsegment || ', door ' || c_custkey AS address_line,
      n_name || ' city' AS city,
      lpad((c_custkey % 100000)::VARCHAR, 5, '0') AS postal_code,
      n_name AS country,
      n_name AS nationality_code,
      'eci-' || c_custkey AS identifier_eci,
      CASE WHEN c_custkey % 6 <> 0 THEN 'mr-' || c_custkey END AS identifier_mr,
      c_custkey, c_nationkey, c_mktsegment
    FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
  )
)"""

CONDITION = """
condition AS (
  SELECT *, list_filter([
      CASE WHEN id IS NULL THEN 'id_required' END,
      CASE WHEN code IS NULL THEN 'code_required' END,
      CASE WHEN code_display IS NULL THEN 'code_display_required' END,
      CASE WHEN patient_id IS NULL THEN 'patient_id_required' END,
      CASE WHEN length(onset_date) > 10 THEN 'onset_date_format' END,
      CASE WHEN abatement_date = 'soon' THEN 'abatement_date_format' END,
      CASE WHEN l_returnflag = 'A' THEN 'valid_code_system' END
    ], lambda x: x IS NOT NULL) AS errors
  FROM (
    SELECT
      CASE WHEN l_orderkey % 101 <> 0 THEN l_orderkey || '-' || l_linenumber END AS id,
      'lineitem-' || year(l_shipdate) || '.json' AS source_file,
      'lines-' || l_orderkey AS source_bundle,
      CASE WHEN l_orderkey % 19 <> 0 THEN l_suppkey::VARCHAR END AS patient_id,
      CASE WHEN l_orderkey % 19 <> 0 THEN 'Supplier ' || l_suppkey END AS patient_display,
      CASE WHEN l_returnflag = 'R' THEN 'encounter-diagnosis' ELSE 'problem-list-item' END AS category_code,
      CASE WHEN l_returnflag = 'R' THEN 'Encounter' ELSE 'Problem' END AS category_display,
      CASE l_returnflag WHEN 'N' THEN 'http://snomed.info/sct' WHEN 'A' THEN 'http://hl7.org/fhir/sid/icd-10' END AS code_system,
      CASE WHEN l_partkey % 21 <> 0 THEN l_partkey::VARCHAR END AS code,
      CASE WHEN l_partkey % 12 <> 0 THEN 'Part ' || l_partkey END AS code_display,
      CASE WHEN l_linestatus = 'O' THEN '' ELSE 'text' END AS code_text,
      strftime(l_shipdate, '%Y-%m-%d') || CASE WHEN l_partkey % 17 = 0 THEN 'T10:00:00Z' ELSE '' END AS onset_date,
      CASE l_returnflag WHEN 'A' THEN strftime(l_shipdate + INTERVAL 30 DAY, '%Y-%m-%d') WHEN 'R' THEN 'soon' END
        AS abatement_date,
      CASE WHEN l_linenumber = 1 THEN 'Dr ' || l_suppkey END AS asserter_display,
      l_orderkey, l_partkey, l_returnflag, l_linestatus
    FROM lineitem
  )
)"""

OBSERVATION = """
observation AS (
  SELECT *, list_filter([
      CASE WHEN status IS NULL THEN 'status_required' END,
      CASE WHEN status = 'P' THEN 'status_valid' END,
      CASE WHEN o_orderkey % 23 = 0 THEN 'code_present' END,
      CASE WHEN subject_reference IS NULL THEN 'subject_present' END,
      CASE WHEN effective_datetime = 'unknown' THEN 'effective_format' END,
      CASE WHEN kind NOT IN (0, 1, 2, 3) AND value_boolean IS NULL AND value_integer IS NULL AND component_count = 0
           THEN 'has_value_or_components' END,
      CASE WHEN kind = 1 THEN 'quantity_unit_if_value' END,
      CASE WHEN kind = 1 AND o_orderkey % 43 = 0 THEN 'quantity_value_finite' END
    ], lambda x: x IS NOT NULL) AS errors
  FROM (
    SELECT *,
      CASE WHEN starts_with(subject_reference, 'urn:uuid:') THEN substr(subject_reference, 10)
           ELSE substr(subject_reference, 9) END AS subject_id
    FROM (
      SELECT
        o_orderkey::VARCHAR AS id,
        'orders-' || strftime(o_orderdate, '%Y-%m') || '.json' AS source_file,
        'order-' || o_orderkey AS source_bundle,
        CASE WHEN o_orderkey % 41 <> 0 THEN
          CASE o_orderstatus WHEN 'F' THEN 'final' WHEN 'O' THEN 'preliminary' ELSE o_orderstatus END END AS status,
        CASE WHEN o_orderkey % 31 = 0 THEN NULL
             WHEN o_custkey % 13 = 0 THEN 'Patient/former-' || o_custkey
             WHEN o_orderkey % 3 = 0 THEN 'urn:uuid:' || o_custkey
             ELSE 'Patient/' || o_custkey END AS subject_reference,
        CASE WHEN o_orderkey % 8 = 0 THEN strftime(o_orderdate, '%Y-%m-%d')
             WHEN o_orderkey % 4 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') || '/' || strftime(o_orderdate + INTERVAL 1 DAY, '%Y-%m-%d')
             WHEN o_orderkey % 37 = 0 THEN 'unknown'
             ELSE strftime(o_orderdate, '%Y-%m-%d') END AS effective_datetime,
        strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS issued,
        NULL::VARCHAR AS category_text,
        'http://terminology.hl7.org/CodeSystem/observation-category' AS category_system,
        'laboratory' AS category_code,
        'Laboratory' AS category_display,
        CASE WHEN o_orderkey % 23 <> 0 THEN o_orderpriority END AS code_text,
        CASE WHEN o_orderkey % 23 <> 0 THEN 'http://loinc.org' END AS code_system,
        CASE WHEN o_orderkey % 23 <> 0 THEN '85354-9' END AS code_code,
        CASE WHEN o_orderkey % 23 <> 0 THEN o_orderstatus END AS code_display,
        CASE o_orderkey % 7 WHEN 0 THEN 'quantity' WHEN 1 THEN 'quantity' WHEN 2 THEN 'codeable_concept' WHEN 3 THEN 'string'
             WHEN 4 THEN 'boolean' WHEN 5 THEN 'integer' END AS value_type,
        CASE WHEN o_orderkey % 7 = 0 THEN o_totalprice
             WHEN o_orderkey % 7 = 1 AND o_orderkey % 43 = 0 THEN 'Infinity'::DOUBLE
             WHEN o_orderkey % 7 = 1 THEN o_totalprice END AS value_quantity_value,
        CASE WHEN o_orderkey % 7 = 0 THEN 'EUR' END AS value_quantity_unit,
        CASE WHEN o_orderkey % 7 = 0 THEN 'http://unitsofmeasure.org' END AS value_quantity_system,
        CASE WHEN o_orderkey % 7 = 0 THEN 'EUR' END AS value_quantity_code,
        CASE WHEN o_orderkey % 7 = 2 THEN o_orderpriority END AS value_codeable_concept_text,
        CASE WHEN o_orderkey % 7 = 2 THEN 'http://snomed.info/sct' END AS value_codeable_concept_system,
        CASE WHEN o_orderkey % 7 = 2 THEN o_orderstatus END AS value_codeable_concept_code,
        NULL::VARCHAR AS value_codeable_concept_display,
        CASE WHEN o_orderkey % 7 = 3 THEN o_orderpriority END AS value_string,
        CASE WHEN o_orderkey % 7 = 4 AND o_orderkey % 11 <> 0 THEN o_orderstatus = 'F' END AS value_boolean,
        CASE WHEN o_orderkey % 7 = 5 AND o_orderkey % 11 <> 0 THEN o_custkey END AS value_integer,
        NULL::VARCHAR AS value_datetime,
        'Practitioner/' || o_custkey % 100 || '|urn:uuid:org-' || o_orderstatus AS performer_references,
        o_custkey % 100 || '|org-' || o_orderstatus AS performer_ids,
        CASE WHEN o_orderkey % 23 <> 0 THEN 2 ELSE 0 END AS code_codings,
        3 AS category_codings,
        CASE WHEN o_orderkey % 9 <> 0 THEN 2 ELSE 0 END AS components,
        CASE WHEN o_orderkey % 9 <> 0 THEN 2 ELSE 0 END::BIGINT AS component_count,
        o_orderkey % 7 AS kind, o_orderkey, o_custkey, o_orderstatus, o_orderpriority, o_totalprice
      FROM orders
    )
  )
)"""

GOLD = """
gold AS (
  SELECT patient.id AS patient_id, count(observation.id) AS observation_count,
         TRY_CAST(birth_date AS DATE) AS birth_date,
         CAST(floor(date_diff('day', TRY_CAST(birth_date AS DATE), DATE '2025-01-01') / 365.0) AS BIGINT) AS patient_age_years
  FROM patient LEFT JOIN observation ON patient.id = observation.subject_id
  GROUP BY patient.id, patient.birth_date
)"""

# Easter by the Meeus arithmetic, unlike the library, which looks for the paschal full moon.
HOLIDAYS = """
years AS (YEARS),
parts AS (
  SELECT y, y % 19 AS a, y // 100 AS b, y % 100 AS c FROM years
),
moon AS (
  SELECT *, (19 * a + b - b // 4 - (b - (b + 8) // 25 + 1) // 3 + 15) % 30 AS h FROM parts
),
sunday AS (
  SELECT *, (32 + 2 * (b % 4) + 2 * (c // 4) - h - c % 4) % 7 AS l FROM moon
),
easter AS (
  SELECT y, make_date(y, n // 31, n % 31 + 1) AS e
  FROM (SELECT *, h + l - 7 * ((a + 11 * h + 22 * l) // 451) + 114 AS n FROM sunday)
),
holiday AS (
  SELECT unnest([
      {'date': make_date(y, 1, 1), 'name': 'Uudenvuodenpäivä'},
      {'date': make_date(y, 1, 6), 'name': 'Loppiainen'},
      {'date': e - 2, 'name': 'Pitkäperjantai'},
      {'date': e, 'name': 'Pääsiäispäivä'},
      {'date': e + 1, 'name': 'Toinen pääsiäispäivä'},
      {'date': make_date(y, 5, 1), 'name': 'Vappu'},
      {'date': e + 39, 'name': 'Helatorstai'},
      {'date': e + 49, 'name': 'Helluntaipäivä'},
      {'date': make_date(y, 6, 26) - (isodow(make_date(y, 6, 26)) + 1)::INT % 7 - 1, 'name': 'Juhannusaatto'},
      {'date': make_date(y, 6, 26) - (isodow(make_date(y, 6, 26)) + 1)::INT % 7, 'name': 'Juhannuspäivä'},
      {'date': make_date(y, 11, 6) - (isodow(make_date(y, 11, 6)) + 1)::INT % 7, 'name': 'Pyhäinpäivä'},
      {'date': make_date(y, 12, 6), 'name': 'Itsenäisyyspäivä'},
      {'date': make_date(y, 12, 24), 'name': 'Jouluaatto'},
      {'date': make_date(y, 12, 25), 'name': 'Joulupäivä'},
      {'date': make_date(y, 12, 26), 'name': 'Tapaninpäivä'}
    ], recursive := true)
  FROM easter
)"""

SHIPMENT = """
shipment AS (
  SELECT l_orderkey, l_linenumber, l_shipdate::DATE AS s,
         CASE WHEN l_linenumber <> 3 THEN l_shipdate::DATE + (l_quantity::INT - 10) END AS e
  FROM lineitem
)"""

DIRTY = """
dirty AS (
  SELECT c_custkey, c_acctbal,
         CASE c_custkey % 4 WHEN 0 THEN '  ' || c_name || ' ' WHEN 1 THEN chr(9) || chr(10) || c_name || chr(160) || chr(8195)
              WHEN 2 THEN '   ' ELSE c_name END AS c_name,
         CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_mktsegment END AS c_mktsegment
  FROM customer
)"""

# The white space that occurs in the tables or is added above.
TRIMMED = "trim({}, ' ' || chr(9) || chr(10) || chr(13) || chr(160) || chr(8195))"


def _select(columns: str, *ctes: str, source: str = "", tail: str = "") -> str:
    source = source or ctes[-1].strip().split()[0]
    return f"WITH {','.join(ctes)}\nSELECT {columns} FROM {source} {tail}"


def _observed(columns: str) -> str:
    return _select(columns, OBSERVATION)


_PATIENT_FLAT = """id, source_file, source_bundle, family_name, given_names, full_name, birth_date, gender, phone, address_line,
city, postal_code, country, nationality_code, identifier_eci, identifier_mr"""
_CONDITION_FLAT = """id, source_file, source_bundle, patient_id, patient_display, category_code, category_display, code_system,
code, code_display, code_text, onset_date, abatement_date, asserter_display"""
_OBSERVATION_FLAT = """id, source_file, source_bundle, status, subject_reference, subject_id, effective_datetime, issued,
category_text, category_system, category_code, category_display, code_text, code_system, code_code, code_display, value_type,
value_quantity_value, value_quantity_unit, value_quantity_system, value_quantity_code, value_codeable_concept_text,
value_codeable_concept_system, value_codeable_concept_code, value_codeable_concept_display, value_string, value_boolean,
value_integer, value_datetime, performer_references, performer_ids, code_codings, category_codings, components,
component_count"""
_ERRORS = "array_to_string(errors, '|') AS validation_errors"

_PATIENT_COUNTS = """count(family_name) AS with_family_name, count(given_names) AS with_given_names,
count(birth_date) AS with_birth_date, count(gender) AS with_gender, count(phone) AS with_phone, count(city) AS with_city,
count(nationality_code) AS with_nationality"""
_OBSERVATION_COUNTS = """count(*) AS total_observations, count(status) AS with_status, count(subject_reference) AS with_subject,
count(code_code) AS with_code, count(effective_datetime) AS with_effective_datetime, count(value_type) AS with_value,
count(CASE WHEN component_count > 0 THEN 1 END) AS with_components, count(performer_ids) AS with_performers"""


def _by_rule(table: str) -> str:
    return f"""(SELECT string_agg(error || ':' || n, '|' ORDER BY n DESC, error)
  FROM (SELECT error, count(*) AS n FROM (SELECT unnest(errors) AS error FROM {table}) GROUP BY error))"""


def _report(table: str) -> str:
    return f"""count(CASE WHEN len(errors) = 0 THEN 1 END) AS valid_records,
count(CASE WHEN len(errors) > 0 THEN 1 END) AS invalid_records,
count(CASE WHEN len(errors) = 0 THEN 1 END) / count(*) AS validity_rate, {_by_rule(table)} AS errors_by_rule"""


_OBSERVATION_FIELDS = (
    "with_status with_subject with_code with_effective_datetime with_value with_components with_performers".split()
)

_ALL_ENTRIES = f"""
WITH {PATIENT},{CONDITION},{OBSERVATION},
entries AS (
  SELECT 'patient' AS bronze_table, source_file AS _source_file, source_bundle AS _source_bundle,
         'urn:uuid:' || c_custkey AS _full_url, id FROM patient
  UNION ALL SELECT 'organization', source_file, source_bundle, NULL, c_nationkey::VARCHAR FROM patient
  UNION ALL SELECT 'observation', source_file, source_bundle, NULL, id FROM observation
  UNION ALL SELECT 'condition', source_file, source_bundle, NULL, id FROM condition
)"""

_YEARS_OF_ORDERS = HOLIDAYS.replace("YEARS", "SELECT DISTINCT year(o_orderdate)::INT AS y FROM orders")
_YEARS_1994_2002 = HOLIDAYS.replace("YEARS", "SELECT y::INT AS y FROM range(1994, 2003) t(y)")

_COMPONENTS = """
SELECT o_orderkey::VARCHAR AS id, i::BIGINT AS component_index,
  CASE WHEN i = 1 THEN o_orderpriority END AS code_text,
  CASE WHEN i = 0 THEN 'http://loinc.org' END AS code_system,
  CASE WHEN i = 0 THEN '8480-6' END AS code_code,
  CASE WHEN i = 0 THEN 'Total' END AS code_display,
  CASE WHEN i = 0 THEN 'quantity' ELSE 'string' END AS value_type,
  CASE WHEN i = 0 THEN o_totalprice END AS value_quantity_value,
  CASE WHEN i = 0 THEN 'EUR' END AS value_quantity_unit,
  NULL::VARCHAR AS value_quantity_system, NULL::VARCHAR AS value_quantity_code,
  NULL::VARCHAR AS value_codeable_concept_text, NULL::VARCHAR AS value_codeable_concept_system,
  NULL::VARCHAR AS value_codeable_concept_code, NULL::VARCHAR AS value_codeable_concept_display,
  CASE WHEN i = 1 THEN o_orderstatus END AS value_string,
  NULL::BOOLEAN AS value_boolean, NULL::BIGINT AS value_integer, NULL::VARCHAR AS value_datetime
FROM orders, (VALUES (0), (1)) t(i) WHERE o_orderkey % 9 <> 0"""

ORACLES: dict[str, str] = {
    "bronze_entries": f"{_ALL_ENTRIES} SELECT * FROM entries",
    "bronze_resource_counts": f'{_ALL_ENTRIES} SELECT bronze_table, count(*) AS "rows" FROM entries GROUP BY bronze_table',
    "bronze_totals": f"{_ALL_ENTRIES} SELECT count(DISTINCT bronze_table) AS types, count(*) AS resources FROM entries",
    "extension_value": _select("source_bundle, CASE WHEN c_custkey % 4 <> 0 THEN nationality_code END AS code", PATIENT),
    "bronze_table_patient": _select(
        """source_bundle AS _source_bundle, 'Patient' AS "resourceType", id, birth_date AS "birthDate", phone,
        replace(address_line, ', ', '|') AS address_line,
        CASE WHEN family_name IS NULL THEN NULL WHEN c_custkey % 7 = 0 THEN 2 ELSE 1 END AS names""",
        PATIENT,
    ),
    "obs_per_source_file_top5": _select(
        "source_file AS _source_file, count(*) AS observations",
        OBSERVATION,
        tail="GROUP BY source_file ORDER BY observations DESC, source_file LIMIT 5",
    ),
    "raw_summary_patient": _select(
        """count(*) AS total_patients, count(family_name) AS with_name, count(birth_date) AS with_birth_date,
        count(gender) AS with_gender, count(phone) AS with_telecom, count(address_line) AS with_address""",
        PATIENT,
    ),
    "raw_summary_condition": """
SELECT count(*) AS total_conditions, count(CASE WHEN l_orderkey % 19 <> 0 THEN 1 END) AS with_subject,
  count(*) AS with_code, count(*) AS with_category, count(CASE WHEN l_partkey % 5 <> 0 THEN 1 END) AS with_onset,
  count(CASE WHEN l_linestatus = 'F' THEN 1 END) AS with_clinical_status
FROM lineitem""",
    "raw_summary_observation": _select(
        """count(*) AS total_observations, count(status) AS with_status, count(subject_reference) AS with_subject,
        count(*) AS with_code, count(CASE WHEN o_orderkey % 4 <> 0 THEN 1 END) AS with_effective,
        count(CASE WHEN kind IN (0, 1) THEN 1 END) AS with_value_quantity,
        count(CASE WHEN o_orderkey % 9 <> 0 THEN 1 END) AS with_components""",
        OBSERVATION,
    ),
    "silver_patient": _select(f"{_PATIENT_FLAT}, {_ERRORS}", PATIENT),
    "silver_condition": _select(f"{_CONDITION_FLAT}, {_ERRORS}", CONDITION),
    "silver_observation": _observed(f"{_OBSERVATION_FLAT}, {_ERRORS}"),
    "silver_patient_errors": _select("source_bundle, unnest(errors) AS error", PATIENT),
    "silver_condition_errors": _select("source_bundle, unnest(errors) AS error", CONDITION),
    "silver_observation_errors": _observed("id, unnest(errors) AS error"),
    "reference_id": _observed("id, subject_reference, subject_id"),
    "effective_datetime": _observed("id, effective_datetime"),
    "value_type": _observed("id, value_type, value_string, value_boolean, value_integer"),
    "quantity_value": _observed("id, value_quantity_value, value_quantity_unit"),
    "telecom_phone": _select("source_bundle, phone", PATIENT),
    "identifier_by_system": _select("source_bundle, identifier_eci, identifier_mr", PATIENT),
    "given_names_join": _select("source_bundle, family_name, given_names, full_name", PATIENT),
    "nationality": _select("source_bundle, nationality_code", PATIENT),
    "first_coding": _select("id, code_system, code, code_display", CONDITION),
    "performer_ids": _observed("id, unnest(string_split(performer_ids, '|')) AS performer_id"),
    "coding_unnest": """
SELECT o_orderkey::VARCHAR AS id, 'http://loinc.org' AS system, '85354-9' AS code, o_orderstatus AS display
FROM orders WHERE o_orderkey % 23 <> 0
UNION ALL
SELECT o_orderkey::VARCHAR, 'http://example.org/p', substr(o_orderpriority, 1, 1), NULL FROM orders WHERE o_orderkey % 23 <> 0""",
    "category_codings": """
SELECT o_orderkey::VARCHAR AS id, 0::BIGINT AS category_index,
  'http://terminology.hl7.org/CodeSystem/observation-category' AS system, 'laboratory' AS code, 'Laboratory' AS display FROM orders
UNION ALL SELECT o_orderkey::VARCHAR, 1, 'http://example.org/s', o_orderstatus, NULL FROM orders
UNION ALL SELECT o_orderkey::VARCHAR, 1, NULL, 'extra', NULL FROM orders""",
    "components_unnest": _COMPONENTS,
    "components_inline": _COMPONENTS,
    "quantity_finite": _observed("id, CASE WHEN value_quantity_value IS NOT NULL THEN isfinite(value_quantity_value) END AS finite"),
    "valid_records": _select("id, status, subject_id", OBSERVATION, tail="WHERE len(errors) = 0"),
    "validation_summary": _select(
        "error, count(*) AS count", OBSERVATION, source="(SELECT unnest(errors) AS error FROM observation)", tail="GROUP BY error"
    ),
    "validation_report": _select(f"count(*) AS total_records, {_report('observation')}", OBSERVATION),
    "patient_report": _select(f"count(*) AS total_patients, {_PATIENT_COUNTS}, {_report('patient')}", PATIENT),
    "summary_patient": _select(f"count(*) AS total_patients, {_PATIENT_COUNTS}", PATIENT),
    "summary_condition": _select(
        """count(*) AS total_conditions, count(patient_id) AS with_patient_id, count(code) AS with_code,
        count(code_display) AS with_code_display, count(onset_date) AS with_onset_date, count(category_code) AS with_category""",
        CONDITION,
    ),
    "summary_observation": _observed(_OBSERVATION_COUNTS),
    "quality_pct": f"WITH {OBSERVATION}, s AS (SELECT {_OBSERVATION_COUNTS} FROM observation) "
    + " UNION ALL ".join(
        f"SELECT '{name}' AS field, {name} AS count, {name} / total_observations * 100 AS pct FROM s" for name in _OBSERVATION_FIELDS
    ),
    "gold_observations_per_patient": _select("*", PATIENT, OBSERVATION, GOLD),
    "gold_ranked": _select("patient_id, observation_count", PATIENT, OBSERVATION, GOLD, tail="ORDER BY observation_count DESC, patient_id"),
    "top20_share": _select(
        """max(k)::BIGINT AS top_patients, sum(CASE WHEN r <= k THEN observation_count ELSE 0 END)::BIGINT AS top_observations,
        sum(CASE WHEN r <= k THEN 0 ELSE observation_count END)::BIGINT AS other_observations,
        sum(CASE WHEN r <= k THEN observation_count ELSE -observation_count END) > 0 AS is_concentrated""",
        PATIENT,
        OBSERVATION,
        GOLD,
        source="""(SELECT observation_count, row_number() OVER (ORDER BY observation_count DESC) AS r,
        count(*) OVER () // 5 AS k FROM gold)""",
    ),
    "codes_outside_lists": _select(
        "*",
        PATIENT,
        OBSERVATION,
        source="""(
          SELECT 'patient' AS frame, 'gender' AS field, gender AS code, count(*) AS "rows" FROM patient WHERE gender = 'invalid' GROUP BY gender
          UNION ALL SELECT 'observation', 'status', status, count(*) FROM observation WHERE status = 'P' GROUP BY status
          UNION ALL SELECT 'observation', 'category', o_orderstatus, count(*) FROM observation GROUP BY o_orderstatus
          UNION ALL SELECT 'observation', 'category', 'extra', count(*) FROM observation HAVING count(*) > 0)""",
    ),
    "condition_status_codes": """
SELECT 'condition_status' AS frame, 'clinical' AS field, 'active' AS code, count(*) AS "rows" FROM lineitem WHERE l_linestatus = 'F'
HAVING count(*) > 0""",
    "stored_bronze_counts": f"""{_ALL_ENTRIES} SELECT 'bronze.' || bronze_table AS "table", count(*) AS "rows" FROM entries GROUP BY bronze_table""",
    "added_bronze_counts": f"""{_ALL_ENTRIES} SELECT 'bronze.' || bronze_table AS "table", count(*) AS "rows" FROM entries GROUP BY bronze_table""",
    "stored_gold": _select("*", PATIENT, OBSERVATION, GOLD),
    "stored_observation_report": _select(f"{_OBSERVATION_COUNTS}, {_report('observation')}", OBSERVATION),
    "stored_silver_condition": _select(f"{_CONDITION_FLAT.replace('source_file, ', '')}, {_ERRORS}", CONDITION),
    "malformed_bundles": """
SELECT 'order-' || o_orderkey AS bundle, CASE WHEN o_orderkey % 5 = 0 THEN 'malformed' ELSE 'loaded' END AS kind FROM orders""",
    "table_summary": " UNION ALL ".join(f"""SELECT '{DATABASE}.{t}' AS "table", count(*) AS "rows" FROM {t}""" for t in TABLES),
    "scan_parquet": "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders",
    "read_and_clean": f"""
SELECT doc_id, n_chars, {", ".join(f"nullif({TRIMMED.format(c)}, '') AS {c}" for c in ("text", "lang", "source"))} FROM documents""",
    "lowercase_columns": "SELECT * FROM customer",
    "trim_strings": _select(
        f"c_custkey, {TRIMMED.format('c_name')} AS c_name, {TRIMMED.format('c_mktsegment')} AS c_mktsegment, c_acctbal", DIRTY
    ),
    "nullify_strings": _select("c_custkey, nullif(c_name, '') AS c_name, nullif(c_mktsegment, '') AS c_mktsegment, c_acctbal", DIRTY),
    "clean": _select(
        f"c_custkey, nullif({TRIMMED.format('c_name')}, '') AS c_name, nullif(c_mktsegment, '') AS c_mktsegment, c_acctbal", DIRTY
    ),
    "string_to_boolean": """
SELECT l_orderkey, l_linenumber, CASE l_returnflag WHEN 'R' THEN true WHEN 'N' THEN false END AS l_returnflag, l_linestatus
FROM lineitem""",
    "map_to_boolean": """
SELECT doc_id, CASE toxic WHEN 1 THEN true WHEN 0 THEN false END AS toxic, CASE quality WHEN 1 THEN true END AS quality
FROM labels""",
    "normalize_name": """
SELECT p_partkey,
  array_to_string(list_transform(string_split(p_name, ' '), lambda x: upper(x[1]) || lower(x[2:])), '-') AS name
FROM part""",
    "datediff": _select("l_orderkey, l_linenumber, date_diff('day', s, e)::INT AS days", SHIPMENT),
    "datediff_business": _select(
        """l_orderkey, l_linenumber, CASE WHEN e IS NOT NULL THEN greatest(len(list_filter(
          range(s::TIMESTAMP, e::TIMESTAMP + INTERVAL 1 DAY, INTERVAL 1 DAY),
          lambda x: l_linenumber = 2 OR NOT list_contains([date_trunc('month', s), date_trunc('month', e), s], x::DATE))) - 1, 0)
        END::INT AS days""",
        SHIPMENT,
    ),
    "datediff_holidays": _select(
        """l_orderkey, l_linenumber, CASE WHEN e IS NOT NULL THEN greatest(len(list_filter(
          range(s::TIMESTAMP, e::TIMESTAMP + INTERVAL 1 DAY, INTERVAL 1 DAY),
          lambda x: NOT list_contains(days, x::DATE))) - 1, 0) END::INT AS days""",
        _YEARS_1994_2002,
        SHIPMENT,
        source="shipment, (SELECT list(date) AS days FROM holiday)",
    ),
    "holiday_calendar": _select(
        "date, name, name LIKE '%aatto' AS is_eve, count(o_orderkey) AS orders",
        _YEARS_OF_ORDERS,
        source="holiday LEFT JOIN orders ON o_orderdate::DATE = date",
        tail="GROUP BY date, name",
    ),
    "int_to_date": """
SELECT o_orderkey, CASE WHEN length(d::VARCHAR) = 8 THEN TRY_CAST(try_strptime(d::VARCHAR, '%Y%m%d') AS DATE) END AS order_day
FROM (
  SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN d + 9000 WHEN o_orderkey % 7 = 0 THEN d % 10000000 ELSE d END AS d
  FROM (SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d')::INT AS d FROM orders)
)""",
    "timestamp_to_date": "SELECT event_id, ts::DATE AS ts, ts::DATE AS text FROM events",
    "typed_select": "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_custkey > 10",
    "typed_inheritance": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders",
    "typed_validate": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders",
    "typed_from_dicts": """
SELECT c_custkey, CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 0 WHEN 'BUILDING' THEN 1 WHEN 'FURNITURE' THEN 2
       WHEN 'HOUSEHOLD' THEN 3 WHEN 'MACHINERY' THEN 4 END::BIGINT AS code FROM customer""",
    "sample_table": "SELECT least(count(*), 10) AS sampled, least(count(*), 10) AS found FROM orders",
    "typed_self_join": """
SELECT a.o_orderkey, a.o_custkey AS left_custkey, b.o_orderstatus AS right_status
FROM orders a JOIN orders b ON a.o_orderkey = b.o_orderkey""",
    "with_columns": """
SELECT c_custkey, c_nationkey, upper(c_name) AS c_name, c_custkey || '/' || c_nationkey AS key_and_nation FROM customer""",
}
