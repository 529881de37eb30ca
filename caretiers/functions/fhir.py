"""Reading FHIR values out of a resource.

A resource is a VARIANT. ``read`` takes one path out of it with the type the caller needs; what
has another shape becomes null, element by element. All other functions work on the arrays and
structs ``read`` returns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

CODING = "struct<system:string,code:string,display:string>"
CODEABLE_CONCEPT = f"struct<text:string,coding:array<{CODING}>>"
QUANTITY = "struct<value:variant,unit:string,system:string,code:string>"
REFERENCE = "struct<reference:string>"
IDENTIFIER = "struct<system:string,value:string>"
EXTENSION = "struct<url:string,valueCodeableConcept:struct<coding:array<struct<code:string>>>>"

# A decimal number, infinity or NaN as text, with single underscores between digits.
_FLOAT_TEXT = r"(?i)\A\s*[+-]?(inf|infinity|nan|(\d(_?\d)*\.?(\d(_?\d)*)?|\.\d(_?\d)*)(e[+-]?\d(_?\d)*)?)\s*\z"


def read(resource: Column, path: str, ddl: str = "string") -> Column:
    """Value at ``path`` (like ``code.coding``) as ``ddl``; null if absent or of another shape."""
    return F.try_variant_get(resource, f"$.{path}", ddl)


def is_present(value: Column) -> Column:
    """A variant that is neither absent nor JSON null."""
    return value.isNotNull() & ~F.is_variant_null(value)


def non_empty(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def first(items: Column) -> Column:
    """First element, null for an empty or null array."""
    return F.get(items, F.lit(0))


def iter_dict_list(items: Column) -> Column:
    """The objects of a list. Elements of another shape were read as null and are left out."""
    return F.coalesce(F.array_compact(items), F.array())


def iter_codings(concept: Column) -> Column:
    return iter_dict_list(concept.coding)


def extract_first_coding(concept: Column) -> Column:
    """First coding object (system, code, display), even if its fields are null."""
    return first(F.array_compact(concept.coding))


def extract_code_text(concept: Column) -> Column:
    return non_empty(concept.text)


def extract_reference(reference: Column) -> Column:
    return non_empty(reference.reference)


def extract_reference_id(reference: Column) -> Column:
    """Id in a reference: the rest of ``urn:uuid:…``, or the text after the last slash."""
    urn = "urn:uuid:"
    tail = F.when(reference.startswith(urn), F.substr(reference, F.lit(len(urn) + 1)))
    return non_empty(tail.otherwise(F.substring_index(reference, "/", -1)))


def find_by_field(items: Column, field: str, value: str, wanted: str) -> Column:
    """``wanted`` of the first element with the given value, even if it is null."""
    return first(F.filter(items, lambda item: item[field] == value))[wanted]


def extract_identifier(identifiers: Column, system: str) -> Column:
    return find_by_field(identifiers, "system", system, "value")


def extract_telecom(telecoms: Column, system: str) -> Column:
    return find_by_field(telecoms, "system", system, "value")


def extract_field_from_list(items: Column, field: str, separator: str) -> Column:
    """Text of ``field`` in the first element that has it.

    A list is joined (nulls left out); empty text counts as null and ends the search.
    ``field`` is a variant, because it may hold a list or a single value.
    """
    value = first(F.filter(items, lambda item: is_present(item[field])))[field]
    joined = F.array_join(F.try_variant_get(value, "$", "array<string>"), separator)
    return F.coalesce(joined, non_empty(F.try_variant_get(value, "$", "string")))


def extract_address_field(addresses: Column, field: str) -> Column:
    return extract_field_from_list(addresses, field, ", ")


def extract_from_name_list(names: Column, field: str) -> Column:
    return extract_field_from_list(names, field, " ")


def extract_extension_value(extensions: Column, url: str, path: Sequence[str | int], ddl: str = "string") -> Column:
    """Value at a path of keys and list positions in the first extension with this url.

    ``extensions`` is an ``array<variant>``.
    """
    found = first(F.filter(extensions, lambda extension: F.try_variant_get(extension, "$.url", "string") == url))
    steps = [f"[{step}]" if isinstance(step, int) else f".{step}" for step in path]
    return F.try_variant_get(found, "$" + "".join(steps), ddl)


def extract_extension_code(extensions: Column, url: str) -> Column:
    """First code of the first extension with this url that has any coding."""
    codings = F.transform(
        F.filter(extensions, lambda extension: extension.url == url),
        lambda extension: extension.valueCodeableConcept.coding,
    )
    return first(first(F.filter(codings, lambda coding: F.size(coding) > 0))).code


def extract_category_from_list(categories: Column) -> Column:
    """First coding of the first category whose first coding has a code."""
    return first(F.filter(F.transform(categories, extract_first_coding), lambda coding: coding.code != ""))


def float_value(value: Column) -> Column:
    """A JSON number, or text that holds a number, as double."""
    text = F.try_variant_get(value, "$", "string")
    digits = F.regexp_replace(text, r"(?<=\d)_(?=\d)", "")
    from_text = F.when(text.rlike(_FLOAT_TEXT), F.trim(digits).try_cast("double"))
    is_text = F.schema_of_variant(value) == "STRING"
    return F.when(is_text, from_text).otherwise(F.try_variant_get(value, "$", "double"))


def boolean_value(value: Column) -> Column:
    """A JSON boolean; a plain variant cast would also take numbers and text."""
    return F.when(F.schema_of_variant(value) == "BOOLEAN", F.try_variant_get(value, "$", "boolean"))


def integer_value(value: Column) -> Column:
    """A JSON number without a fraction; a plain variant cast would also take fractions and text.

    3.0 counts as 3: a column of a stored variant that holds both whole numbers and fractions has
    one decimal type, so the two cannot be told apart.
    """
    number_type = F.schema_of_variant(value)
    whole = F.try_variant_get(value, "$", "bigint")
    no_fraction = F.try_variant_get(value, "$", "decimal(38,18)") == whole
    return F.when((number_type == "BIGINT") | (number_type.startswith("DECIMAL") & no_fraction), whole)
