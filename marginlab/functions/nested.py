"""JSON text, binary JSON and array-of-struct expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marginlab.functions.times import col

# Fixed value: where a bid request keeps the placement type.
PLACEMENT_PATH = "$.imp[0].ext.pptype"


def json_scalar(c: str | Column, key: str) -> Column:
    """Value of a top-level key as text; NULL when absent, JSON null, an object or an array.

    Only texts that begin like an object or array are parsed again, to tell them from strings.
    """
    path = f"$.{key}"
    value = F.get_json_object(col(c), path)
    kind = F.schema_of_variant(F.try_variant_get(F.try_parse_json(col(c)), path, "variant"))
    # A NULL on the left would not keep Spark from evaluating the right.
    begins = F.coalesce(F.substring(value, 1, 1).isin("[", "{"), F.lit(False))
    nested = begins & F.coalesce(kind.rlike("^(OBJECT|ARRAY)"), F.lit(False))
    return F.when(~nested, value)


def json_has(c: str | Column, key: str) -> Column:
    """True when the top-level key is there, also with a JSON null value."""
    return F.coalesce(F.array_contains(F.json_object_keys(col(c)), F.lit(key)), F.lit(False))


def json_int_in_bytes(c: str | Column, path: str = PLACEMENT_PATH) -> Column:
    """Integer at a path of UTF-8 JSON held as binary; NULL if absent or not a number."""
    return F.get_json_object(F.decode(col(c), "UTF-8"), path).try_cast("int")


def ab_group(assignments: str | Column, test_id: int) -> Column:
    """Group name of the first assignment to a test, NULL if there is none.

    Position 0 (no such test) becomes index -1, which ``get`` answers with NULL.
    """
    found = F.array_position(col(assignments)["id"], F.lit(test_id))
    return F.get(col(assignments), found.cast("int") - 1)["group"]["name"]


def first_item(c: str | Column) -> Column:
    """First array element, NULL for an empty or NULL array."""
    return F.get(col(c), F.lit(0))


def first_path(prefixes: list[str] | tuple[str, ...], suffix: str) -> Column:
    """Attribution fallback: the suffix column of the first prefix that has a value."""
    return F.coalesce(*[F.col(f"{p}{suffix}") for p in prefixes])
