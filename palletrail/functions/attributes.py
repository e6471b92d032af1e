"""The attribute document of a ledger row, parsed once per row."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from palletrail.config import ATTRIBUTE_KEYS
from palletrail.functions.text import blank_to_null

_PARSED = "_attributes"
_NESTED = "_nested"


def attribute_schema(names: Iterable[str]) -> str:
    return ", ".join(f"`{ATTRIBUTE_KEYS[name]}` string" for name in names)


def nested_keys(document: Column) -> Column:
    """Keys of the document whose value is an object or array; NULL where no bracket after the first one could begin such a value.

    Few documents hold one, so the others are told by a search for the two characters.
    """
    suspicious = F.substring(document, 2, (1 << 31) - 1).contains("{") | document.contains("[")
    kinds = F.from_json(document, "map<string, variant>")
    return F.when(suspicious, F.map_keys(F.map_filter(kinds, lambda _, value: F.schema_of_variant(value).rlike("^(OBJECT|ARRAY)"))))


def scalar_only(value: Column, nested: Column, key: str) -> Column:
    """Nested objects and arrays are no attribute values, and blanks are NULL."""
    return F.when(F.array_contains(nested, key), F.lit(None).cast("string")).otherwise(blank_to_null(value))


def json_fields(df: DataFrame, names: Iterable[str] | None = None, document: str = "cust_data") -> DataFrame:
    """Add one string column per attribute name; the document is parsed a single time.

    Malformed documents give NULL attributes, as a lenient JSON lookup does.
    """
    names = list(names or ATTRIBUTE_KEYS)
    parsed = df.withColumns({_PARSED: F.from_json(F.col(document), attribute_schema(names)), _NESTED: nested_keys(F.col(document))})
    fields = {name: scalar_only(F.col(f"{_PARSED}.`{ATTRIBUTE_KEYS[name]}`"), F.col(_NESTED), ATTRIBUTE_KEYS[name]) for name in names}
    return parsed.withColumns(fields).drop(_PARSED, _NESTED)


def json_field(document: Column, name: str) -> Column:
    """A single attribute where the other ones are not needed."""
    key = ATTRIBUTE_KEYS[name]
    return scalar_only(F.get_json_object(document, f"$.{key}"), nested_keys(document), key)
