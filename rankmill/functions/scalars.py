"""Column expressions for cleaning and keys. All are built-ins that stay on the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

STRICT_JSON = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


def parse_json_text(text: Column, fields: Sequence[str]) -> Column:
    """One struct of text fields from a JSON object; unreadable text gives NULL fields.

    The text is parsed once for all fields rather than once per field.
    """
    schema = ", ".join(f"{name} string" for name in fields)
    return F.from_json(text, schema, STRICT_JSON)


def scalar_or_null(name: str) -> str:
    """SQL text: column `name`, or NULL where the extracted JSON value is an object or array.

    Only values that start with a bracket are parsed again.
    """
    nested = f"(json_object_keys({name}) is not null or json_array_length({name}) is not null)"
    return f"case when not (substring({name}, 1, 1) in ('{{', '[') and {nested}) then {name} end"


def safe_compact_date(value: Column) -> Column:
    """`yyyyMMdd` text to a date, NULL where it is no date."""
    return F.try_to_date(value.cast("string"), "yyyyMMdd")


def padded_id(value: Column, width: int) -> Column:
    """Restore leading zeros an identifier lost when it was read as a number."""
    return F.lpad(value.cast("string"), width, "0")


def composite_key(*parts: Column) -> Column:
    """Parts joined by `|`; NULL as soon as one part is NULL."""
    pieces: list[Column] = []
    for part in parts:
        if pieces:
            pieces.append(F.lit("|"))
        pieces.append(part)
    return F.concat(*pieces)


def partition_key(day: Column) -> Column:
    """The compact `yyyyMMdd` address of a daily partition."""
    return F.date_format(day, "yyyyMMdd")
