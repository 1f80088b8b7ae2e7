"""Typed reads of JSON fields that were extracted as text.

Fields are pulled out of the message with one ``from_json`` under an
all-STRING schema (a number, boolean, object or array comes back as its JSON
text), then typed here. The typing follows the warehouse SQL the silver model
was written for: an INTEGER target rounds half-to-even (5.7 -> 6, 2.5 -> 2,
3.5 -> 4), ``true``/``false`` become 1/0, and text that is not a number is an
error (ANSI cast), not a silent NULL. A *quoted* non-integer such as "2.5" is
rounded here as well.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _bool_as_number(s: Column, otherwise: Column) -> Column:
    return F.when(s == "true", F.lit(1)).when(s == "false", F.lit(0)).otherwise(otherwise)


def _cast(s: Column, type_name: str, strict: bool) -> Column:
    return s.cast(type_name) if strict else s.try_cast(type_name)


def json_integer(s: Column, type_name: str = "int", strict: bool = True) -> Column:
    """JSON text -> integral type (``int`` or ``bigint``). ``strict=False``
    gives NULL instead of an error for text that is not a number."""
    # Fast path for integer text; the decimal route only runs for fractions.
    rounded = F.coalesce(
        s.try_cast("bigint"),
        F.bround(_cast(s, "decimal(38,10)", strict), 0).cast("bigint"),
    )
    typed = _bool_as_number(s, rounded)
    return typed.cast(type_name) if strict else typed.try_cast(type_name)


def json_double(s: Column, strict: bool = True) -> Column:
    return _bool_as_number(s, _cast(s, "double", strict)).cast("double")


def json_timestamp(s: Column, strict: bool = True) -> Column:
    """ISO-8601 text with offset -> instant (``TimestampType``)."""
    return _cast(s, "timestamp", strict)
