"""Text helpers as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_empty(text: Column) -> Column:
    return text.isNull() | (text == "")


def is_not_empty(text: Column) -> Column:
    return text.isNotNull() & (text != "")


def trim_commas(text: Column) -> Column:
    return F.trim(text, F.lit(","))


def two_digits(text: Column) -> Column:
    """``5`` -> ``05``; two digits and more stay as they are."""
    return F.when(F.length(text) < 2, F.lpad(text, 2, "0")).otherwise(text)


def join_id_name(number: Column, name: Column, separator: str = ":") -> Column:
    return F.concat(number.cast("string"), F.lit(separator), name)


def json_field(text: Column, field: str) -> Column:
    """A field of a JSON object as text; null if the text is not JSON or has no such field."""
    return F.get_json_object(text, f"$.{field}")


def distinct_list(item: Column, separator: str = ",") -> Column:
    """Aggregate: the distinct non-null values in order, joined to one text."""
    return F.array_join(F.array_sort(F.collect_set(item)), separator)
