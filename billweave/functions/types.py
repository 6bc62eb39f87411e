"""Column types from manifest metadata; never inferred from the data."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Source type -> table type, and the category that is text whatever it declares.
TABLE_TYPES = {
    "String": "VARCHAR",
    "OptionalString": "VARCHAR",
    "BigDecimal": "DECIMAL(18,2)",
    "OptionalBigDecimal": "DECIMAL(18,2)",
    "DateTime": "TIMESTAMP",
    "Interval": "VARCHAR",
}
DEFAULT_TYPE = "VARCHAR"
TEXT_CATEGORY = "resourceTags"


def _types(cost_scale: int) -> dict[str, str]:
    return {
        source: f"DECIMAL(18,{cost_scale})" if table.startswith("DECIMAL") else table
        for source, table in TABLE_TYPES.items()
    }


def table_type(
    category: Column, source_type: Column, cost_scale: int = 2, text_categories: Iterable[str] = ()
) -> Column:
    """Table type of a column; tags and unknown types are text."""
    pairs = [F.lit(x) for pair in _types(cost_scale).items() for x in pair]
    known = F.try_element_at(F.create_map(*pairs), source_type)
    is_text = category.isin(TEXT_CATEGORY, *text_categories)
    return F.when(is_text, F.lit(DEFAULT_TYPE)).otherwise(F.coalesce(known, F.lit(DEFAULT_TYPE)))


def spark_type(name: str) -> T.DataType:
    """Spark type of a stored table type. Timestamps have no zone, as in the source table."""
    if name == "TIMESTAMP":
        return T.TimestampNTZType()
    if name.startswith("DECIMAL"):
        return T.DataType.fromDDL(name.lower())
    return T.StringType()


def table_type_name(data_type: T.DataType) -> str:
    """Inverse of :func:`spark_type` for the three types a billing table can hold."""
    if isinstance(data_type, T.DecimalType):
        return f"DECIMAL({data_type.precision},{data_type.scale})"
    if isinstance(data_type, (T.TimestampNTZType, T.TimestampType)):
        return "TIMESTAMP"
    return DEFAULT_TYPE


def misfit(value: Column, target: T.DataType) -> Column:
    """What is wrong with a value that the target type cannot hold; NULL if it can."""
    message = F.concat(F.lit(f"not a {target.simpleString()}: "), value.cast("string"))
    return F.when(value.isNotNull() & value.try_cast(target).isNull(), message)


def checked_cast(value: Column, target: T.DataType) -> Column:
    """Cast that raises on a value the target cannot hold, whatever the session's ANSI setting."""
    wrong = misfit(value, target)
    return F.when(wrong.isNotNull(), F.raise_error(wrong).cast(target)).otherwise(value.try_cast(target))
