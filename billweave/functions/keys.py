"""Delivery keys and export names."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Separators and the tail of flat export names,
# ``{period}[_{execution}]_{vendor}_billing.parquet``.
KEY_SEPARATOR = ":"
EXPORT_TAIL = "_billing.parquet"
VENDOR = "aws"


def delivery_key(period: Column, execution: Column) -> Column:
    return F.concat_ws(KEY_SEPARATOR, period, execution)


def export_name(period: Column, vendor: str = VENDOR, execution: Column | None = None) -> Column:
    parts = [period] + ([execution] if execution is not None else []) + [F.lit(vendor)]
    return F.concat(F.concat_ws("_", *parts), F.lit(EXPORT_TAIL))


def parse_export_name(name: Column, vendor: str = VENDOR) -> Column:
    """Struct of ``billing_period`` and ``execution_id``; NULL for other vendors' and other files."""
    pattern = rf"^([^_]+)(?:_(.+))?_{re.escape(vendor)}{re.escape(EXPORT_TAIL)}$"
    execution = F.nullif(F.regexp_extract(name, pattern, 2), F.lit(""))
    return F.when(
        name.rlike(pattern),
        F.struct(F.regexp_extract(name, pattern, 1).alias("billing_period"), execution.alias("execution_id")),
    )
