"""Clean column names from ``category/Name`` originals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The words that may not stand alone as a column name, and the names and affixes
# given in their place. They must not change, or tables written earlier stop matching.
RESERVED_WORDS = """
group order select from where join inner outer left right on as and or not in exists
between like is null true false case when then else end union intersect except all
distinct limit offset having by asc desc create table insert update delete alter drop
index view database schema column primary key foreign references constraint unique check
default grant revoke user role commit rollback begin transaction start
""".split()
EMPTY_NAME = "unknown_column"
DIGIT_PREFIX = "col_"
RESERVED_SUFFIX = "_col"
CAMEL_BOUNDARY = "([a-z0-9])([A-Z])"


def original_name(category: Column, name: Column) -> Column:
    """The header form of a manifest column, ``category/Name``."""
    return F.concat(F.coalesce(category, F.lit("")), F.lit("/"), F.coalesce(name, F.lit("")))


def snake_name(original: Column) -> Column:
    """Lower snake case; each run of other characters is one inner underscore."""
    snake = F.lower(F.regexp_replace(original, CAMEL_BOUNDARY, "$1_$2"))
    return F.btrim(F.regexp_replace(snake, "[^a-z0-9]+", "_"), F.lit("_"))


def named(snake: Column) -> Column:
    """A name in place of an empty one, and a prefix for one that begins with a digit."""
    return (
        F.when(snake == "", F.lit(EMPTY_NAME))
        .when(snake.rlike("^[0-9]"), F.concat(F.lit(DIGIT_PREFIX), snake))
        .otherwise(snake)
    )


def unreserved(name: Column) -> Column:
    return F.when(name.isin(RESERVED_WORDS), F.concat(name, F.lit(RESERVED_SUFFIX))).otherwise(name)


def normalize_name(original: Column) -> Column:
    """Clean column name of an original; the three steps in this order."""
    return unreserved(named(snake_name(original)))


def normalize_names(originals: Column) -> Column:
    """The same for an array. Each step is a pass of its own, so none is evaluated repeatedly."""
    return F.transform(F.transform(F.transform(originals, snake_name), named), unreserved)


def suffixed(base: Column, ordinal: Column) -> Column:
    """``base`` for the first use of a name, ``base_1``, ``base_2``, … for later ones."""
    return F.when(ordinal == 0, base).otherwise(F.concat(base, F.lit("_"), ordinal.cast("string")))
