"""Types that columns turn out to have, from the values they hold.

Kinds form a lattice: null is below all; int is below double; any other mixture is a string.  Counts per
kind are what is stored: they add up over chunks and days, and the type follows from the sums.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NULL, INT, DOUBLE, BOOLEAN, DATE, STRING = "null", "int", "double", "boolean", "date", "string"
KINDS = [NULL, INT, DOUBLE, BOOLEAN, DATE, STRING]

_INT = r"^[+-]?[0-9]{1,18}$"
_DOUBLE = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]{1,3})?$"
_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"


def text_kind(text: Column) -> Column:
    """Kind that a text spells; a blank one is null, a date that no calendar has is a string."""
    bare = F.trim(text)
    return (
        F.when(F.coalesce(bare == "", F.lit(True)), NULL)
        .when(bare.rlike(_INT), INT)
        .when(bare.rlike(_DOUBLE), DOUBLE)
        .when(F.lower(bare).isin("true", "false"), BOOLEAN)
        .when(bare.rlike(_DATE) & bare.try_cast("date").isNotNull(), DATE)
        .otherwise(STRING)
    )


def variant_kind(value: Column) -> Column:
    """Kind of a JSON value as it was written; objects and arrays are strings.  Whole decimals are doubles."""
    kind = F.schema_of_variant(value)
    return (
        F.when(value.isNull() | (kind == "VOID"), NULL)
        .when(kind.isin("BIGINT", "INT"), INT)
        .when((kind == "DOUBLE") | (kind == "FLOAT") | kind.startswith("DECIMAL"), DOUBLE)
        .when(kind == "BOOLEAN", BOOLEAN)
        .when((kind == "DATE") | kind.startswith("TIMESTAMP"), DATE)
        .otherwise(STRING)
    )


def kind_of(value: Column, dtype: str, parse: bool = True) -> Column:
    """Kind of a value of a column of type ``dtype``; ``parse`` asks what a text spells."""
    if dtype == "variant":
        return variant_kind(value)
    if dtype == "string" and parse:
        return text_kind(value)
    if dtype in ("tinyint", "smallint", "int", "bigint"):
        kind = INT
    elif dtype in ("float", "double") or dtype.startswith("decimal"):
        kind = DOUBLE
    elif dtype == "boolean":
        kind = BOOLEAN
    elif dtype == "date" or dtype.startswith("timestamp"):
        kind = DATE
    elif dtype == "void":
        kind = NULL
    else:
        kind = STRING
    return F.when(value.isNull(), NULL).otherwise(kind)


def measure(df: DataFrame, *keys: str, parse: bool = True) -> DataFrame:
    """``keys, column, rows`` and a count per kind, of every column that is no key.

    One pass: a row becomes a (column, kind) pair per column, which are counted before the shuffle.  An
    empty table has no rows here.
    """
    kinds = [
        F.struct(F.lit(c).alias("column"), kind_of(F.col(f"`{c}`"), kind, parse).alias("kind"))
        for c, kind in df.dtypes
        if c not in keys
    ]
    if not kinds:
        raise ValueError("no column to measure")
    seen = df.select(*[F.col(f"`{k}`") for k in keys], F.inline(F.array(*kinds)))
    counts = [F.count_if(F.col("kind") == k).alias(k) for k in KINDS]
    return seen.groupBy(*keys, "column").agg(F.count("*").alias("rows"), *counts)


def merge_measures(*measures: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Measures of several parts added up per ``keys`` and column."""
    stacked = reduce(DataFrame.unionByName, [m.select(*keys, "column", "rows", *KINDS) for m in measures])
    return stacked.groupBy(*keys, "column").agg(*[F.sum(c).alias(c) for c in ("rows", *KINDS)])


def with_type(measures: DataFrame) -> DataFrame:
    """Adds ``type``, the least kind above all values, and ``share``, how many of the filled values have it themselves.

    An integer in a column of doubles is none of the doubles.  A column without a value is of type null and has no share.
    """
    has = lambda kind: F.col(kind) > 0
    families = sum((f.cast("int") for f in (has(INT) | has(DOUBLE), has(BOOLEAN), has(DATE))), F.lit(0))
    kind = (
        F.when(has(STRING) | (families > 1), STRING)
        .when(has(BOOLEAN), BOOLEAN)
        .when(has(DATE), DATE)
        .when(has(DOUBLE), DOUBLE)
        .when(has(INT), INT)
        .otherwise(NULL)
    )
    typed = measures.withColumn("type", kind)
    own = reduce(lambda rest, k: F.when(F.col("type") == k, F.col(k)).otherwise(rest), KINDS[1:], F.lit(None).cast("bigint"))
    return typed.withColumn("share", F.try_divide(own.cast("double"), F.col("rows") - F.col(NULL)))
