"""Counts and market statistics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.vocab import label_table

NULL_WORD = "null"


def one_row(*frames: DataFrame) -> DataFrame:
    """One-row frames side by side, without a cross join."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return stacked.agg(*[F.first(F.col(f"`{c}`"), ignorenulls=True).alias(c) for c in stacked.columns])


def term_counts(df: DataFrame, array: Column | str, name: str = "term") -> DataFrame:
    """How often each array element occurs, most frequent first."""
    terms = df.select(F.explode(array).alias(name))
    return terms.groupBy(name).agg(F.count("*").alias("count")).orderBy(F.desc("count"), name)


def category_counts(counts: DataFrame, name: str = "term") -> DataFrame:
    """Term counts summed per knowledge category; unlabelled terms are left out.

    The label table has a few dozen rows, hence the broadcast.
    """
    labels = F.broadcast(label_table(counts.sparkSession).withColumnRenamed("term", name))
    grouped = counts.join(labels, name).groupBy("category").agg(F.sum("count").alias("count"))
    return not_null_word(grouped, "category")


def not_null_word(df: DataFrame, name: str) -> DataFrame:
    """Drop nulls and the literal word "null"."""
    return df.filter(F.col(name).isNotNull() & (F.col(name) != NULL_WORD))


def with_salary(df: DataFrame, bins: str = "Salaries") -> DataFrame:
    return df.filter(F.size(bins) > 0)


def null_counts(df: DataFrame) -> DataFrame:
    """``column, nulls``: one pass, one row per column."""
    counted = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(df.columns)])
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("nulls")) for i, c in enumerate(df.columns)]
    return counted.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def distinct_counts(df: DataFrame, names: list[str], approximate: bool = False) -> DataFrame:
    count = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(*[count(F.col(f"`{c}`")).alias(f"unique_{c}") for c in names])


def source_counts(df: DataFrame, *dims: str) -> DataFrame:
    """Records per source (and further dimensions) with subtotals; a null means "all"."""
    return df.rollup("source", *dims).agg(F.count("*").alias("records"))


def top(df: DataFrame, name: str, n: int = 10) -> DataFrame:
    """The ``n`` most frequent values."""
    counts = df.filter(F.col(name).isNotNull()).groupBy(name).agg(F.count("*").alias("count"))
    return counts.orderBy(F.desc("count"), name).limit(n)


def salary_bands(df: DataFrame, bins: Column | str) -> DataFrame:
    """Postings per five-million band."""
    return df.select(F.explode(bins).alias("band")).groupBy("band").agg(F.count("*").alias("count"))


def salary_by(df: DataFrame, dim: str, value: str) -> DataFrame:
    """Number, mean and spread of a salary column per group."""
    return df.filter(F.col(value).isNotNull()).groupBy(dim).agg(
        F.count("*").alias("count"),
        F.avg(value).alias("mean"),
        F.min(value).alias("low"),
        F.max(value).alias("high"),
        F.percentile_approx(value, 0.5).alias("median"),
    )


def top_paying(df: DataFrame, value: str, row_id: str, n: int = 10) -> DataFrame:
    return df.filter(F.col(value).isNotNull()).orderBy(F.desc(value), row_id).limit(n)


def deadline_trend(df: DataFrame, deadline: str) -> DataFrame:
    """Postings per month of their ``d/M/yyyy`` deadline; unreadable dates are left out."""
    month = F.date_format(F.try_to_timestamp(F.col(deadline), F.lit("d/M/yyyy")), "yyyy-MM")
    return df.select(month.alias("month")).filter("month IS NOT NULL").groupBy("month").agg(F.count("*").alias("count"))
