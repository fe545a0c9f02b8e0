"""Exact duplicates, chunk merging, and block-and-merge."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.experience import experience_list, render_experience
from ..functions.text import block_key, composite_key
from ..sources.readers import FILE, POSITION
from .clean import KEY_COLUMNS
from .ranking import keep_first, lookup, renumber


def duplicate_groups(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys held by several rows, numbered from 0 in key order, with their size.

    A null in any key excludes the row; an empty string does not.
    """
    complete = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    sizes = df.filter(complete).groupBy(*keys).agg(F.count("*").alias("group_size"))
    return renumber(sizes.filter(F.col("group_size") > 1), *keys, name="duplicate_group", start=0)


def find_duplicates(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """``is_duplicate`` and ``duplicate_group`` added to every row."""
    keys = keys or KEY_COLUMNS
    groups = duplicate_groups(df, keys)
    marked = lookup(df, groups, keys, "group_size")
    return marked.withColumn("is_duplicate", F.col("duplicate_group").isNotNull())


def merge_key(df: DataFrame, prefer: str | None = None) -> Column:
    """Link, else URL, else title, company and place; a blank link falls back too."""
    column = prefer or next((c for c in ("Liên_kết", "url") if c in df.columns), None)
    place = F.coalesce(*[F.col(f"`{c}`") for c in ("địa điểm làm việc", "địa điểm") if c in df.columns], F.lit(None).cast("string"))
    names = [F.col(f"`{c}`") if c in df.columns else F.lit(None).cast("string") for c in ("tên công việc", "công ty")]
    composite = composite_key(*names, place)
    if column is None:
        return composite
    return F.coalesce(F.nullif(F.col(f"`{column}`"), F.lit("")), F.concat(F.lit("_fallback_"), composite))


def merge_chunks(chunks: DataFrame, prefer: str | None = None, number: str | None = None) -> DataFrame:
    """First occurrence per merge key in file order, optionally renumbered."""
    kept = keep_first(chunks, [merge_key(chunks, prefer)], [FILE, POSITION])
    return renumber(kept, FILE, POSITION, name=number) if number else kept


def longest(name: str) -> Column:
    """The longest value of a group, the greatest one among equals; '' when there is none."""
    value = F.coalesce(F.col(f"`{name}`"), F.lit(""))
    return F.max(F.struct(F.length(value).alias("n"), value.alias("v")))["v"].alias(name)


def block_and_merge(
    df: DataFrame,
    title: str,
    company: str,
    city: str,
    experience: str,
    keep: list[str],
    number: str | None = "stt",
) -> DataFrame:
    """One record per block of same city, title signature and company signature.

    Each kept column takes its longest value.  Years of experience are merged
    over the block and fill an empty experience text.  Values are made distinct
    per block before they are gathered, so a large block stays small.
    """
    keyed = df.withColumn("block_key", block_key(F.col(f"`{city}`"), F.col(f"`{title}`"), F.col(f"`{company}`")))
    merged = keyed.groupBy("block_key").agg(*[longest(c) for c in keep], F.count("*").alias("block_size"))
    years = (
        keyed.select("block_key", F.explode(experience_list(F.col(f"`{experience}`"))).alias("year"))
        .distinct()
        .groupBy("block_key")
        .agg(F.array_sort(F.collect_list("year")).alias("experience_years"))
    )
    joined = merged.join(years, "block_key", "left")
    text = F.col(f"`{experience}`")
    filled = F.when(F.trim(text) == "", render_experience(F.col("experience_years"))).otherwise(text)
    result = joined.withColumn(experience, filled)
    return renumber(result, F.col(f"`{title}`").asc_nulls_last(), "block_key", name=number) if number else result


def suppress_seen(new: DataFrame, seen: DataFrame, key: str, order: list[Column | str]) -> DataFrame:
    """New rows whose key was not seen before, first occurrence only."""
    fresh = keep_first(new, [key], order)
    return fresh.join(seen.select(key).distinct(), key, "left_anti")
