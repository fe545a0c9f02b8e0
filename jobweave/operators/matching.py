"""Matching reports and the whole matching step."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .aggregates import one_row
from .clean import KEY_COLUMNS, combine, key_columns, map_raw_for_matching
from .dedup import duplicate_groups
from .entities import resolve_entities, similar_records
from .ranking import lookup, renumber

HIGH_DUPLICATE_RATE = 0.1
HIGH_SIMILARITY_RATE = 0.2
# Advice texts.
ADVICE_DUPLICATES = "High duplicate rate detected. Consider implementing deduplication."
ADVICE_SIMILARITY = "High similarity rate detected. Consider entity resolution."


def duplicate_report(groups: DataFrame, df: DataFrame) -> DataFrame:
    """Counts and rate of exact duplicates, one row."""
    found = groups.agg(
        F.coalesce(F.sum("group_size"), F.lit(0)).alias("duplicate_count"), F.count("*").alias("duplicate_groups")
    )
    total = df.agg(F.count("*").alias("total_records"))
    return one_row(total, found).select(
        "total_records",
        "duplicate_count",
        F.try_divide(F.col("duplicate_count").cast("double"), F.col("total_records")).alias("duplicate_rate"),
        "duplicate_groups",
    )


def similarity_report(groups: DataFrame) -> DataFrame:
    """Groups of several similar records and the records in them, one row."""
    sizes = groups.groupBy("leader").agg(F.sum("copies").alias("records"))
    several = F.col("records") > 1
    return sizes.agg(
        F.count_if(several).alias("similar_groups"),
        F.coalesce(F.sum(F.when(several, F.col("records"))), F.lit(0)).alias("similar_records"),
        F.coalesce(F.sum("records"), F.lit(0)).alias("compared_records"),
    )


def entity_report(statistics: DataFrame) -> DataFrame:
    pick = lambda kind, col: F.max(F.when(F.col("entity") == kind, F.col(col)))
    return statistics.agg(
        pick("company", "total").alias("total_companies"),
        pick("job_title", "total").alias("total_job_titles"),
        pick("company", "mapped").alias("unique_companies"),
        pick("job_title", "mapped").alias("unique_job_titles"),
        pick("company", "canonical").alias("canonical_companies"),
        pick("job_title", "canonical").alias("canonical_job_titles"),
    )


@dataclass
class Matching:
    report: DataFrame
    duplicates: DataFrame
    similar: DataFrame
    mappings: dict[str, DataFrame]
    combined: DataFrame


def matching_report(df: DataFrame, row_id: str, keys: list[str] | None = None) -> Matching:
    """Duplicates, similar records and entities of one frame, each computed once.

    The frame is reduced to its keys and checkpointed, since all three parts
    read it.
    """
    keys = keys or KEY_COLUMNS
    keyed = cut_lineage(df.select(row_id, *[F.col(f"`{k}`") for k in keys]))
    duplicates = cut_lineage(duplicate_groups(keyed, keys))
    similar = cut_lineage(similar_records(keyed, row_id, keys))
    title, company = keys[0], keys[1] if len(keys) > 1 else keys[0]
    mappings, statistics = resolve_entities(keyed, row_id, company, title)
    report = one_row(duplicate_report(duplicates, keyed), similarity_report(similar), entity_report(statistics))
    report = report.withColumn(
        "similarity_rate", F.try_divide(F.col("similar_records").cast("double"), F.col("total_records"))
    ).withColumn(
        "recommendations",
        F.concat_ws(
            " ",
            F.when(F.col("duplicate_rate") > HIGH_DUPLICATE_RATE, F.lit(ADVICE_DUPLICATES)),
            F.when(F.col("similarity_rate") > HIGH_SIMILARITY_RATE, F.lit(ADVICE_SIMILARITY)),
        ),
    )
    flagged = lookup(keyed, duplicates, keys, "group_size")
    flagged = flagged.withColumn("is_duplicate", F.col("duplicate_group").isNotNull())
    return Matching(report, flagged, similar, mappings, keyed)


def match_sources(
    frames: dict[str, DataFrame], raw: bool = False, row_order: list[str] | None = None
) -> Matching:
    """Combine the sources, pick the key columns, and match.

    Rows are numbered by source and the given order columns (all key columns by
    default), since "first seen" needs an order.
    """
    if raw:
        frames = {source: map_raw_for_matching(df, source) for source, df in frames.items()}
    combined = combine(frames)
    keys = key_columns(combined.columns)
    if not keys:
        raise ValueError("no column can serve as a matching key")
    order = ["source", *(row_order or keys)]
    columns = dict.fromkeys(["source", *keys, *(row_order or [])])
    numbered = renumber(combined.select(*columns), *order, name="row_id")
    return matching_report(numbered, "row_id", keys)
