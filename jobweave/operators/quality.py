"""Validation rules, quality scores and the cleaning summary."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .aggregates import one_row

ERROR_PENALTY, WARNING_PENALTY = 5, 2
MAX_EXPERIENCE = 50
REQUIRED = ["job_title_clean", "company_name", "source"]


def _number(name: str) -> Column:
    return F.col(name).try_cast("double")


def rules(columns: list[str]) -> dict[str, tuple[str, Column]]:
    """Rule name to severity and the condition that breaks it, for the columns present."""
    found: dict[str, tuple[str, Column]] = {}
    if "salary_min" in columns and "salary_max" in columns:
        found["salary_min_above_max"] = ("error", _number("salary_min") > _number("salary_max"))
    if "experience" in columns:
        years = _number("experience")
        found["unrealistic_experience"] = ("warning", (years < 0) | (years > MAX_EXPERIENCE))
    for name in REQUIRED:
        if name in columns:
            found[f"missing_{name}"] = ("warning", F.col(name).isNull())
    if "salary_min" in columns:
        found["non_numeric_salary_min"] = ("error", _number("salary_min").isNull())
    return found


def _rule_counts(df: DataFrame) -> list[Column]:
    return [F.count_if(broken).alias(f"rule_{name}") for name, (_, broken) in rules(df.columns).items()]


def validate(df: DataFrame) -> DataFrame:
    """``rule, severity, records`` for every broken rule, in one pass."""
    entries = [
        F.struct(F.lit(name).alias("rule"), F.lit(severity).alias("severity"), F.col(f"rule_{name}").alias("records"))
        for name, (severity, _) in rules(df.columns).items()
    ]
    counted = df.agg(F.count("*").alias("n"), *_rule_counts(df))
    return counted.select(F.explode(F.array(*entries)).alias("r")).select("r.*").filter("records > 0")


def _sum(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns, F.lit(0))


def quality(df: DataFrame, *extra: Column) -> DataFrame:
    """Rows, cells, missing cells, kinds of errors and warnings, and the score, one row.

    The score is the share of filled cells in percent less five per kind of
    error and two per kind of warning, at least 0.
    """
    checks = rules(df.columns)
    missing = _sum([F.count_if(F.col(f"`{c}`").isNull()) for c in df.columns])
    counted = df.agg(F.count("*").alias("rows"), missing.alias("missing_cells"), *_rule_counts(df), *extra)

    def kinds(severity: str) -> Column:
        hits = [F.when(F.col(f"rule_{n}") > 0, 1).otherwise(0) for n, (s, _) in checks.items() if s == severity]
        return _sum(hits)

    counted = counted.withColumns(
        {"cells": F.col("rows") * len(df.columns), "errors": kinds("error"), "warnings": kinds("warning")}
    )
    filled = F.try_divide((F.col("cells") - F.col("missing_cells")).cast("double"), F.col("cells")) * 100
    score = filled - F.col("errors") * ERROR_PENALTY - F.col("warnings") * WARNING_PENALTY
    return counted.withColumn("quality_score", F.coalesce(F.bround(F.greatest(F.lit(0.0), score), 2), F.lit(0.0))).drop(
        *[f"rule_{n}" for n in checks]
    )


def _rate(part: Column, whole: Column) -> Column:
    return F.coalesce(F.bround(F.try_divide(part.cast("double"), whole) * 100, 2), F.lit(0.0))


def cleaning_summary(raw: dict[str, DataFrame], cleaned: dict[str, DataFrame]) -> DataFrame:
    """One row per source: rows before and after, missing cells, quality, extraction rates."""
    parts = []
    for source, df in cleaned.items():
        extra = []
        if "skills" in df.columns:
            extra.append(F.count_if(F.trim("skills") != "").alias("records_with_skills"))
        if "experience" in df.columns:
            extra += [F.count("experience").alias("records_with_experience"), F.avg("experience").alias("mean_experience")]
        row = quality(df, *extra)
        for name, kind in (("records_with_skills", "bigint"), ("records_with_experience", "bigint"), ("mean_experience", "double")):
            if name not in row.columns:
                row = row.withColumn(name, F.lit(None).cast(kind))
        before = raw[source].agg(F.count("*").alias("original_rows"))
        part = one_row(row, before).select(
            F.lit(source).alias("source"),
            "original_rows",
            F.col("rows").alias("cleaned_rows"),
            (F.col("original_rows") - F.col("rows")).alias("rows_removed"),
            F.lit(len(df.columns)).alias("columns"),
            "missing_cells",
            "errors",
            "warnings",
            "quality_score",
            "records_with_skills",
            _rate(F.col("records_with_skills"), F.col("rows")).alias("skills_rate"),
            "records_with_experience",
            _rate(F.col("records_with_experience"), F.col("rows")).alias("experience_rate"),
            F.bround("mean_experience", 2).alias("avg_experience"),
        )
        parts.append(part)
    return reduce(DataFrame.unionByName, parts)


def overall_score(summary: DataFrame, compatibility: DataFrame, matching: DataFrame) -> DataFrame:
    """Mean of the source scores, the schema score and the matching score."""
    scores = (
        summary.select(F.col("quality_score").alias("score"))
        .unionByName(compatibility.select((F.col("overall_compatibility") * 100).alias("score")))
        .unionByName(
            matching.select(((1 - (F.col("duplicate_rate") + F.col("similarity_rate")) / 2) * 100).alias("score"))
        )
    )
    return scores.agg(F.coalesce(F.bround(F.avg("score"), 2), F.lit(0.0)).alias("overall_quality_score"))
