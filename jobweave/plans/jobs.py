"""The two whole jobs: integrate the sources, and extract features."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import clean, quality, schema_match
from ..operators.aggregates import distinct_counts, one_row
from ..operators.matching import Matching, match_sources
from ..session import cut_lineage
from ..sources.readers import PLACE, load_all_sources, read_standard
from ..sources.sinks import export_records, export_report, export_summary, save_frames, save_index
from .extract import extract_features

VERSION = "1.0"


@dataclass
class Analysis:
    summary: DataFrame
    schema: dict[str, DataFrame]
    matching: Matching
    overall: DataFrame


def analyze(
    raw: dict[str, DataFrame],
    cleaned: dict[str, DataFrame],
    row_order: list[str] | None = None,
) -> Analysis:
    """Cleaning summary, schema compatibility of the raw columns, matching, and one overall score."""
    summary = quality.cleaning_summary(raw, clean.standardize_all(cleaned))
    schema = schema_match.analyze(raw)
    matching = match_sources(cleaned, row_order=row_order)
    overall = quality.overall_score(summary, schema["overall"], matching.report)
    return Analysis(summary, schema, matching, overall)


def _source_rows(frames: dict[str, DataFrame], name: str) -> DataFrame:
    counts = [df.agg(F.count("*").alias("n")).select(F.lit(s).alias("source"), F.col("n").alias(name)) for s, df in frames.items()]
    result = counts[0]
    for part in counts[1:]:
        result = result.unionByName(part)
    return result


def run_summary(
    raw: dict[str, DataFrame],
    combined: DataFrame,
    schema: dict[str, DataFrame],
    report: DataFrame,
    out: str,
    at: datetime,
    files: dict[str, str],
) -> DataFrame:
    """The run in one row of nested structs; rates in percent, ``files`` by kind."""
    rows = _source_rows(raw, "raw_records")
    kept = combined.groupBy("source").agg(F.count("*").alias("processed_records"))
    per_source = rows.join(kept, "source", "left").na.fill(0, ["processed_records"])
    # one entry per source
    sources = per_source.agg(
        F.map_from_entries(
            F.collect_list(F.struct("source", F.struct("raw_records", "processed_records")))
        ).alias("data_sources"),
        F.sum("raw_records").alias("total_raw_records"),
        F.sum("processed_records").alias("total_processed_records"),
    )
    unique = distinct_counts(combined, ["company_name", "location_clean"])
    overall = schema["overall"].select(
        F.round(F.col("overall_compatibility") * 100, 2).alias("overall_compatibility"),
        F.lit(len(schema_match.STANDARD_FIELDS)).alias("standard_fields_count"),
    )
    found = report.select(
        "duplicate_count", F.round(F.col("duplicate_rate") * 100, 2).alias("duplicate_rate"), "similar_groups"
    )
    row = one_row(sources, unique, overall, found)
    return row.select(
        F.struct(
            F.lit(at.isoformat()).alias("run_date"),
            F.lit(VERSION).alias("pipeline_version"),
            F.lit(out).alias("output_directory"),
        ).alias("pipeline_info"),
        "data_sources",
        F.struct(
            "total_raw_records",
            "total_processed_records",
            F.col("unique_company_name").alias("unique_companies"),
            F.col("unique_location_clean").alias("unique_locations"),
        ).alias("statistics"),
        F.struct(*[F.lit(path).alias(kind) for kind, path in files.items()]).alias("files_generated"),
        F.struct("overall_compatibility", "standard_fields_count").alias("schema_matching"),
        F.struct("duplicate_count", "duplicate_rate", "similar_groups").alias("data_matching"),
    )


def integrate(
    spark: SparkSession,
    out: str,
    paths: dict[str, str] | None = None,
    at: datetime | None = None,
    lines: bool = False,
) -> dict[str, str]:
    """Load, clean, standardise, match and export; returns the written paths.

    Rows carry their place in the input, since "first seen" depends on it: files in the order of their
    paths, rows as they stand in them, however the scan packs or splits the files.
    """
    at = at or datetime.now()
    placed = load_all_sources(spark, paths, lines, placed=True)
    raw = {s: df.drop(*PLACE) for s, df in placed.items()}
    standard = {s: clean.standardize(df, extra=PLACE) for s, df in clean.clean_all(placed).items()}
    # written once, read by matching, counting and the export
    combined = cut_lineage(clean.drop_helpers(clean.combine(standard)))
    schema = schema_match.analyze(raw)
    by_source = {s: combined.filter(F.col("source") == s) for s in raw}
    matching = match_sources(by_source, row_order=PLACE)
    files = {
        "records": export_records(combined.drop(*PLACE), out, at),
        "report": export_report(matching.report, out, at),
    }
    summary = run_summary(raw, combined, schema, matching.report, out, at, files)
    return files | {"summary": export_summary(summary, out)}


def feature_job(
    spark: SparkSession,
    glob: str,
    out: str,
    index: str = "recruit",
    index_format: str = "json",
    index_options=None,
    lines: bool = True,
) -> list[str]:
    """Read standard records, extract features once, write them as files and to the index."""
    features = cut_lineage(extract_features(read_standard(spark, glob, lines)))
    paths = save_frames([features], ["extracted_recruit"], f"{out.rstrip('/')}/extracted_data")
    save_index([features], [index], index_format, index_options, root=f"{out.rstrip('/')}/index")
    return paths
