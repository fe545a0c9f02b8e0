"""Writers."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .schemas import EXPORT_LABELS


def save_frames(frames: Iterable[DataFrame], names: Iterable[str], root: str, fmt: str = "json") -> list[str]:
    """Write each frame to ``root/name``, replacing what is there."""
    paths = []
    for df, name in zip(frames, names):
        path = f"{root.rstrip('/')}/{name}"
        df.write.format(fmt).mode("overwrite").save(path)
        paths.append(path)
    return paths


def save_index(
    frames: Iterable[DataFrame],
    indices: Iterable[str],
    fmt: str = "json",
    options: dict[str, str] | None = None,
    resource_option: str = "path",
    root: str = "",
) -> None:
    """Write each frame to a search index.

    The connector is chosen by ``fmt``; ``resource_option`` is the option that
    names the index.  File formats are the default, keyed by index name.
    """
    for df, index in zip(frames, indices):
        target = f"{root.rstrip('/')}/{index}" if root else index
        df.write.format(fmt).options(**(options or {})).option(resource_option, target).mode("overwrite").save()


def documents(df: DataFrame) -> DataFrame:
    """Each row as one JSON document in column ``value``."""
    return df.select(F.to_json(F.struct("*")).alias("value"))


def save_documents(df: DataFrame, path: str) -> str:
    documents(df).write.mode("overwrite").text(path)
    return path


def _stamp(at: datetime | None) -> str:
    return (at or datetime.now()).strftime("%Y%m%d_%H%M%S")


def export_records(df: DataFrame, root: str, at: datetime | None = None) -> str:
    path = f"{root.rstrip('/')}/export-{_stamp(at)}.json"
    df.write.mode("overwrite").json(path)
    return path


def export_report(report: DataFrame, root: str, at: datetime | None = None) -> str:
    path = f"{root.rstrip('/')}/matching_report_{_stamp(at)}.json"
    report.write.mode("overwrite").json(path)
    return path


def export_summary(summary: DataFrame, root: str) -> str:
    path = f"{root.rstrip('/')}/pipeline_summary.json"
    summary.write.mode("overwrite").json(path)
    return path


def export_csv(df: DataFrame, path: str, single_file: bool = False, bom: bool = False) -> str:
    """CSV with a header, white space around values kept; ``bom`` puts a byte-order mark before the header of each file."""
    columns = list(df.columns)
    if bom:
        df = df.withColumnRenamed(columns[0], "﻿" + columns[0])
    df = df.coalesce(1) if single_file else df
    writer = df.write.mode("overwrite").option("header", True).option("escape", '"')
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return path


def renamed(df: DataFrame, labels: dict[str, str] | None = None) -> DataFrame:
    """Keep the labelled columns that exist and give them their labels."""
    labels = labels or EXPORT_LABELS
    return df.select([F.col(f"`{c}`").alias(label) for c, label in labels.items() if c in df.columns])


def in_order(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """The named columns that exist, in the order given."""
    return df.select([F.col(f"`{c}`") for c in names if c in df.columns])


def save_single(df: DataFrame, path: str) -> str:
    """One JSON file.  Opt-in only: the whole result goes through one task."""
    df.coalesce(1).write.mode("overwrite").json(path)
    return path


def first_rows(df: DataFrame, order: Column | str, limit: int = 0) -> DataFrame:
    """The first ``limit`` rows in order; 0 keeps all."""
    return df.orderBy(order).limit(limit) if limit else df
