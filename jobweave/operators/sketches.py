"""Mergeable sketches: distinct counts (HLL) and quantiles (KLL) kept per source and day, merged on read.

A sketch has a fixed size, so what is stored grows with sources and days and not with rows, and any span
of days is answered without reading the rows again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: 2**14 registers: a relative standard error of 0.65 %.
REGISTER_BITS = 14
#: A KLL sketch of this size is off by 1.33 % of the ranks at most, in 99 of 100 cases.
KLL_SIZE = 200
DISTINCT, QUANTILES = "distinct_", "quantiles_"


def sketch(df: DataFrame, keys: list[str], distinct: list[str], quantiles: list[str]) -> DataFrame:
    """Rows, one HLL sketch per column of ``distinct`` and one KLL sketch per number of ``quantiles``, per key.

    Sketches are partial aggregates, so a hot key is one sketch per map task.  Nulls count nowhere but in
    ``rows``; other types than numbers and texts are sketched by their text.
    """
    kinds = dict(df.dtypes)

    def plain(name: str) -> Column:
        value = F.col(f"`{name}`")
        return value if kinds[name] in ("int", "bigint", "string", "binary") else value.cast("string")

    return df.groupBy(*keys).agg(
        F.count("*").alias("rows"),
        *[F.hll_sketch_agg(plain(c), F.lit(REGISTER_BITS)).alias(DISTINCT + c) for c in distinct],
        *[F.kll_sketch_agg_double(F.col(f"`{c}`").cast("double"), F.lit(KLL_SIZE)).alias(QUANTILES + c) for c in quantiles],
    )


def save_sketches(sketches: DataFrame, path: str, day: str = "day") -> None:
    """Write sketches by day; a day that is written again replaces the sketches it had."""
    writer = sketches.repartition(day).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(day).parquet(path)


def load_sketches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def merge(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """Sketches of finer keys merged into those of ``keys``; without keys, one row."""
    merged = [F.sum("rows").alias("rows")]
    for name in sketches.columns:
        if name.startswith(DISTINCT):
            merged.append(F.hll_union_agg(name, F.lit(False)).alias(name))
        elif name.startswith(QUANTILES):
            merged.append(F.kll_merge_agg_double(name, F.lit(KLL_SIZE)).alias(name))
    return sketches.groupBy(*keys).agg(*merged)


def estimates(sketches: DataFrame, ranks: dict[str, float] | None = None) -> DataFrame:
    """Sketches replaced by what they tell: ``unique_<column>`` and, for each named rank, ``<name>_<column>``.

    A column without a value has 0 different ones and a null quantile.
    """
    ranks = {"median": 0.5} if ranks is None else ranks
    out = []
    for name in sketches.columns:
        if name.startswith(DISTINCT):
            out.append(F.hll_sketch_estimate(name).alias("unique_" + name.removeprefix(DISTINCT)))
        elif name.startswith(QUANTILES):
            filled = F.kll_sketch_get_n_double(name) > 0
            for label, rank in ranks.items():
                value = F.when(filled, F.kll_sketch_get_quantile_double(F.col(name), F.lit(rank)))
                out.append(value.alias(f"{label}_{name.removeprefix(QUANTILES)}"))
        else:
            out.append(F.col(f"`{name}`"))
    return sketches.select(*out)
