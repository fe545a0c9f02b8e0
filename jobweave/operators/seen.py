"""A table of keys already seen that lives between loads and is never shuffled again.

The table is bucketed by key.  A join with new rows shuffles the new rows into the same buckets and reads
the old side bucket by bucket; only the keys that are new are appended.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .ranking import keep_first


def open_seen(spark: SparkSession, name: str, path: str, key: str, kind: str, buckets: int = 256) -> DataFrame:
    """The table of seen keys at ``path``, made if it is not there; ``buckets`` is fixed when it is made."""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS `{name}` (`{key}` {kind}) USING parquet "
        f"CLUSTERED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    return spark.table(name)


def fresh_rows(new: DataFrame, seen: DataFrame, key: str, order: list[Column | str]) -> DataFrame:
    """New rows whose key the table lacks, the first of each key.  A null key is never seen, and one of its rows is kept.

    The old side is read in its buckets, without an exchange: an anti join asks only whether a key is there,
    so a key that two loads appended does no harm.  A bucket is sorted, which may spill.  Store the result
    before ``append_seen``: a load killed in between finds its rows fresh again.
    """
    return keep_first(new, [key], order).join(seen, key, "left_anti")


def append_seen(fresh: DataFrame, name: str, key: str) -> None:
    """Append the keys of ``fresh`` to the table, in its buckets; null keys are not kept."""
    table = fresh.sparkSession.table(name)
    buckets = int(
        fresh.sparkSession.sql(f"DESCRIBE EXTENDED `{name}`").where("col_name = 'Num Buckets'").first()["data_type"]
    )
    rows = fresh.select(F.col(key).cast(table.schema[key].dataType).alias(key)).where(F.col(key).isNotNull())
    # one file per bucket and load
    rows.repartition(buckets, key).write.insertInto(name)
