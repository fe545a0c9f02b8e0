"""Chunk files merged as they arrive: Structured Streaming with a state store of merge keys.

A run takes the files that came since the last one and ends.  The first row of each key, in the order of files and
rows, is put out once; the checkpoint holds the keys and the files done, so a run that was killed goes on where
it was and repeats nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout

from ..operators.dedup import merge_key
from ..sources.readers import FILE

KEY = "_merge_key"


def chunk_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int = 1000) -> DataFrame:
    """Records of chunk files, one per line, with their file; files are taken in the order they came."""
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(path)
    return rows.select(*schema.names, F.col("_metadata.file_path").alias(FILE))


def first_of_keys(rows: DataFrame, position: str) -> DataFrame:
    """The first row of each merge key, by file and ``position``, that no earlier batch had."""
    order = [FILE, position]
    keyed = rows.withColumn(KEY, merge_key(rows))
    names = rows.columns

    def first(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        best = None
        for batch in batches:
            row = batch.sort_values(order, kind="stable").iloc[:1]
            if best is None or tuple(row[order].iloc[0]) < tuple(best[order].iloc[0]):
                best = row
        if not state.exists:
            state.update((True,))
            yield best[names]

    return keyed.groupBy(KEY).applyInPandasWithState(first, rows.schema, "seen boolean", "append", GroupStateTimeout.NoTimeout)


def merge_arrived(
    spark: SparkSession, path: str, schema: T.StructType, position: str, out: str, checkpoint: str, files_per_batch: int = 1000
) -> None:
    """Merge the chunk files that have come since the last run into the table at ``out``.

    ``position`` names the column that orders the records of a file.
    """
    fresh = first_of_keys(chunk_stream(spark, path, schema, files_per_batch), position)
    sink = fresh.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    query = sink.trigger(availableNow=True).start(out)
    query.awaitTermination()
