"""Readers: schemas are always given, never inferred."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import schemas

_BROKEN = "_broken_record"
FILE, BLOCK, POSITION = "_file", "_block", "_position"
#: Columns that order rows as they stand in the input: by file, split of the file, and row of the split.
PLACE = [FILE, BLOCK, POSITION]


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def _drop_broken(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Drop records of which nothing could be parsed; keep partly readable ones."""
    readable = F.col(_BROKEN).isNull()
    for field in schema:
        readable = readable | F.col(f"`{field.name}`").isNotNull()
    return df.filter(readable).drop(_BROKEN)


def _read(
    spark: SparkSession, path, schema: T.StructType, fmt: str, options: dict[str, str], placed: bool = False
) -> DataFrame:
    """Rows as written, with the text of broken ones; ``placed`` adds the columns of ``PLACE``.

    Spark packs large files first, so a bare row id does not follow the order of files.
    """
    full = T.StructType(schema.fields + [T.StructField(_BROKEN, T.StringType())])
    reader = spark.read.format(fmt).schema(full).option("mode", "PERMISSIVE")
    reader = reader.option("columnNameOfCorruptRecord", _BROKEN).options(**options)
    place = [F.lit(None).cast("string"), F.lit(None).cast("bigint")]
    try:
        rows = reader.load(path)
        place = [F.col("_metadata.file_path"), F.col("_metadata.file_block_start")]
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        rows = empty(spark, full)
    if not placed:
        return rows
    return rows.select("*", place[0].alias(FILE), place[1].alias(BLOCK), F.monotonically_increasing_id().alias(POSITION))


def load_json(
    spark: SparkSession, path, schema: T.StructType, lines: bool = False, placed: bool = False, **options: str
) -> DataFrame:
    """JSON; a missing or unreadable file gives no rows instead of an error.

    A file is an array, read by one task, or with ``lines`` one record per line, which large files are
    split by.
    """
    options = {"multiLine": str(not lines).lower()} | options
    return _drop_broken(_read(spark, path, schema, "json", options, placed), schema)


def load_variants(spark: SparkSession, path, names: Iterable[str]) -> DataFrame:
    """JSON lines, the named members as variants that keep the type each value was written with.

    A path into a variant quotes a name one way or the other, so a name may not hold both kinds of quotes.
    """
    rows = spark.read.option("singleVariantColumn", "_record").json(path)
    paths = {n: f"$['{n}']" if '"' in n else f'$["{n}"]' for n in names}
    return rows.select(*[F.try_variant_get("_record", at, "variant").alias(n) for n, at in paths.items()])


def load_csv(spark: SparkSession, path, schema: T.StructType, **options: str) -> DataFrame:
    """CSV with a header, quoted line breaks and an optional byte-order mark."""
    defaults = {"header": "true", "escape": '"', "enforceSchema": "true", "multiLine": "true"}
    return _drop_broken(_read(spark, path, schema, "csv", defaults | options), schema)


def load_source(
    spark: SparkSession,
    source: str,
    path: str | None = None,
    encoding: str = "utf-8",
    lines: bool = False,
    placed: bool = False,
) -> DataFrame:
    path = path or f"./data/data_{source}.json"
    return load_json(spark, path, schemas.SOURCES[source], lines, placed, encoding=encoding)


def load_all_sources(
    spark: SparkSession, paths: dict[str, str] | None = None, lines: bool = False, placed: bool = False
) -> dict[str, DataFrame]:
    """One frame per source; a source without a file is empty and the rest go on."""
    paths = paths or {}
    return {s: load_source(spark, s, paths.get(s), lines=lines, placed=placed) for s in schemas.SOURCES}


def source_profile(frames: dict[str, DataFrame]) -> DataFrame:
    """``source, column, type, rows, nulls, chars``: one pass per source, nothing collected."""
    reports = []
    for source, df in frames.items():
        counted = df.agg(
            F.count("*").alias("rows"),
            *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(df.columns)],
            *[F.sum(F.length(F.col(f"`{c}`").cast("string"))).alias(f"s{i}") for i, c in enumerate(df.columns)],
        )
        entries = F.array(
            *[
                F.struct(
                    F.lit(c).alias("column"),
                    F.lit(kind).alias("type"),
                    F.col(f"n{i}").alias("nulls"),
                    F.coalesce(F.col(f"s{i}"), F.lit(0)).cast("bigint").alias("chars"),
                )
                for i, (c, kind) in enumerate(df.dtypes)
            ]
        )
        rows = counted.select(F.lit(source).alias("source"), "rows", F.explode(entries).alias("e"))
        reports.append(rows.select("source", "e.column", "e.type", "rows", "e.nulls", "e.chars"))
    result = reports[0]
    for report in reports[1:]:
        result = result.unionByName(report)
    return result


def read_standard(spark: SparkSession, glob: str, lines: bool = True) -> DataFrame:
    """Input of the feature job: what ``export_records`` writes, one record per line; arrays on request."""
    return load_json(spark, glob, schemas.FEATURE_INPUT, lines)


def read_typed(spark: SparkSession, glob: str, lines: bool = True) -> DataFrame:
    return load_json(spark, glob, schemas.TYPED_RECORD, lines)


def read_tagged(spark: SparkSession, paths: dict[str, str], schema: T.StructType, lines: bool = False) -> DataFrame:
    """Several files in one frame, each row tagged with its file's name in ``_src``."""
    result = None
    for tag, path in paths.items():
        part = load_json(spark, path, schema, lines).withColumn("_src", F.lit(tag))
        result = part if result is None else result.unionByName(part)
    return result


def read_chunks(
    spark: SparkSession,
    glob: str,
    schema: T.StructType,
    exclude: Iterable[str] = (),
    lists_only: bool = True,
) -> DataFrame:
    """All chunk files of a pattern, with file and position columns.

    Broken files are skipped.  So are, with ``lists_only``, files that hold a
    single object instead of a list.  A JSON file is one split, so the row id
    grows with the position inside its file.
    """
    raw = _read(spark, glob, schema, "json", {"multiLine": "true"}, placed=True).drop(BLOCK)
    rows = _drop_broken(raw, schema)
    for path in exclude:
        rows = rows.filter(~F.endswith(F.col(FILE), F.lit(path)))
    if lists_only and raw.inputFiles():
        # splits of one file are ordered by their offset, lines of one split by their row id
        lines = spark.read.text(glob).select(
            F.col("_metadata.file_path").alias(FILE),
            F.trim("value").alias("line"),
            F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("at"),
        )
        first = lines.filter(F.col("line") != "").groupBy(FILE).agg(F.min_by("line", "at").alias("line"))
        single = first.filter(F.startswith(F.col("line"), F.lit("{"))).select(FILE)
        rows = rows.join(single, FILE, "left_anti")
    return rows
