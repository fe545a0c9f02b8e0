"""Which source column plays which standard role, and how well the sources agree."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.similarity import ratio
from .measured import measure, with_type
from .ranking import sample_values

NAME_THRESHOLD = 0.8
COMPATIBLE_FROM = 0.5
ADVICE_BELOW = 0.7
ADVICE = "Low schema compatibility detected. Consider data preprocessing."

# The column expected for each standard field, per source.
EXPECTED = {
    "careerlink": {
        "job_title": "tên công việc",
        "company_name": "tên công ty",
        "location": "Địa điểm công việc",
        "salary": "Mức lương",
        "industry": "ngành nghề",
        "job_description": "mô tả công việc",
        "skills": "kĩ năng yêu cầu",
        "experience": "Kinh nghiệm",
        "job_type": "loại công việc",
        "job_level": "cấp bậc",
        "education": "học vấn",
        "benefits": "quyền lợi",
    },
    "joboko": {
        "job_title": "tên công việc",
        "company_name": "tên công ty",
        "location": "địa điểm",
        "salary": "mức lương",
        "industry": "ngành nghề",
        "job_description": "mô tả công việc",
        "skills": "kĩ năng yêu cầu",
        "experience": "kinh nghiệm",
        "job_type": "loại công việc",
        "job_level": "cấp bậc",
        "education": "học vấn",
        "benefits": "quyền lợi",
    },
    "topcv": {
        "job_title": "tên công việc",
        "company_name": "tên công ty",
        "location": "địa điểm",
        "salary": "mức lương",
        "industry": "ngành nghề",
        "job_description": "mô tả công việc",
        "skills": "kĩ năng yêu cầu",
        "experience": "kinh nghiệm",
        "job_type": "loại công việc",
        "job_level": "cấp bậc",
        "education": "học vấn",
        "benefits": "quyền lợi",
    },
}
STANDARD_FIELDS = list(EXPECTED["joboko"])
# Declared type per standard field.
FIELD_TYPES = {
    "job_title": "string", "company_name": "string", "location": "string", "salary_min": "numeric",
    "salary_max": "numeric", "industry": "string", "job_description": "string", "skills": "string",
    "experience": "numeric", "rating": "numeric", "company_size": "string",
}


def expected_columns(spark: SparkSession) -> DataFrame:
    """``source, field, expected`` dimension: a few dozen rows."""
    rows = [(source, field, name) for source, fields in EXPECTED.items() for field, name in fields.items()]
    return spark.createDataFrame(rows, "source string, field string, expected string")


def detect_schema(frames: dict[str, DataFrame]) -> DataFrame:
    """``source, position, column, type``: metadata only, no data is read."""
    rows = [
        (source, position, name, kind)
        for source, df in frames.items()
        for position, (name, kind) in enumerate(df.dtypes)
    ]
    spark = next(iter(frames.values())).sparkSession
    return spark.createDataFrame(rows, "source string, position int, column string, type string")


def measured_schema(frames: dict[str, DataFrame], parse: bool = False) -> DataFrame:
    """Schema rows with the type that the values have, and the counts per kind it follows from.

    One pass per source.  JSON values read as variants count as they were written; ``parse`` asks what texts
    spell, for sources that hold nothing but text.  Columns of an empty table have no type.
    """
    measures = [measure(df, parse=parse).withColumn("source", F.lit(source)) for source, df in frames.items()]
    typed = with_type(reduce(DataFrame.unionByName, measures))
    return detect_schema(frames).drop("type").join(typed, ["source", "column"], "left")


def describe_schema(frames: dict[str, DataFrame], row_id: str, rows: DataFrame | None = None) -> DataFrame:
    """``source, position, column, type, samples, field``: the first three values of each column, and its role.

    ``rows`` are schema rows made before, of the frames without ``row_id``.
    """
    if rows is None:
        rows = detect_schema({s: df.drop(row_id) for s, df in frames.items()})
    parts = [
        sample_values(df, name, row_id).withColumn("source", F.lit(source))
        for source, df in frames.items()
        for name in df.columns
        if name != row_id
    ]
    values = reduce(DataFrame.unionByName, parts).groupBy("source", "column")
    # three rows for each column
    samples = values.agg(F.transform(F.array_sort(F.collect_list(F.struct("row_id", "value"))), lambda v: v["value"]).alias("samples"))
    described = rows.join(samples, ["source", "column"], "left")
    roles = map_columns(rows).groupBy("source", "column").agg(F.min("field").alias("field"))
    empty = F.array().cast("array<string>")
    return described.join(roles, ["source", "column"], "left").withColumn("samples", F.coalesce("samples", empty))


def map_columns(schema_rows: DataFrame) -> DataFrame:
    """``source, field, column, type, score``: an exact name first, else the most similar above the threshold."""
    expected = expected_columns(schema_rows.sparkSession)
    pairs = schema_rows.join(F.broadcast(expected), "source")
    pairs = pairs.withColumn("exact", F.col("column") == F.col("expected"))
    pairs = pairs.withColumn("score", ratio(F.lower("column"), F.lower("expected")))
    best = Window.partitionBy("source", "field").orderBy(F.desc("exact"), F.desc("score"), "position")
    ranked = pairs.filter(F.col("exact") | (F.col("score") > NAME_THRESHOLD)).withColumn("rank", F.row_number().over(best))
    return ranked.filter("rank = 1").select("source", "field", "column", "type", "score")


def unified_schema(mapped: DataFrame, n_sources: int) -> DataFrame:
    """Coverage of each field over the sources."""
    covered = mapped.groupBy("field").agg(F.array_sort(F.collect_set("source")).alias("sources"))
    return covered.select(
        "field",
        "sources",
        (F.size("sources") / F.lit(n_sources)).alias("coverage_rate"),
        (F.size("sources") == n_sources).alias("is_common"),
    )


def standard_schema(mapped: DataFrame, n_sources: int) -> DataFrame:
    """All standard fields with their declared type, covered or not."""
    fields = [(field, FIELD_TYPES.get(field, "string")) for field in STANDARD_FIELDS]
    declared = mapped.sparkSession.createDataFrame(fields, "field string, declared_type string")
    covered = declared.join(unified_schema(mapped, n_sources), "field", "left")
    return covered.select(
        "field",
        "declared_type",
        F.coalesce("sources", F.array().cast("array<string>")).alias("sources"),
        F.coalesce("coverage_rate", F.lit(0.0)).alias("coverage_rate"),
        F.coalesce("is_common", F.lit(False)).alias("is_common"),
    )


def field_compatibility(mapped: DataFrame, n_sources: int) -> DataFrame:
    """Coverage and type agreement per field."""
    types = mapped.groupBy("field", "type").agg(F.count("*").alias("n"))
    dominant = types.groupBy("field").agg(
        F.max(F.struct("n", "type")).alias("top"),
        F.sum("n").alias("total"),
        F.array_sort(F.collect_set("type")).alias("all_types"),
    )
    consistency = dominant.select(
        "field",
        F.col("top.type").alias("most_common_type"),
        (F.col("top.n") / F.col("total")).alias("consistency_score"),
        "all_types",
    )
    coverage = unified_schema(mapped, n_sources).withColumnRenamed("coverage_rate", "coverage")
    return coverage.withColumn("is_compatible", F.col("coverage") >= COMPATIBLE_FROM).join(consistency, "field")


def overall_compatibility(fields: DataFrame) -> DataFrame:
    """Share of compatible fields (0 when there is none) and advice."""
    share = F.coalesce(F.try_divide(F.count_if("is_compatible").cast("double"), F.count("*")), F.lit(0.0))
    return fields.agg(F.count("*").alias("fields"), share.alias("overall_compatibility")).withColumn(
        "recommendation", F.when(F.col("overall_compatibility") < ADVICE_BELOW, F.lit(ADVICE)).otherwise("")
    )


def analyze(
    frames: dict[str, DataFrame], row_id: str | None = None, measured: bool = False
) -> dict[str, DataFrame]:
    """Schema rows, mapping, unified schema and compatibility of the non-empty sources.

    ``measured`` takes types from the values instead of the declared columns.  With ``row_id``, a column that
    orders the rows and has no role, the result also has ``described``: samples and roles of the columns.
    """
    filled = {source: df for source, df in frames.items() if not df.isEmpty()}
    plain = {source: df.drop(row_id) for source, df in filled.items()} if row_id else filled
    rows = measured_schema(plain) if measured else detect_schema(plain)
    mapped = map_columns(rows)
    fields = field_compatibility(mapped, len(filled))
    described = {"described": describe_schema(filled, row_id, rows)} if row_id else {}
    return described | {
        "schemas": rows,
        "mapping": mapped,
        "unified": unified_schema(mapped, len(filled)),
        "standard": standard_schema(mapped, len(filled)),
        "fields": fields,
        "overall": overall_compatibility(fields),
    }
