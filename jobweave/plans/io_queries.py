"""Queries that write the tables in some form to the shared folder and read them back."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from pyspark.sql.window import Window

from ..operators import clean, matching
from ..operators.ranking import renumber
from ..session import ensure_checkpoint_dir
from ..sources import arrays, bulk, readers, sinks
from ..sources.readers import FILE, POSITION
from ..sources.schemas import FEATURE_INPUT, SOURCES, STANDARD_COLUMNS
from ..streaming.chunks import merge_arrived
from . import jobs
from .analytics_queries import STANDARD_CTE, standard
from .derive import RAW, postings, postings_cte, raw_frames
from .matching_queries import chunk_rows
from .registry import ORACLES, joined, query, table


def _folder(spark, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


@query("json_array_ranges", "SELECT p_partkey, p_name, p_retailprice, p_partkey // 1000 AS chunk FROM part")
def json_array_ranges(spark, sf):
    """Parts as JSON array files of 5,000 records, each read by many tasks."""
    folder = _folder(spark, "arrays")
    parts = table(spark, sf, "part").selectExpr("p_partkey", "p_name", "p_retailprice", "p_partkey DIV 5000 AS chunk")
    record = F.to_json(F.struct(*parts.columns))
    files = parts.groupBy(F.col("chunk").alias("file")).agg(F.concat(F.lit("["), F.array_join(F.collect_list(record), ",\n"), F.lit("]")).alias("value"))
    files.write.partitionBy("file").text(folder)
    schema = T.StructType.fromDDL("p_partkey long, p_name string, p_retailprice double, chunk long")
    return arrays.load_array(spark, f"{folder}/file=*", schema, range_bytes=1 << 16)


@query(
    "bulk_index",
    "SELECT 'customers' AS \"index\", CAST(c_custkey AS VARCHAR) AS id, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
)
def bulk_index(spark, sf):
    """Customers as documents of a bulk load, sent twice: the ids keep one of each."""
    folder = _folder(spark, "bulk")
    rows = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    for _ in range(2):
        bulk.save_bulk(rows, folder, "customers", "c_custkey")
    document = F.from_json("value", "c_name string, c_nationkey int, c_acctbal double, c_mktsegment string").alias("d")
    return bulk.read_bulk(spark, folder).select("index", "id", document).select("index", "id", "d.*")


@query("chunk_merge_stream", ORACLES["chunk_merge"])
def chunk_merge_stream(spark, sf):
    """Seven chunk files that arrive in two parts, merged by two runs of a stream."""
    folder = _folder(spark, "chunks")
    chunks = chunk_rows(postings(spark, sf, "posting_id", "title", "company", "location", "link")).withColumnRenamed(FILE, "chunk")
    rows = chunks.drop("_position")
    schema = T.StructType([f for f in rows.schema.fields if f.name != "chunk"])
    for arrived in ("chunk < 4", "chunk >= 4"):
        rows.where(arrived).repartition(7, "chunk").write.mode("append").partitionBy("chunk").json(f"{folder}/in")
        merge_arrived(spark, f"{folder}/in", schema, "posting_id", f"{folder}/out", f"{folder}/state")
    merged = renumber(spark.read.parquet(f"{folder}/out"), FILE, "posting_id", name="stt")
    return merged.select("posting_id", F.col("`Liên_kết`").alias("link"), "stt")


# --- readers and sinks ---------------------------------------------------------------------------------------------

RUN_AT = datetime(2025, 1, 2, 3, 4, 5)


def _save_raw(spark, sf, folder, sources=tuple(RAW)) -> dict[str, str]:
    """Raw tables of the sources as JSON lines; a source that is not named has a path without a file."""
    frames = raw_frames(spark, sf)
    for source in sources:
        frames[source].drop("posting_id").write.json(f"{folder}/{source}")
    return {source: f"{folder}/{source}" for source in frames}


@query(
    "load_sources",
    f"WITH {postings_cte()} "
    + " UNION ALL ".join(
        f"SELECT '{s}' AS source, '{f.name}' AS \"column\", '{f.dataType.simpleString()}' AS type, count(*) AS rows, "
        f"count(*) - count({RAW[s].get(f.name, 'NULL')}) AS nulls, "
        f"coalesce(sum(length(CAST({RAW[s].get(f.name, 'NULL')} AS VARCHAR))), 0) AS chars "
        f"FROM postings WHERE source = '{s}'{' AND false' if s == 'joboko' else ''}"
        for s, schema in SOURCES.items()
        for f in schema
    ),
)
def load_sources(spark, sf):
    """Profile of the three sources as loaded, one of which has no file and gives no rows."""
    paths = _save_raw(spark, sf, _folder(spark, "raw"), ("careerlink", "topcv"))
    return readers.source_profile(readers.load_all_sources(spark, paths, lines=True))


def _write_arrays(rows, folder, per_file):
    """JSON array files ``file=N`` of at most ``per_file`` parts in the order of their keys."""
    record = F.struct("p_partkey", F.to_json(F.struct(*rows.columns)).alias("json"))
    files = rows.groupBy(F.expr(f"p_partkey DIV {per_file}").alias("file")).agg(F.array_sort(F.collect_list(record)).alias("r"))
    text = F.concat(F.lit("[\n"), F.array_join(F.col("r.json"), ",\n"), F.lit("\n]"))
    files.select("file", text.alias("value")).write.partitionBy("file").text(folder)


def _write_text(spark, value, path):
    spark.range(1, numPartitions=1).select(F.lit(value)).write.text(path)


_PARTS = T.StructType().add("p_partkey", "long").add("p_name", "string").add("p_size", "integer").add("p_retailprice", "double")


@query("load_arrays", "SELECT p_partkey, p_name, p_size, p_retailprice FROM part")
def load_arrays(spark, sf):
    """Parts in JSON array files, beside a file that breaks off and a path that does not exist."""
    folder = _folder(spark, "arrays")
    _write_arrays(table(spark, sf, "part").select(*_PARTS.names), folder, 5000)
    _write_text(spark, '[{"p_partkey": 1, "p_na', f"{folder}/file=broken")
    there = readers.load_json(spark, f"{folder}/file=*", _PARTS)
    return there.unionByName(readers.load_json(spark, f"{folder}/nowhere", _PARTS))


@query(
    "load_csv_export",
    f"WITH {postings_cte('posting_id', 'title', 'company', 'location', 'description', 'skills')} SELECT posting_id, title, nullif(company, '') AS company, "
    "nullif(location, '') AS location, '\"' || description || '\",' || chr(10) || ' ' || skills AS quoted FROM postings",
)
def load_csv_export(spark, sf):
    """CSV with byte-order marks, quotes, line breaks, outer blanks, empty and missing values, read back; empty ones are missing then."""
    folder = _folder(spark, "csv")
    rows = postings(spark, sf, "posting_id", "title", "company", "location", "description", "skills")
    quoted = F.concat(F.lit('"'), "description", F.lit('",\n '), "skills").alias("quoted")
    sinks.export_csv(rows.select("posting_id", "title", "company", "location", quoted), folder, bom=True)
    schema = T.StructType.fromDDL("posting_id long, title string, company string, location string, quoted string")
    return readers.load_csv(spark, folder, schema)


@query("read_tagged", "SELECT c_custkey, c_name, c_acctbal, lower(c_mktsegment) AS _src FROM customer")
def read_tagged(spark, sf):
    """Customers of each market segment in a file of its own, read as one table with the segment as tag."""
    folder = _folder(spark, "tagged")
    customers = table(spark, sf, "customer").selectExpr("c_custkey", "c_name", "c_acctbal", "lower(c_mktsegment) AS segment")
    customers.write.partitionBy("segment").json(folder)
    # the five market segments of the schema
    tags = ["automobile", "building", "furniture", "household", "machinery"]
    schema = T.StructType.fromDDL("c_custkey long, c_name string, c_acctbal double")
    return readers.read_tagged(spark, {tag: f"{folder}/segment={tag}" for tag in tags}, schema, lines=True)


@query(
    "read_chunk_files",
    "SELECT p_partkey, p_name, p_size, p_retailprice, p_partkey // 100 AS chunk, "
    "row_number() OVER (PARTITION BY p_partkey // 100 ORDER BY p_partkey) AS place FROM part WHERE p_partkey // 100 <> 1",
)
def read_chunk_files(spark, sf):
    """Chunk files in their order, without the excluded one, a broken one and one that is no list."""
    folder = _folder(spark, "chunks")
    _write_arrays(table(spark, sf, "part").select(*_PARTS.names), folder, 100)
    _write_text(spark, "[{", f"{folder}/file=broken")
    _write_text(spark, '{"p_partkey": 7, "p_name": "single"}', f"{folder}/file=single")
    excluded = ["/".join(path.split("/")[-2:]) for path in spark.read.text(f"{folder}/file=1").inputFiles()]
    rows = readers.read_chunks(spark, f"{folder}/file=*", _PARTS, exclude=excluded)
    # a file has at most 100 records
    place = F.row_number().over(Window.partitionBy(FILE).orderBy(POSITION)).alias("place")
    chunk = F.regexp_extract(FILE, "file=([0-9]+)", 1).cast("bigint").alias("chunk")
    return rows.select(*_PARTS.names, chunk, place)


@query("export_standard", f"WITH {STANDARD_CTE} SELECT {', '.join(STANDARD_COLUMNS)}, 15 AS columns FROM standard")
def export_standard(spark, sf):
    """Standard records exported and read again as the input of the feature job."""
    folder = _folder(spark, "export")
    sinks.export_records(standard(spark, sf).drop("posting_id"), folder, RUN_AT)
    rows = readers.read_standard(spark, f"{folder}/export-20250102_030405.json")
    return rows.select(*STANDARD_COLUMNS, F.lit(len(rows.columns)).alias("columns"))


_TYPED = {
    "id": ("CAST(o_orderkey AS INT)", "o_orderkey"),
    "source": ("'orders'", "'orders'"),
    "job_title": ("o_orderstatus", "o_orderstatus"),
    "salary_min": ("CAST(o_custkey AS INT)", "o_custkey"),
    "skills": ("split(o_orderpriority, '-')", "array_to_string(string_split(o_orderpriority, '-'), ';')"),
    "created_at": ("o_orderdate", "strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')"),
}


@query("read_typed", "SELECT " + ", ".join(f"{sql} AS {c}" for c, (_, sql) in _TYPED.items()) + ", 17 AS columns FROM orders")
def read_typed(spark, sf):
    """Typed records with numbers, lists and times, read back without the helper columns."""
    folder = _folder(spark, "typed")
    written = [f"{e} AS {c}" for c, (e, _) in _TYPED.items()]
    helpers = ["'x' AS original_id", "'y' AS sector", "0.5 AS sentiment_score"]
    table(spark, sf, "orders").selectExpr(*written, *helpers).write.json(folder)
    rows = clean.drop_helpers(readers.read_typed(spark, folder))
    columns = F.lit(len(rows.columns)).alias("columns")
    rows = rows.select(*_TYPED, columns).withColumn("skills", joined(F.col("skills")))
    return rows.withColumn("created_at", F.date_format("created_at", "yyyy-MM-dd HH:mm:ss"))


@query(
    "save_frames_index",
    " UNION ALL ".join(
        f"SELECT '{place}' AS place, id, name, balance FROM (SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, 'customers' AS t "
        f"FROM customer UNION ALL SELECT s_suppkey, s_name, s_acctbal, 'suppliers' FROM supplier) WHERE '{place}' LIKE '%' || t"
        for place in ("files/customers", "files/suppliers", "index/customers", "index/suppliers")
    ),
)
def save_frames_index(spark, sf):
    """Customers and suppliers saved as files and to an index by name, twice: the second load replaces the first."""
    folder = _folder(spark, "frames")
    customers = table(spark, sf, "customer").selectExpr("c_custkey AS id", "c_name AS name", "c_acctbal AS balance")
    suppliers = table(spark, sf, "supplier").selectExpr("s_suppkey AS id", "s_name AS name", "s_acctbal AS balance")
    names = ["customers", "suppliers"]
    for _ in range(2):
        sinks.save_frames([customers, suppliers], names, f"{folder}/files")
        sinks.save_index([customers, suppliers], names, "parquet", root=f"{folder}/index")
    schema = T.StructType.fromDDL("id long, name string, balance double")
    files = readers.read_tagged(spark, {f"files/{n}": f"{folder}/files/{n}" for n in names}, schema, lines=True)
    for name in names:
        indexed = spark.read.parquet(f"{folder}/index/{name}").withColumn("_src", F.lit(f"index/{name}"))
        files = files.unionByName(indexed)
    return files.withColumnRenamed("_src", "place")


_KEYS_KNOWN = "job_title_clean IS NOT NULL AND company_name IS NOT NULL AND location_clean IS NOT NULL"
_STANDARD_GROUPS = f"""g AS (SELECT job_title_clean, company_name, location_clean, count(*) AS n FROM standard
    WHERE {_KEYS_KNOWN} GROUP BY ALL HAVING count(*) > 1)"""


@query(
    "integration_run",
    f"""WITH {STANDARD_CTE}, {_STANDARD_GROUPS}, t AS (SELECT count(*) AS n, count(DISTINCT company_name) AS companies,
      count(DISTINCT location_clean) AS locations FROM standard)
    SELECT source, count(*) AS raw_records, count(*) AS processed_records, any_value(t.n) AS total, any_value(companies) AS companies,
      any_value(locations) AS locations, (SELECT coalesce(sum(n), 0) FROM g) AS duplicate_count,
      round((SELECT coalesce(sum(n), 0) FROM g) / any_value(t.n) * 100, 2) AS duplicate_rate, 3 AS files_read
    FROM standard, t GROUP BY source""",
)
def integration_run(spark, sf):
    """The whole integration job over stored sources: what its three exports say, read back."""
    folder = _folder(spark, "integration")
    paths = _save_raw(spark, sf, f"{folder}/raw")
    written = jobs.integrate(spark, f"{folder}/out", paths, RUN_AT, lines=True)
    summary = spark.read.schema(
        "data_sources map<string, struct<raw_records: bigint, processed_records: bigint>>, "
        "statistics struct<total_processed_records: bigint, unique_companies: bigint, unique_locations: bigint>, "
        "data_matching struct<duplicate_rate: double>, files_generated struct<records: string, report: string>"
    ).json(written["summary"])
    report = spark.read.schema("duplicate_count bigint").json(written["report"])
    # one row each; a row per source after that
    both = summary.join(F.broadcast(report), F.lit(True), "left")
    per_source = both.select("*", F.explode("data_sources").alias("source", "counts"))
    known = [F.lit(written["records"]) == F.col("files_generated.records"), F.lit(written["report"]) == F.col("files_generated.report")]
    result = per_source.select(
        "source",
        "counts.raw_records",
        "counts.processed_records",
        F.col("statistics.total_processed_records").alias("total"),
        F.col("statistics.unique_companies").alias("companies"),
        F.col("statistics.unique_locations").alias("locations"),
        "duplicate_count",
        "data_matching.duplicate_rate",
        (F.lit(1) + known[0].cast("int") + known[1].cast("int")).alias("files_read"),
    )
    records = readers.load_json(spark, written["records"], FEATURE_INPUT, lines=True).groupBy("source").agg(F.count("*").alias("processed_records"))
    return result.join(F.broadcast(records), ["source", "processed_records"])


@query(
    "match_raw_sources",
    f"""WITH {postings_cte('posting_id', 'source', 'title', 'company', 'location')}, d AS (SELECT title, company, location FROM postings
      WHERE title IS NOT NULL AND company IS NOT NULL AND location IS NOT NULL GROUP BY ALL HAVING count(*) > 1),
    g AS (SELECT *, row_number() OVER (ORDER BY title, company, location) - 1 AS duplicate_group FROM d)
    SELECT posting_id, source, duplicate_group IS NOT NULL AS is_duplicate, duplicate_group
    FROM postings LEFT JOIN g USING (title, company, location)""",
)
def match_raw_sources(spark, sf):
    """The matching step over the raw tables of the sources: which records are exact duplicates of which."""
    matched = matching.match_sources(raw_frames(spark, sf), raw=True, row_order=["posting_id"])
    flagged = matched.duplicates.select("row_id", "is_duplicate", "duplicate_group")
    rows = postings(spark, sf, "posting_id", "source")
    return renumber(rows, "source", "posting_id", name="row_id").join(flagged, "row_id").drop("row_id")
