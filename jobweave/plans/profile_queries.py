"""Queries about what columns hold: measured types, samples, sketches, and keys seen by earlier loads."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import measured, schema_match, seen, sketches
from ..session import ensure_checkpoint_dir
from ..sources.readers import load_variants
from .analytics_queries import _MAPPING_SQL
from .derive import RAW, postings, postings_cte, raw_frames
from .registry import joined, query, table

_VALUE = """CASE p_partkey % 8 WHEN 0 THEN CAST(p_size AS STRING) WHEN 1 THEN concat(' -', CAST(p_size AS STRING), '.5 ')
 WHEN 2 THEN 'True' WHEN 3 THEN '2024-02-30' WHEN 4 THEN '2024-02-28' WHEN 5 THEN ' ' WHEN 6 THEN '1e3' ELSE CAST(NULL AS STRING) END"""
_TEXTS = {
    "mixed": _VALUE,
    "whole": "CASE WHEN p_partkey % 3 = 0 THEN '' ELSE CAST(p_size AS STRING) END",
    "number": "CASE WHEN p_partkey % 5 = 0 THEN CAST(p_size AS STRING) ELSE concat(CAST(p_size AS STRING), '.25') END",
    "day": "CASE WHEN p_partkey % 2 = 0 THEN '2024-12-31' ELSE CAST(NULL AS STRING) END",
    "salary": "salary_text",
    "nothing": "CAST(NULL AS STRING)",
}
_KIND_SQL = """CASE WHEN coalesce(trim(v), '') = '' THEN 'null' WHEN regexp_matches(trim(v), '^[+-]?[0-9]+$') THEN 'int'
  WHEN try_cast(trim(v) AS DOUBLE) IS NOT NULL THEN 'double' WHEN lower(trim(v)) IN ('true', 'false') THEN 'boolean'
  WHEN regexp_matches(trim(v), '^[0-9]{4}-[0-9]{2}-[0-9]{2}$') AND try_cast(trim(v) AS DATE) IS NOT NULL THEN 'date' ELSE 'string' END"""


@query(
    "measured_types",
    f"WITH {postings_cte('posting_id', 'salary_text')}, t AS ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {e} AS v FROM {'postings' if c == 'salary' else 'part'}" for c, e in _TEXTS.items()
    )
    + f"""), k AS (SELECT "column", {_KIND_SQL} AS kind FROM t), c AS (SELECT "column", count(*) AS rows,
      {", ".join(f"count(*) FILTER (WHERE kind = '{k}') AS {chr(34)}{k}{chr(34)}" for k in measured.KINDS)},
      list_filter(list_sort(list(DISTINCT kind)), lambda x: x <> 'null') AS ks FROM k GROUP BY "column"),
    y AS (SELECT *, CASE WHEN len(ks) = 0 THEN 'null' WHEN len(ks) = 1 THEN ks[1] WHEN ks = ['double', 'int'] THEN 'double'
      ELSE 'string' END AS type FROM c)
    SELECT "column", rows, "null", "int", "double", "boolean", "date", "string", type, CASE type WHEN 'int' THEN "int"
      WHEN 'double' THEN "double" WHEN 'boolean' THEN "boolean" WHEN 'date' THEN "date" WHEN 'string' THEN "string" END
      / nullif(rows - "null", 0) AS share FROM y""",
)
def measured_types(spark, sf):
    """What the texts of six columns spell, measured in seven parts and added up."""
    from_part = table(spark, sf, "part").selectExpr("p_partkey", *[f"{e} AS {c}" for c, e in _TEXTS.items() if c != "salary"])
    rows = from_part.selectExpr("p_partkey % 7 AS part", "* EXCEPT (p_partkey)")
    salaries = postings(spark, sf, "posting_id", "salary_text").selectExpr("posting_id % 7 AS part", "salary_text AS salary")
    parts = [measured.measure(rows, "part"), measured.measure(salaries, "part")]
    return measured.with_type(measured.merge_measures(*parts))


# field -> source -> (text or written JSON, its expression over the postings, kind of the value)
_MEMBERS = {
    "job_title": dict.fromkeys(RAW, ("text", "title", "'string'")),
    "salary": {
        "careerlink": ("json", "CAST(posting_id AS STRING)", "'int'"),
        "joboko": ("text", "salary_text", "CASE WHEN salary_text IS NULL THEN 'null' ELSE 'string' END"),
        "topcv": ("json", "CASE WHEN posting_id % 2 = 0 THEN CAST(posting_id AS STRING) ELSE concat(CAST(posting_id AS STRING), '.5') END",
                  "CASE WHEN posting_id % 2 = 0 THEN 'int' ELSE 'double' END"),
    },
    "experience": {
        "careerlink": ("json", "CAST(posting_id % 9 AS STRING)", "'int'"),
        "joboko": ("json", "CASE WHEN posting_id % 4 = 0 THEN 'null' ELSE CAST(posting_id % 9 AS STRING) END",
                   "CASE WHEN posting_id % 4 = 0 THEN 'null' ELSE 'int' END"),
        "topcv": ("json", "CASE WHEN posting_id % 4 = 0 THEN '\"5 năm\"' ELSE CAST(posting_id % 9 AS STRING) END",
                  "CASE WHEN posting_id % 4 = 0 THEN 'string' ELSE 'int' END"),
    },
    "location": {
        "careerlink": ("json", "'null'", "'null'"),
        "joboko": ("text", "location", "CASE WHEN location IS NULL THEN 'null' ELSE 'string' END"),
        "topcv": ("text", "location", "CASE WHEN location IS NULL THEN 'null' ELSE 'string' END"),
    },
}
_KINDS_SQL = " UNION ALL ".join(
    f"SELECT source, '{field}' AS field, {kind} AS kind FROM postings WHERE source = '{source}'"
    for field, sources in _MEMBERS.items()
    for source, (_, _, kind) in sources.items()
)


@query(
    "schema_measured",
    f"""WITH {postings_cte('posting_id', 'source', 'title', 'location', 'salary_text')}, k AS ({_KINDS_SQL}),
    s AS (SELECT source, field, ['null', 'int', 'double', 'string'][max(list_position(['null', 'int', 'double', 'string'], kind))] AS type,
      count(*) FILTER (WHERE kind <> 'null') AS filled FROM k GROUP BY source, field),
    t AS (SELECT field, type, count(*) AS n, sum(filled) AS filled FROM s GROUP BY field, type)
    SELECT field, max_by(type, (n, type)) AS most_common_type, max(n) / sum(n) AS consistency_score,
      array_to_string(list_sort(list(type)), ';') AS all_types, sum(filled) AS filled FROM t GROUP BY field""",
)
def schema_measured(spark, sf):
    """Agreement of three JSON sources on the types that their values have."""
    folder = f"{ensure_checkpoint_dir(spark)}/typed-{uuid.uuid4().hex}"
    rows = postings(spark, sf, "posting_id", "source", "title", "location", "salary_text")
    frames = {}
    for source in RAW:
        members = []
        for field, sources in _MEMBERS.items():
            form, value, _ = sources[source]
            value = F.expr(value) if form == "text" else F.parse_json(F.expr(value))
            members.append(value.alias(schema_match.EXPECTED[source][field]))
        record = F.to_json(F.struct(*members), {"ignoreNullFields": "false"})
        rows.where(F.col("source") == source).select(record.alias("value")).write.text(f"{folder}/{source}")
        names = [schema_match.EXPECTED[source][field] for field in _MEMBERS]
        frames[source] = load_variants(spark, f"{folder}/{source}", names)
    result = schema_match.analyze(frames, measured=True)
    counts = result["schemas"].select("source", "column", (F.col("rows") - F.col("null")).alias("filled"))
    filled = result["mapping"].join(counts, ["source", "column"]).groupBy("field").agg(F.sum("filled").alias("filled"))
    fields = result["fields"].join(filled, "field").withColumn("all_types", joined(F.col("all_types")))
    return fields.select("field", "most_common_type", "consistency_score", "all_types", "filled")


_SAMPLES_SQL = " UNION ALL ".join(
    f"SELECT '{s}' AS source, {i} AS position, '{c}' AS \"column\", posting_id, {e} AS v FROM postings WHERE source = '{s}'"
    for s, columns in RAW.items()
    for i, (c, e) in enumerate(columns.items())
)


@query(
    "schema_description",
    f"""WITH RECURSIVE {postings_cte()}, {_MAPPING_SQL}, v AS ({_SAMPLES_SQL}),
    f AS (SELECT * FROM v WHERE v IS NOT NULL QUALIFY row_number() OVER (PARTITION BY source, "column" ORDER BY posting_id) <= 3),
    s AS (SELECT source, "column", string_agg(v, ' | ' ORDER BY posting_id) AS samples FROM f GROUP BY ALL),
    r AS (SELECT source, "column", min(field) AS field FROM mapped GROUP BY ALL)
    SELECT DISTINCT source, position, "column", 'string' AS type, coalesce(samples, '') AS samples, field
    FROM v LEFT JOIN s USING (source, "column") LEFT JOIN r USING (source, "column")""",
)
def schema_description(spark, sf):
    """Columns of the raw sources with type, first values and standard field."""
    described = schema_match.analyze(raw_frames(spark, sf), row_id="posting_id")["described"]
    return described.withColumn("samples", F.array_join("samples", " | "))


#: Four and a half standard errors of the distinct counts, and twice the rank error of the quantiles.
BOUND = 0.03


@query(
    "sketch_accuracy",
    "SELECT event_type, count(*) AS records, count(DISTINCT user_id) AS users, true AS users_within, true AS median_within "
    "FROM events GROUP BY event_type",
)
def sketch_accuracy(spark, sf):
    """Sketches stored per event type and day, merged over the days, against the exact counts and ranks."""
    folder = f"{ensure_checkpoint_dir(spark)}/sketches-{uuid.uuid4().hex}"
    events = table(spark, sf, "events").select("event_type", "user_id", "value", F.to_date("ts").alias("day"))
    sketches.save_sketches(sketches.sketch(events, ["event_type", "day"], ["user_id"], ["value"]), folder)
    merged = sketches.merge(sketches.load_sketches(spark, folder), ["event_type"])
    told = sketches.estimates(merged).withColumnRenamed("rows", "sketched")
    # one row per event type
    exact = events.join(F.broadcast(told), "event_type").groupBy("event_type", "unique_user_id", "sketched").agg(
        F.count("*").alias("records"),
        F.count_distinct("user_id").alias("users"),
        F.count("value").alias("filled"),
        F.count_if(F.col("value") < F.col("median_value")).alias("below"),
        F.count_if(F.col("value") <= F.col("median_value")).alias("upto"),
    )
    off = F.abs(F.col("unique_user_id") - F.col("users"))
    middle = (F.col("below") <= F.col("filled") * (0.5 + BOUND)) & (F.col("upto") >= F.col("filled") * (0.5 - BOUND))
    return exact.where("sketched = records").select(
        "event_type",
        "records",
        "users",
        (off <= F.col("users") * BOUND).alias("users_within"),
        middle.alias("median_within"),
    )


@query(
    "suppress_seen_stored",
    "SELECT o_orderkey % 3 AS load, o_custkey, min(o_orderkey) AS o_orderkey FROM orders GROUP BY load, o_custkey "
    "QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY load) = 1",
)
def suppress_seen_stored(spark, sf):
    """Three loads of orders: the first order of each customer that no earlier load brought."""
    run = uuid.uuid4().hex
    folder = f"{ensure_checkpoint_dir(spark)}/seen-{run}"
    orders = table(spark, sf, "orders").selectExpr("o_custkey", "o_orderkey", "o_orderkey % 3 AS load")
    name = f"seen_{run}"
    known = seen.open_seen(spark, name, f"{folder}/keys", "o_custkey", "bigint", 16)
    for load in range(3):
        fresh = seen.fresh_rows(orders.where(F.col("load") == load), known, "o_custkey", ["o_orderkey"])
        fresh.write.mode("append").parquet(f"{folder}/rows/part={load}")
        seen.append_seen(spark.read.parquet(f"{folder}/rows/part={load}"), name, "o_custkey")
        known = spark.table(name)
    spark.sql(f"DROP TABLE `{name}`")  # the files stay
    return spark.read.parquet(f"{folder}/rows/part=*").select("load", "o_custkey", "o_orderkey")
