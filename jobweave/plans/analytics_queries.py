"""Queries for integration, features, counts, schema matching and quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import salary, terms, vocab
from ..functions.location import CITIES, vietnamese_city
from ..functions.experience import vietnamese_experience
from ..operators import aggregates, clean, quality, schema_match
from ..operators.aggregates import one_row
from ..sources.readers import source_profile
from ..sources.schemas import STANDARD_COLUMNS
from ..sources.sinks import documents, in_order, renamed
from . import features as fx
from . import jobs
from .derive import RAW, line_postings, line_postings_cte, postings, postings_cte, raw_frames
from .extract import extract_features, extract_raw_features, extract_typed_features
from .features import _BOTH, _bins_text_sql, _clean_sql, _match_sql, _salary_a_sql, _salary_b_sql, _VI
from .matching_queries import lcs_sql
from .registry import joined, query, sql_list, table, wide_table

# --- standard record ------------------------------------------------------------------------------------------------

_CLEANED = {
    "job_title_clean": "title", "company_name": "company", "location_clean": "location", "industry": "industry",
    "job_description": "description", "skills": "skills", "job_type": "job_type", "job_level": "job_level",
    "education": "education",
}
_NEVER = {
    "careerlink": [],
    "joboko": ["education"],
    "topcv": ["industry", "job_type", "job_level", "education", "experience_text"],
}


def _standard_sql(source: str) -> str:
    columns = [f"'{source}' AS source", "posting_id"]
    for target, raw in _CLEANED.items():
        columns.append(f"{'NULL' if target in _NEVER[source] else _clean_sql(raw)} AS {target}")
    columns.append("salary_text")
    columns.append(f"{'NULL' if 'experience_text' in _NEVER[source] else 'experience_text'} AS experience_text")
    return f"SELECT {', '.join(columns)} FROM postings WHERE source = '{source}'"


STANDARD_CTE = postings_cte() + ", standard AS (" + " UNION ALL BY NAME ".join(_standard_sql(s) for s in _NEVER) + ")"


def standard(spark, sf):
    cleaned = clean.clean_all(raw_frames(spark, sf))
    return clean.combine({source: clean.standardize(df, extra=["posting_id"]) for source, df in cleaned.items()})


@query("standard_records", f"WITH {STANDARD_CTE} SELECT * FROM standard")
def standard_records(spark, sf):
    return standard(spark, sf)


@query("standard_counts", f"WITH {STANDARD_CTE} SELECT source, count(*) AS records FROM standard GROUP BY ROLLUP (source)")
def standard_counts(spark, sf):
    return aggregates.source_counts(standard(spark, sf))


@query(
    "clean_wide",
    _salary_a_sql(
        postings_cte(),
        f"""SELECT posting_id, source, salary_min, salary_max,
      coalesce(list_filter({sql_list(CITIES)}, lambda x: contains(location, x))[1],
        trim(string_split(trim(location), ',')[1]), '') AS city,
      CASE WHEN len(string_split(trim(location), ',')) > 1 THEN trim(string_split(trim(location), ',')[-1]) ELSE '' END AS state,
      'Vietnam' AS country, CASE WHEN source = 'topcv' THEN {_clean_sql('industry')} ELSE '' END AS benefits,
      CASE WHEN source = 'topcv' THEN {_clean_sql('schedule')} END AS work_time,
      CASE WHEN source <> 'topcv' THEN CASE WHEN regexp_matches(lower(experience_text), 'không yêu cầu') THEN 0
        {_VI.replace('(t,', '(lower(experience_text),')} END END AS experience FROM r""",
    ),
)
def clean_wide(spark, sf):
    """Everything the cleaners compute beyond the standard columns."""
    cleaned = clean.clean_all(raw_frames(spark, sf))
    wide = [c for c in clean.WIDE_COLUMNS if c != "company_size"]
    picked = {
        s: df.select("posting_id", *[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in wide])
        for s, df in cleaned.items()
    }
    return clean.combine(picked)


@query(
    "union_sources",
    f"""WITH {postings_cte()} SELECT source, posting_id, title AS k_title, company AS k_company, location AS k_location,
    CASE WHEN source = 'joboko' THEN link END AS link FROM postings""",
)
def union_sources(spark, sf):
    """Raw sources in one frame, keys picked from whichever raw column exists."""
    frames = {s: clean.map_raw_for_matching(df, s) for s, df in raw_frames(spark, sf).items()}
    combined = clean.combine(frames)
    title, company, place = clean.key_columns(combined.columns)
    return combined.select(
        "source",
        "posting_id",
        F.col(title).alias("k_title"),
        F.col(company).alias("k_company"),
        F.col(place).alias("k_location"),
        "link",
    )


@query(
    "alias_columns",
    f"WITH {postings_cte('posting_id', 'source', 'title', 'company', 'location', 'salary_text', 'description')} "
    "SELECT source, posting_id, title AS \"tên công việc\", company AS \"tên công ty\", "
    "CASE source WHEN 'careerlink' THEN NULL ELSE location END AS \"địa điểm\", "
    "CASE source WHEN 'careerlink' THEN NULL ELSE salary_text END AS \"mức lương\", "
    "description AS \"mô tả công việc\" FROM postings",
)
def alias_columns(spark, sf):
    """Every source under the common names; one without a column has nulls there."""
    names = ["tên công việc", "tên công ty", "địa điểm", "mức lương", "mô tả công việc"]
    parts = []
    for source, raw in raw_frames(spark, sf).items():
        aliased = clean.alias_columns(raw, clean.DIALECTS[source].aliases)
        picked = [F.col(f"`{n}`") if n in aliased.columns else F.lit(None).cast("string").alias(n) for n in names]
        parts.append(aliased.select(F.lit(source).alias("source"), "posting_id", *picked))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "export_renamed",
    f"WITH {postings_cte('posting_id', 'title', 'education')} SELECT posting_id AS stt, title AS \"tên công việc\", "
    "education AS \"học vấn\" FROM postings",
)
def export_renamed(spark, sf):
    rows = postings(spark, sf, "posting_id", "title", "education", "link")
    rows = rows.withColumnsRenamed({"posting_id": "stt", "title": "detail_title"})
    return renamed(rows)


@query(
    "export_ordered",
    f"WITH {postings_cte('posting_id', 'title', 'company', 'deadline')} SELECT posting_id AS stt, title, company, deadline "
    "FROM postings ORDER BY coalesce(stt, 0)",
)
def export_ordered(spark, sf):
    """Existing columns in the fixed order, rows in number order (null as 0)."""
    from ..sources.schemas import DETAIL_ORDER

    rows = postings(spark, sf, "deadline", "company", "title", "posting_id")
    rows = in_order(rows.withColumnRenamed("posting_id", "stt"), DETAIL_ORDER)
    return rows.orderBy(F.coalesce("stt", F.lit(0)))


@query("export_documents", f"WITH {postings_cte('posting_id', 'title', 'skills', 'salary_text')} SELECT * FROM postings")
def export_documents(spark, sf):
    """Rows as JSON documents, read back field by field."""
    docs = documents(postings(spark, sf, "posting_id", "title", "skills", "salary_text"))
    parsed = F.from_json("value", "posting_id bigint, title string, skills string, salary_text string")
    return docs.select(parsed.alias("d")).select("d.*")


# --- features -------------------------------------------------------------------------------------------------------

_SPLIT = "regexp_split_to_array(location_clean, ',\\s*')"


@query(
    "feature_records",
    _salary_b_sql(
        STANDARD_CTE.replace("postings AS (", "base AS (", 1).replace("FROM postings", "FROM base") + ", postings AS (SELECT * FROM standard)",
        f"""SELECT posting_id, source, job_title_clean AS title, company_name AS company, location_clean AS location_raw,
      salary_min, salary_max, (salary_min + salary_max) / 2 AS salary_avg, job_type, job_level, industry, skills,
      job_description AS description, salary_text, experience_text,
      {_match_sql("coalesce(job_description, '') || ' ' || coalesce(skills, '')", terms.PROGRAMMING_LANGUAGES)} AS "JobLanguages",
      {_match_sql("coalesce(skills, '')", list(terms.LANGUAGES), list(terms.LANGUAGES.values()))} AS "Languages",
      {_match_sql("coalesce(job_description, '') || ' ' || coalesce(skills, '')", terms.DESIGN_PATTERNS)} AS "DesignPatterns",
      {_match_sql("coalesce(job_description, '') || ' ' || coalesce(skills, '')", terms.KNOWLEDGE)} AS "Knowledges",
      {_match_sql("coalesce(education, '')", terms.EDUCATION)} AS "Education",
      {_match_sql("coalesce(industry, '')", list(terms.JOB_TYPES), list(terms.JOB_TYPES.values()))} AS "JobSummary",
      array_to_string({fx._expand_sql(1, 10).replace('len(n)', 'len(nn)').replace('(n[', '(nn[').replace('least(n[', 'least(nn[').replace('ELSE n END', 'ELSE nn END')}, ';') AS "Experience",
      trim({_SPLIT}[1], ' ') AS location_area, trim({_SPLIT}[2], ' ') AS province FROM
      (SELECT *, {fx._NUMBERS} AS nn FROM r)""",
    ),
)
def feature_records(spark, sf):
    rows = standard(spark, sf).withColumn("experience", F.lit(None).cast("string"))
    # the id rides along in the source column, so that the 24-column record itself stays as it is
    tagged = rows.withColumn("source", F.concat_ws("|", "source", F.col("posting_id").cast("string")))
    out = extract_features(tagged).drop("experience_avg")
    arrays = [c for c, t in out.dtypes if t.startswith("array")]
    out = out.withColumns({c: joined(F.col(c)) for c in arrays})
    return out.withColumn("posting_id", F.split_part("source", F.lit("|"), F.lit(2)).cast("bigint")).withColumn(
        "source", F.split_part("source", F.lit("|"), F.lit(1))
    )


@query(
    "feature_raw_records",
    _bins_text_sql(
        postings_cte(),
        f"""SELECT posting_id AS "JobName", company AS "CompanyName", job_type AS "JobType", job_level AS "Level",
      {_match_sql("coalesce(skills, '')", terms.EDUCATION)} AS "Education",
      list_filter({sql_list(fx.location.PROVINCES)}, lambda x: contains(lower(location), lower(x)))[1] AS "Location",
      {_match_sql(_BOTH, terms.FRAMEWORKS)} AS "FrameworkPlattforms",
      {_match_sql(_BOTH, terms.KNOWLEDGE)} AS "Knowledges",
      coalesce(array_to_string(l, ';'), '') AS "Salaries"
    FROM postings LEFT JOIN f USING (salary_text)""",
    ),
)
def feature_raw_records(spark, sf):
    raw = postings(spark, sf).selectExpr(
        "CAST(posting_id AS STRING) AS `tên công việc`", "company AS `tên công ty`", "location AS `địa điểm`",
        "salary_text AS `mức lương`", "experience_text AS `kinh nghiệm`", "description AS `mô tả công việc`",
        "skills AS `kĩ năng yêu cầu`", "job_type AS `loại công việc`", "job_level AS `cấp bậc`",
        "CAST(NULL AS STRING) AS `giới tính`", "experience_text AS `tuổi`", "industry AS `ngành nghề`",
    )
    out = extract_raw_features(raw)
    arrays = [c for c, t in out.dtypes if t.startswith("array")]
    out = out.withColumns({c: joined(F.col(c)) for c in arrays}).withColumn("JobName", F.col("JobName").cast("bigint"))
    return out.select(
        "JobName", "CompanyName", "JobType", "Level", "Education", "Location", "FrameworkPlattforms", "Knowledges", "Salaries"
    )


_TYPED_TEXT = "'Java ' || p_name || ' Git, Docker'"


@query(
    "feature_typed_records",
    f"""SELECT p_partkey AS "JobName", p_brand AS "CompanyName", 'Hồ Chí Minh' AS "Location", p_size AS "Experience", p_type AS "JobType",
      'Cử nhân' AS "Education", {_match_sql(_TYPED_TEXT, terms.FRAMEWORKS)} AS "FrameworkPlattforms",
      {_match_sql(_TYPED_TEXT, terms.PROGRAMMING_LANGUAGES)} AS "JobLanguages", '' AS "Languages", '' AS "DesignPatterns",
      {_match_sql(_TYPED_TEXT, terms.KNOWLEDGE)} AS "Knowledges", 'software' AS "JobSummary",
      array_to_string(generate_series((p_size // 5) * 5, (least(p_size * 2, 100) // 5) * 5, 5), ';') AS "Salaries" FROM part""",
)
def feature_typed_records(spark, sf):
    p = table(spark, sf, "part").selectExpr(
        "CAST(p_partkey AS STRING) AS job_title", "p_brand AS company_name", "'Quận 1, Hồ Chí Minh' AS location",
        "p_size AS experience_years", "p_type AS job_type", "'Cử nhân' AS education_level",
        "concat('Java ', p_name) AS job_description", "array('Git', 'Docker') AS skills",
        "p_size * 1000000 AS salary_min", "p_size * 2000000 AS salary_max", "'VND' AS salary_currency",
        "'CNTT - Phần mềm' AS industry",
    )
    out = extract_typed_features(p).withColumn("JobName", F.col("JobName").cast("bigint"))
    return out.withColumns({c: joined(F.col(c)) for c, t in out.dtypes if t.startswith("array")})


# --- counts ----------------------------------------------------------------------------------------------------------

_DOC_TERMS = "(VALUES " + ", ".join(f"('{t}')" for t in terms.KNOWLEDGE) + ") AS v(term)"


@query(
    "knowledge_counts",
    f"SELECT term, count(*) AS count FROM documents, {_DOC_TERMS} WHERE contains(lower(text), lower(term)) GROUP BY term",
)
def knowledge_counts(spark, sf):
    docs = wide_table(spark, sf, "documents", "text")
    return aggregates.term_counts(docs, vocab.vocab_match("text", terms.KNOWLEDGE))


_POSTING_TERMS = (
    f"WITH {postings_cte('posting_id', 'description', 'skills')}, t AS (SELECT term FROM postings, {_DOC_TERMS} "
    f"WHERE contains(lower({_BOTH}), lower(term)))"
)


@query("knowledge_counts_postings", f"{_POSTING_TERMS} SELECT term, count(*) AS count FROM t GROUP BY term")
def knowledge_counts_postings(spark, sf):
    p = postings(spark, sf, "description", "skills")
    return aggregates.term_counts(p, vocab.extract_knowledge("description", "skills"))


@query(
    "knowledge_categories",
    f"{_POSTING_TERMS} SELECT category, count(*) AS count FROM t JOIN {fx.label_values()} USING (term) GROUP BY category",
)
def knowledge_categories(spark, sf):
    return aggregates.category_counts(knowledge_counts_postings(spark, sf))


@query(
    "job_type_counts",
    f"WITH {postings_cte('industry')}, t AS (SELECT unnest([CASE WHEN contains(lower(industry), 'cntt - phần mềm') THEN "
    "'software' END, CASE WHEN contains(lower(industry), 'cntt - phần cứng / mạng') THEN 'hardware' END]) AS job_type "
    "FROM postings) SELECT job_type, count(*) AS count FROM t WHERE job_type IS NOT NULL GROUP BY job_type",
)
def job_type_counts(spark, sf):
    p = postings(spark, sf, "industry")
    return aggregates.term_counts(p, vocab.extract_job_type("industry"), "job_type")


@query(
    "category_not_null",
    "SELECT event_type, count(*) AS n FROM (SELECT CASE event_type WHEN 'error' THEN 'null' WHEN 'view' THEN NULL "
    "ELSE event_type END AS event_type FROM events) WHERE event_type <> 'null' GROUP BY event_type",
)
def category_not_null(spark, sf):
    events = table(spark, sf, "events").selectExpr(
        "CASE event_type WHEN 'error' THEN 'null' WHEN 'view' THEN NULL ELSE event_type END AS event_type"
    )
    return aggregates.not_null_word(events, "event_type").groupBy("event_type").agg(F.count("*").alias("n"))


_NULL_COLUMNS = ["source", "title", "company", "location", "salary_text", "experience_text", "skills", "education"]


@query(
    "null_counts",
    f"WITH {postings_cte(*_NULL_COLUMNS)} "
    + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS nulls FROM postings" for c in _NULL_COLUMNS),
)
def null_counts(spark, sf):
    return aggregates.null_counts(postings(spark, sf, *_NULL_COLUMNS))


@query(
    "distinct_counts",
    "SELECT count(DISTINCT l_suppkey) AS unique_l_suppkey, count(DISTINCT l_partkey) AS unique_l_partkey FROM lineitem",
)
def distinct_counts(spark, sf):
    return aggregates.distinct_counts(table(spark, sf, "lineitem"), ["l_suppkey", "l_partkey"])


@query(
    "source_city_rollup",
    f"WITH {postings_cte('source', 'location')}, c AS (SELECT source, coalesce(list_filter({sql_list(CITIES)}, "
    "lambda x: contains(location, x))[1], trim(string_split(trim(location), ',')[1]), '') AS city FROM postings) "
    "SELECT coalesce(source, '*') AS source, coalesce(city, '*') AS city, count(*) AS records FROM c GROUP BY ROLLUP (source, city)",
)
def source_city_rollup(spark, sf):
    p = postings(spark, sf, "source", "location").select("source", vietnamese_city("location").alias("city"))
    counts = aggregates.source_counts(p, "city")
    return counts.select(F.coalesce("source", F.lit("*")).alias("source"), F.coalesce("city", F.lit("*")).alias("city"), "records")


@query(
    "chunk_totals",
    "SELECT source, count(*) AS rows, sum(n_chars) AS chars FROM documents GROUP BY source "
    "UNION ALL SELECT 'TOTAL', count(*), sum(n_chars) FROM documents",
)
def chunk_totals(spark, sf):
    """Rows per chunk and in all."""
    docs = table(spark, sf, "documents").select("source", "n_chars")
    totals = docs.rollup("source").agg(F.count("*").alias("rows"), F.sum("n_chars").alias("chars"))
    return totals.withColumn("source", F.coalesce("source", F.lit("TOTAL")))


@query(
    "top_titles",
    "SELECT p_name, count(*) AS count FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_name "
    "ORDER BY count DESC, p_name LIMIT 10",
)
def top_titles(spark, sf):
    """Top-k report over all lines; counted per key before the join."""
    lines = table(spark, sf, "lineitem").groupBy("l_partkey").agg(F.count("*").alias("n"))
    parts = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    counts = lines.join(parts, "l_partkey").groupBy("p_name").agg(F.sum("n").alias("count"))
    return counts.orderBy(F.desc("count"), "p_name").limit(10)


@query(
    "top_skills",
    "SELECT term, count(*) AS count FROM documents, (SELECT unnest(" + sql_list(terms.SKILLS) + ") AS term) "
    "WHERE contains(lower(text), term) GROUP BY term ORDER BY count DESC, term LIMIT 10",
)
def top_skills(spark, sf):
    """Top-k report."""
    return aggregates.term_counts(wide_table(spark, sf, "documents", "text"), vocab.extract_skills("text")).limit(10)


@query(
    "jobs_by_city",
    f"WITH {line_postings_cte('location')} SELECT coalesce(list_filter({sql_list(CITIES)}, lambda x: contains(location, x))[1], "
    "trim(string_split(trim(location), ',')[1]), '') AS city, count(*) AS records FROM postings GROUP BY 1",
)
def jobs_by_city(spark, sf):
    p = line_postings(spark, sf, "location").select(vietnamese_city("location").alias("city"))
    return p.groupBy("city").agg(F.count("*").alias("records"))


@query(
    "salary_bands",
    _bins_text_sql(
        line_postings_cte("salary_text"),
        ", u AS (SELECT unnest(l) AS band FROM postings JOIN f USING (salary_text)) "
        "SELECT band, count(*) AS count FROM u GROUP BY band",
    ),
)
def salary_bands(spark, sf):
    p = line_postings(spark, sf, "salary_text")
    return aggregates.salary_bands(p, salary.salary_bins_from_text("salary_text"))


@query(
    "salary_by_source",
    _salary_a_sql(
        postings_cte("posting_id", "source", "salary_text"),
        "SELECT source, count(*) AS count, round(avg((salary_min + salary_max) / 2), 2) AS mean, "
        "min((salary_min + salary_max) / 2) AS low, max((salary_min + salary_max) / 2) AS high FROM r "
        "WHERE salary_min IS NOT NULL GROUP BY source",
    ),
)
def salary_by_source(spark, sf):
    p = postings(spark, sf, "source", "salary_text").select("source", salary.salary_range_a("salary_text").alias("s"))
    p = p.select("source", salary.salary_average(F.col("s.min"), F.col("s.max")).alias("pay"))
    return aggregates.salary_by(p, "source", "pay").drop("median").withColumn("mean", F.round("mean", 2))


@query(
    "salary_median_by_source",
    _salary_a_sql(
        postings_cte("posting_id", "source", "salary_text"),
        "SELECT source, quantile_disc((salary_min + salary_max) / 2, 0.5) AS median FROM r "
        "WHERE salary_min IS NOT NULL GROUP BY source",
    ),
)
def salary_median_by_source(spark, sf):
    p = postings(spark, sf, "source", "salary_text").select("source", salary.salary_range_a("salary_text").alias("s"))
    p = p.select("source", salary.salary_average(F.col("s.min"), F.col("s.max")).alias("pay"))
    return aggregates.salary_by(p, "source", "pay").select("source", "median")


@query(
    "top_paying",
    _salary_a_sql(
        postings_cte("posting_id", "salary_text"),
        "SELECT posting_id, (salary_min + salary_max) / 2 AS pay FROM r WHERE salary_min IS NOT NULL "
        "ORDER BY pay DESC, posting_id LIMIT 10",
    ),
)
def top_paying(spark, sf):
    """Top-k report."""
    p = postings(spark, sf, "posting_id", "salary_text").select("posting_id", salary.salary_range_a("salary_text").alias("s"))
    p = p.select("posting_id", salary.salary_average(F.col("s.min"), F.col("s.max")).alias("pay"))
    return aggregates.top_paying(p, "pay", "posting_id")


@query(
    "experience_histogram",
    f"WITH {line_postings_cte('experience_text')}, t AS (SELECT lower(experience_text) AS t FROM postings), "
    f"y AS (SELECT CASE WHEN regexp_matches(t, 'không yêu cầu|không cần kinh nghiệm') THEN 0 {_VI} END AS years FROM t) "
    "SELECT coalesce(years, -1) AS years, count(*) AS count FROM y GROUP BY years",
)
def experience_histogram(spark, sf):
    p = line_postings(spark, sf, "experience_text").select(vietnamese_experience("experience_text").alias("years"))
    return p.groupBy("years").agg(F.count("*").alias("count")).withColumn("years", F.coalesce("years", F.lit(-1)))


@query(
    "deadline_trend",
    f"WITH {postings_cte('deadline')} SELECT strftime(d, '%Y-%m') AS month, count(*) AS count FROM "
    "(SELECT try_strptime(deadline, '%d/%m/%Y') AS d FROM postings) WHERE d IS NOT NULL GROUP BY month",
)
def deadline_trend(spark, sf):
    return aggregates.deadline_trend(postings(spark, sf, "deadline"), "deadline")


@query(
    "filtered_listing",
    f"WITH {postings_cte('posting_id', 'title', 'location', 'skills')} SELECT posting_id, title FROM postings "
    "WHERE contains(location, 'Hồ Chí Minh') AND contains(lower(skills), 'python')",
)
def filtered_listing(spark, sf):
    p = postings(spark, sf, "posting_id", "title", "location", "skills")
    hits = p.filter(F.contains("location", F.lit("Hồ Chí Minh")) & F.contains(F.lower("skills"), F.lit("python")))
    return hits.select("posting_id", "title")


# --- source profile, quality -------------------------------------------------------------------------------------------


@query(
    "source_profile",
    f"WITH {postings_cte()} "
    + " UNION ALL ".join(
        f"SELECT '{s}' AS source, '{c}' AS \"column\", count(*) AS rows, count(*) - count({e}) AS nulls, "
        f"coalesce(sum(length(CAST({e} AS VARCHAR))), 0) AS chars FROM postings WHERE source = '{s}'"
        for s, columns in RAW.items()
        for c, e in {"posting_id": "posting_id", **columns}.items()
    ),
)
def source_profile_query(spark, sf):
    return source_profile(raw_frames(spark, sf)).drop("type")


def _wide(spark, sf):
    cleaned = clean.clean_all(raw_frames(spark, sf))
    return {s: clean.standardize(df, wide=True) for s, df in cleaned.items()}


@query(
    "validation",
    """WITH o AS (SELECT CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END AS lo, 250000.0 AS hi,
      o_orderkey % 60 AS experience, nullif(o_orderpriority, '5-LOW') AS title FROM orders)
    SELECT 'salary_min_above_max' AS rule, 'error' AS severity, count(*) FILTER (WHERE lo > hi) AS records FROM o
    UNION ALL SELECT 'unrealistic_experience', 'warning', count(*) FILTER (WHERE experience > 50) FROM o
    UNION ALL SELECT 'missing_job_title_clean', 'warning', count(*) FILTER (WHERE title IS NULL) FROM o
    UNION ALL SELECT 'non_numeric_salary_min', 'error', count(*) FILTER (WHERE lo IS NULL) FROM o""",
)
def validation(spark, sf):
    rows = table(spark, sf, "orders").selectExpr(
        "CAST(CASE WHEN o_orderkey % 7 = 0 THEN 'unknown' ELSE CAST(o_totalprice AS STRING) END AS STRING) AS salary_min",
        "250000.0 AS salary_max",
        "o_orderkey % 60 AS experience",
        "nullif(o_orderpriority, '5-LOW') AS job_title_clean",
        "o_orderstatus AS company_name",
    )
    return quality.validate(rows)


def _summary_sql(source: str) -> str:
    nulls = " + ".join(f"count(*) - count({c})" for c in STANDARD_COLUMNS)
    missing_title = "CASE WHEN count(*) > count(job_title_clean) THEN 1 ELSE 0 END"
    missing_company = "CASE WHEN count(*) > count(company_name) THEN 1 ELSE 0 END"
    return f"""SELECT '{source}' AS source, count(*) AS original_rows, count(*) AS cleaned_rows, 0 AS rows_removed, 12 AS columns,
      {nulls} AS missing_cells, 0 AS errors, {missing_title} + {missing_company} AS warnings,
      round_even(greatest(0, (count(*) * 12 - ({nulls})) / (count(*) * 12) * 100 - 2 * ({missing_title} + {missing_company})), 2)
        AS quality_score,
      count(*) FILTER (WHERE trim(skills) <> '') AS records_with_skills,
      round_even(count(*) FILTER (WHERE trim(skills) <> '') / count(*) * 100, 2) AS skills_rate
      FROM standard WHERE source = '{source}'"""


@query("quality_summary", f"WITH {STANDARD_CTE} " + " UNION ALL ".join(_summary_sql(s) for s in _NEVER))
def quality_summary(spark, sf):
    raw = raw_frames(spark, sf)
    summary = quality.cleaning_summary(raw, clean.standardize_all(clean.clean_all(raw)))
    return summary.drop("records_with_experience", "experience_rate", "avg_experience")


_WIDE_EXPERIENCE = (
    "CASE WHEN source <> 'topcv' THEN CASE WHEN regexp_matches(lower(experience_text), 'không yêu cầu') THEN 0 "
    + _VI.replace("(t,", "(lower(experience_text),") + " END END"
)
# cells that are null for every row of a source: columns it never fills
_WIDE_NEVER = "CASE source WHEN 'careerlink' THEN 2 WHEN 'joboko' THEN 3 ELSE 5 END"


@query(
    "quality_summary_wide",
    _salary_a_sql(
        postings_cte(),
        f""", w AS (SELECT *, {_WIDE_EXPERIENCE} AS years FROM r),
    a AS (SELECT source, count(*) AS n, count(*) * any_value({_WIDE_NEVER}) + 4 * count(*) - count(salary_text) - count(salary_min)
        - count(salary_max) - count(years) + count(*) - count(CASE WHEN source <> 'topcv' THEN experience_text END) AS missing,
      CASE WHEN count(*) FILTER (WHERE salary_min > salary_max) > 0 THEN 1 ELSE 0 END
        + CASE WHEN count(*) > count(salary_min) THEN 1 ELSE 0 END AS errors,
      CASE WHEN count(*) FILTER (WHERE years > 50) > 0 THEN 1 ELSE 0 END AS warnings,
      count(*) FILTER (WHERE trim({_clean_sql('skills')}) <> '') AS skilled, count(years) AS experienced, avg(years) AS years
      FROM w GROUP BY source)
    SELECT source, n AS original_rows, n AS cleaned_rows, 0 AS rows_removed, 21 AS columns, missing AS missing_cells, errors, warnings,
      round_even(greatest(0, (n * 21 - missing) / (n * 21) * 100 - 5 * errors - 2 * warnings), 2) AS quality_score,
      skilled AS records_with_skills, round_even(skilled / n * 100, 2) AS skills_rate, experienced AS records_with_experience,
      round_even(experienced / n * 100, 2) AS experience_rate, round_even(years, 2) AS avg_experience FROM a""",
    ),
)
def quality_summary_wide(spark, sf):
    return quality.cleaning_summary(raw_frames(spark, sf), _wide(spark, sf))


# --- schema matching ---------------------------------------------------------------------------------------------------

_COLUMNS_SQL = "cols(source, position, name, expr) AS (VALUES " + ", ".join(
    f"('{s}', {i}, '{c}', '{e}')" for s, columns in RAW.items() for i, (c, e) in enumerate(columns.items())
) + ")"
_EXPECTED_SQL = "expected(source, field, name) AS (VALUES " + ", ".join(
    f"('{s}', '{f}', '{n}')" for s, fields in schema_match.EXPECTED.items() for f, n in fields.items()
) + ")"
_MAPPING_SQL = f"""{_COLUMNS_SQL}, {_EXPECTED_SQL},
  p AS (SELECT c.source, field, position, c.name AS "column", expr, c.name = e.name AS exact, lower(c.name) AS a, lower(e.name) AS b
    FROM cols c JOIN expected e USING (source)), {lcs_sql('p')},
  mapped AS (SELECT source, field, "column", expr, round(ratio, 9) AS score FROM p JOIN ratios USING (a, b) WHERE exact OR ratio > 0.8
    QUALIFY row_number() OVER (PARTITION BY source, field ORDER BY exact DESC, ratio DESC, position) = 1)"""
_FILLED_SQL = "filled AS (" + " UNION ALL ".join(
    f"SELECT '{s}' AS source, '{c}' AS \"column\", count({e}) AS filled FROM postings WHERE source = '{s}'"
    for s, columns in RAW.items() for c, e in columns.items()
) + ")"


def _analysis(spark, sf):
    frames = {s: df.drop("posting_id") for s, df in raw_frames(spark, sf).items()}
    return frames, schema_match.analyze(frames)


@query(
    "schema_mapping",
    f"WITH RECURSIVE {postings_cte()}, {_MAPPING_SQL}, {_FILLED_SQL} "
    'SELECT source, field, "column", score, filled FROM mapped JOIN filled USING (source, "column")',
)
def schema_mapping(spark, sf):
    """Column of each standard field per source, with the number of values it holds."""
    frames, result = _analysis(spark, sf)
    profile = source_profile(frames)
    filled = profile.select("source", "column", (F.col("rows") - F.col("nulls")).alias("filled"))
    mapped = result["mapping"].join(filled, ["source", "column"])
    return mapped.select("source", "field", "column", F.round("score", 9).alias("score"), "filled")


@query(
    "schema_compatibility",
    f"WITH RECURSIVE {postings_cte()}, {_MAPPING_SQL}, {_FILLED_SQL}, n AS (SELECT count(DISTINCT source) AS n FROM postings) "
    "SELECT field, array_to_string(list_sort(list(source)), ';') AS sources, count(*) / any_value(n) AS coverage, "
    "count(*) = any_value(n) AS is_common, count(*) / any_value(n) >= 0.5 AS is_compatible, 'string' AS most_common_type, "
    "1.0 AS consistency_score, sum(filled) AS filled FROM mapped JOIN filled USING (source, \"column\"), n GROUP BY field",
)
def schema_compatibility(spark, sf):
    """Agreement of the sources per standard field, with the number of values they hold."""
    frames, result = _analysis(spark, sf)
    profile = source_profile(frames)
    filled = profile.select("source", "column", (F.col("rows") - F.col("nulls")).alias("filled"))
    values = result["mapping"].join(filled, ["source", "column"]).groupBy("field").agg(F.sum("filled").alias("filled"))
    fields = result["fields"].join(values, "field")
    return fields.withColumn("sources", joined(F.col("sources"))).drop("all_types")


@query(
    "schema_standard",
    f"WITH RECURSIVE {postings_cte()}, {_MAPPING_SQL}, {_FILLED_SQL}, n AS (SELECT count(DISTINCT source) AS n FROM postings), "
    "f AS (SELECT unnest([" + ", ".join(f"'{f}'" for f in schema_match.STANDARD_FIELDS) + "]) AS field) "
    "SELECT f.field, CASE f.field WHEN 'experience' THEN 'numeric' ELSE 'string' END AS declared_type, "
    "coalesce(array_to_string(list_sort(list(source) FILTER (WHERE source IS NOT NULL)), ';'), '') AS sources, "
    "count(source) / any_value(n) AS coverage_rate, count(source) = any_value(n) AS is_common, coalesce(sum(filled), 0) AS filled "
    "FROM f CROSS JOIN n LEFT JOIN mapped USING (field) LEFT JOIN filled USING (source, \"column\") GROUP BY f.field",
)
def schema_standard(spark, sf):
    """Every standard field with its declared type, the sources that have it, and the values they hold."""
    frames, result = _analysis(spark, sf)
    profile = source_profile(frames)
    filled = profile.select("source", "column", (F.col("rows") - F.col("nulls")).alias("filled"))
    values = result["mapping"].join(filled, ["source", "column"]).groupBy("field").agg(F.sum("filled").alias("filled"))
    fields = result["standard"].join(values, "field", "left").na.fill(0, ["filled"])
    return fields.withColumn("sources", joined(F.col("sources")))


@query("overall_quality")
def overall_quality(spark, sf):
    """Source scores, schema score and matching score of the three raw sources in one number."""
    raw = raw_frames(spark, sf)
    result = jobs.analyze(raw, clean.clean_all(raw), ["posting_id"])
    return one_row(result.overall, result.schema["overall"], result.matching.report.drop("recommendations"))
