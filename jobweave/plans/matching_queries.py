"""Queries for duplicates, merging and fuzzy matching."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.experience import experience_list
from ..functions.similarity import ratio
from ..operators import dedup, entities, matching, ranking
from ..operators.entities import record_similarity
from ..sources.readers import FILE, POSITION
from .derive import postings, postings_cte
from .features import _accents_sql, _clean_sql, _expand_sql, _norm_sql, _NUMBERS, _signature_sql
from ..functions.html import reported_total
from .registry import ORACLES, joined, query, table

KEYS = ["job_title_clean", "company_name", "location_clean"]
_KEYED_SQL = (
    "keyed AS (SELECT p_partkey AS posting_id, p_name AS job_title_clean, "
    "CASE p_partkey % 6 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE p_brand END AS company_name, p_type AS location_clean FROM part)"
)


def _keyed(spark, sf):
    return table(spark, sf, "part").selectExpr(
        "p_partkey AS posting_id",
        "p_name AS job_title_clean",
        "CASE p_partkey % 6 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE p_brand END AS company_name",
        "p_type AS location_clean",
    )


# --- exact duplicates -----------------------------------------------------------------------------------------------

_DUPLICATES = f"""{_KEYED_SQL}, g AS (SELECT job_title_clean, company_name, location_clean, count(*) AS n FROM keyed
    WHERE company_name IS NOT NULL GROUP BY ALL HAVING count(*) > 1),
  r AS (SELECT *, dense_rank() OVER (ORDER BY job_title_clean, company_name, location_clean) - 1 AS duplicate_group FROM g)"""


@query(
    "duplicates_flagged",
    f"WITH {_DUPLICATES} SELECT posting_id, r.n IS NOT NULL AS is_duplicate, duplicate_group FROM keyed LEFT JOIN r "
    "USING (job_title_clean, company_name, location_clean)",
)
def duplicates_flagged(spark, sf):
    return dedup.find_duplicates(_keyed(spark, sf), KEYS).select("posting_id", "is_duplicate", "duplicate_group")


@query(
    "duplicate_group_sizes",
    "WITH d AS (SELECT md5(" + _clean_sql("text") + ") AS cleaned, doc_id FROM documents) "
    "SELECT cleaned, count(*) AS group_size, dense_rank() OVER (ORDER BY cleaned) - 1 AS duplicate_group "
    "FROM d GROUP BY cleaned HAVING count(*) > 1",
)
def duplicate_group_sizes(spark, sf):
    from ..functions.text import clean_text

    docs = table(spark, sf, "documents").select("doc_id", F.md5(clean_text("text")).alias("cleaned"))
    return dedup.duplicate_groups(docs, ["cleaned"])


@query(
    "duplicate_report",
    f"WITH {_DUPLICATES}, f AS (SELECT duplicate_group AS g FROM keyed LEFT JOIN r USING (job_title_clean, company_name, "
    "location_clean)) SELECT count(*) AS total_records, count(g) AS duplicate_count, count(g) / count(*) AS duplicate_rate, "
    "count(DISTINCT g) AS duplicate_groups FROM f",
)
def duplicate_report(spark, sf):
    return matching.duplicate_report(dedup.duplicate_groups(_keyed(spark, sf), KEYS), _keyed(spark, sf))


# --- keep-first, chunk merge, renumbering -----------------------------------------------------------------------------


@query(
    "keep_first_link",
    f"WITH {postings_cte('posting_id', 'link', 'title')}, k AS (SELECT *, row_number() OVER (PARTITION BY link "
    "ORDER BY posting_id) AS rn FROM postings) SELECT posting_id, link, title FROM k WHERE rn = 1",
)
def keep_first_link(spark, sf):
    return ranking.keep_first(postings(spark, sf, "posting_id", "link", "title"), ["link"], ["posting_id"])


# two letters in their decomposed spelling, on every second posting
_DECOMPOSED = "CASE WHEN posting_id % 2 = 0 THEN replace(replace({c}, 'ô', 'o\u0302'), 'à', 'a\u0300') ELSE {c} END"


def chunk_rows(rows):
    """Postings as records of seven chunk files, one in three without a link."""
    return rows.selectExpr(
        "posting_id",
        f"posting_id % 7 AS {FILE}",
        f"posting_id AS {POSITION}",
        "CASE WHEN posting_id % 3 = 0 THEN '' ELSE link END AS `Liên_kết`",
        "title AS `tên công việc`",
        f"{_DECOMPOSED.format(c='company')} AS `công ty`",
        f"{_DECOMPOSED.format(c='location')} AS `địa điểm làm việc`",
    )


@query(
    "chunk_merge",
    f"""WITH {postings_cte('posting_id', 'title', 'company', 'location', 'link', 'industry')},
    c AS (SELECT posting_id, posting_id % 7 AS file, posting_id AS pos,
      CASE WHEN posting_id % 3 = 0 THEN '' ELSE link END AS link, title, nfc_normalize({_DECOMPOSED.format(c='company')}) AS company,
      nfc_normalize({_DECOMPOSED.format(c='location')}) AS location FROM postings),
    k AS (SELECT *, coalesce(nullif(link, ''), '_fallback_' || lower({_norm_sql('title')}) || '__' ||
      lower({_norm_sql('company')}) || '__' || lower({_norm_sql('location')})) AS k FROM c),
    f AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY file, pos) AS rn FROM k)
    SELECT posting_id, link, row_number() OVER (ORDER BY file, pos) AS stt FROM f WHERE rn = 1""",
)
def chunk_merge(spark, sf):
    chunks = chunk_rows(postings(spark, sf, "posting_id", "title", "company", "location", "link"))
    merged = dedup.merge_chunks(chunks, number="stt")
    return merged.select("posting_id", F.col("`Liên_kết`").alias("link"), "stt")


@query(
    "renumber_orders",
    "SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS stt FROM orders",
)
def renumber_orders(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return ranking.renumber(orders, F.desc("o_totalprice"), "o_orderkey").select("o_orderkey", "stt")


@query(
    "suppress_seen",
    "WITH b AS (SELECT count(*) / 20 AS n FROM events) "
    "SELECT event_type, min(event_id) AS event_id, user_id FROM events, b WHERE event_id >= n AND user_id NOT IN "
    "(SELECT user_id FROM events, b WHERE event_id < n AND user_id IS NOT NULL) GROUP BY user_id, event_type "
    "QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY min(event_id)) = 1",
)
def suppress_seen(spark, sf):
    """Incremental load: keep only users the earlier events did not bring."""
    events = table(spark, sf, "events").select("event_type", "event_id", "user_id")
    loaded = F.broadcast(events.agg((F.count("*") / 20).alias("n")))  # one row
    placed = events.crossJoin(loaded)
    seen, new = placed.filter("event_id < n").drop("n"), placed.filter("event_id >= n").drop("n")
    return dedup.suppress_seen(new, seen, "user_id", ["event_id"])


@query(
    "page_streaks",
    "WITH p AS (SELECT user_id AS site, event_id AS page, CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS news FROM events), "
    "n AS (SELECT *, row_number() OVER (PARTITION BY site ORDER BY page) AS n FROM p), "
    "s AS (SELECT site, page, n - coalesce(max(CASE WHEN news > 0 THEN n END) OVER (PARTITION BY site ORDER BY page), 0) "
    "AS streak FROM n) SELECT site, page, streak, streak > 10 AS stops FROM s",
)
def page_streaks(spark, sf):
    events = table(spark, sf, "events").selectExpr(
        "user_id AS site", "event_id AS page", "CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS news"
    )
    return ranking.page_streaks(events, "site", "page", "news").select("site", "page", "streak", "stops")


@query(
    "crawl_progress",
    "WITH l AS (SELECT event_type AS site, event_id // 16 AS page, user_id AS link FROM events), "
    "p AS (SELECT site, page, page % 9 + 2 * length(site) AS reported FROM l GROUP BY ALL), "
    "f AS (SELECT site, link, min(page) AS page FROM l WHERE link IS NOT NULL GROUP BY ALL), "
    "n AS (SELECT site, page, count(*) AS new_count FROM f GROUP BY ALL), "
    "c AS (SELECT site, page, coalesce(new_count, 0) AS new_count, row_number() OVER w AS k, "
    "CAST(sum(coalesce(new_count, 0)) OVER w AS BIGINT) AS found, first(reported) OVER w AS total FROM p LEFT JOIN n USING (site, page) "
    "WINDOW w AS (PARTITION BY site ORDER BY page)), "
    "s AS (SELECT *, k - coalesce(max(CASE WHEN new_count > 0 THEN k END) OVER (PARTITION BY site ORDER BY page), 0) AS streak FROM c) "
    "SELECT site, page, new_count, streak, found, total, streak > 10 OR (total > 0 AND found >= total) AS stops FROM s",
)
def crawl_progress(spark, sf):
    """Event types as sites, users as links: where a crawl ends, by silence or by the total that it was told."""
    links = table(spark, sf, "events").selectExpr("event_type AS site", "event_id DIV 16 AS page", "user_id AS link")
    told = F.concat(F.lit("<p>("), (F.col("page") % 9 + 2 * F.length("site")).cast("string"), F.lit(" việc)</p>"))
    pages = links.select("site", "page").distinct().withColumn("reported", reported_total(told))
    return ranking.crawl_progress(pages, links, "site", "page", "link", "reported").drop("reported")


@query(
    "sample_seeded",
    "SELECT o_orderkey, o_custkey FROM orders ORDER BY md5(concat(CAST(o_orderkey AS VARCHAR), ':42')), o_orderkey LIMIT 500",
)
def sample_seeded(spark, sf):
    """Sampling operator: 500 rows chosen by a seeded hash."""
    return ranking.sample_rows(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), "o_orderkey")


@query("head_rows", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 1000")
def head_rows(spark, sf):
    """First rows operator."""
    return ranking.head_rows(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey")


@query(
    "sample_values",
    f"""WITH {postings_cte('posting_id', 'company', 'salary_text', 'skills')}, u AS (
      SELECT 'company' AS "column", posting_id AS row_id, company AS value FROM postings
      UNION ALL SELECT 'salary_text', posting_id, salary_text FROM postings
      UNION ALL SELECT 'skills', posting_id, skills FROM postings)
    SELECT * FROM u WHERE value IS NOT NULL QUALIFY row_number() OVER (PARTITION BY "column" ORDER BY row_id) <= 3""",
)
def sample_values(spark, sf):
    p = postings(spark, sf, "posting_id", "company", "salary_text", "skills")
    parts = [ranking.sample_values(p, c, "posting_id") for c in ("company", "salary_text", "skills")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# --- block and merge ---------------------------------------------------------------------------------------------------

_KEEP = ["title", "company", "location", "salary_text", "experience_text", "description", "skills"]


def _longest_sql(col: str) -> str:
    return f"max({{'n': length(coalesce({col}, '')), 'v': coalesce({col}, '')}}).v AS {col}"


@query(
    "block_merge",
    f"""WITH {postings_cte('posting_id', *_KEEP)}, k AS (SELECT *, sha256({_accents_sql('location')} || '|' ||
      {_signature_sql('title')} || '|' || {_signature_sql('company')}) AS block_key, {_NUMBERS} AS n FROM postings),
    m AS (SELECT block_key, count(*) AS block_size, {', '.join(_longest_sql(c) for c in _KEEP)} FROM k GROUP BY block_key),
    y AS (SELECT block_key, list_sort(list(DISTINCT year)) AS years FROM
      (SELECT block_key, unnest({_expand_sql(1, 10)}) AS year FROM k) GROUP BY block_key)
    SELECT block_key, block_size, title, company, location, salary_text, description, skills,
      CASE WHEN trim(experience_text) = '' THEN CASE WHEN list_min(years) = list_max(years) THEN list_min(years) || ' năm'
        ELSE list_min(years) || ' - ' || list_max(years) || ' năm' END ELSE experience_text END AS experience_text,
      array_to_string(years, ';') AS years,
      row_number() OVER (ORDER BY title NULLS LAST, block_key) AS stt FROM m LEFT JOIN y USING (block_key)""",
)
def block_merge(spark, sf):
    merged = dedup.block_and_merge(
        postings(spark, sf, "posting_id", *_KEEP), "title", "company", "location", "experience_text", _KEEP
    )
    return merged.withColumn("years", joined(F.col("experience_years"))).drop("experience_years")


@query(
    "merged_experience",
    f"""WITH {postings_cte('location', 'experience_text')}, n AS (SELECT location, {_NUMBERS} AS n FROM postings),
    y AS (SELECT location, unnest({_expand_sql(1, 10)}) AS year FROM n)
    SELECT coalesce(location, '?') AS location, array_to_string(list_sort(list(DISTINCT year)), ';') AS years FROM y GROUP BY location""",
)
def merged_experience(spark, sf):
    p = postings(spark, sf, "location", "experience_text")
    years = p.select("location", F.explode(experience_list("experience_text")).alias("year")).distinct()
    gathered = years.groupBy("location").agg(joined(F.array_sort(F.collect_list("year"))).alias("years"))
    return gathered.select(F.coalesce("location", F.lit("?")).alias("location"), "years")


# --- similarity ----------------------------------------------------------------------------------------------------------


def lcs_sql(pairs: str) -> str:
    """CTEs giving the ratio of each row ``a, b`` of ``pairs``: a dynamic program over the letters of ``a``."""
    return f"""chars AS (SELECT DISTINCT a, b, string_split(a, '') AS ca, string_split(b, '') AS cb FROM {pairs}),
    dp(a, b, ca, cb, i, r) AS (
      SELECT a, b, ca, cb, 0, list_transform(generate_series(0, length(b)), lambda x: 0) FROM chars
      UNION ALL
      SELECT a, b, ca, cb, i + 1, list_reduce(list_transform(generate_series(1, length(b)), lambda j: [j]),
        lambda acc, j: list_append(acc, CASE WHEN cb[j[1]] = ca[i + 1] THEN CAST(r[j[1]] AS BIGINT) + 1
          ELSE greatest(r[j[1] + 1], acc[len(acc)]) END), [CAST(0 AS BIGINT)])
      FROM dp WHERE i < length(a)),
    ratios AS (SELECT a, b, 1 - (length(a) + length(b) - 2 * r[len(r)]) / (length(a) + length(b)) AS ratio FROM dp
      WHERE i = length(a))"""


@query(
    "text_ratio",
    f"""WITH RECURSIVE p AS (SELECT p_partkey, lower(p_name) AS a, lower(p_type || ' ' || p_brand) AS b FROM part),
    {lcs_sql('p')} SELECT p_partkey, ratio FROM p JOIN ratios USING (a, b)""",
)
def text_ratio(spark, sf):
    p = table(spark, sf, "part")
    return p.select("p_partkey", ratio(F.lower("p_name"), F.lower(F.concat_ws(" ", "p_type", "p_brand"))).alias("ratio"))


@query(
    "record_similarity",
    f"""WITH RECURSIVE {_KEYED_SQL}, p AS (SELECT l.posting_id, unnest([
        {{'a': lower(l.job_title_clean), 'b': lower(r.job_title_clean)}},
        {{'a': lower(l.company_name), 'b': lower(r.company_name)}},
        {{'a': lower(l.location_clean), 'b': lower(r.location_clean)}}]) AS f
      FROM keyed l JOIN keyed r ON r.posting_id = l.posting_id + 1),
    q AS (SELECT posting_id, f.a AS a, f.b AS b FROM p WHERE f.a <> '' AND f.b <> ''), {lcs_sql('q')},
    m AS (SELECT posting_id, list(ratio) AS rs FROM q JOIN ratios USING (a, b) GROUP BY posting_id)
    SELECT l.posting_id, round(coalesce(list_avg(rs), 0), 9) AS similarity
    FROM keyed l JOIN keyed r ON r.posting_id = l.posting_id + 1 LEFT JOIN m ON m.posting_id = l.posting_id""",
)
def record_similarity_query(spark, sf):
    """Each posting against the next one."""
    fields = [F.coalesce(F.col(k), F.lit("")).alias(k) for k in KEYS]
    rows = _keyed(spark, sf).select("posting_id", F.struct(*fields).alias("l"))
    following = rows.select((F.col("posting_id") - 1).alias("posting_id"), F.col("l").alias("r"))
    pairs = rows.join(following, "posting_id")
    return pairs.select(
        "posting_id", F.round(record_similarity(F.col("l"), F.col("r"), KEYS), 9).alias("similarity")
    )


def _greedy_sql(names: str) -> str:
    """The sequential rule itself: walk the names in order, carrying the list of leaders."""
    return f"""WITH RECURSIVE names AS ({names}), ranked AS (SELECT name, id, row_number() OVER (ORDER BY id) AS i FROM names),
    pairs AS (SELECT lower(trim(l.name)) AS a, lower(e.name) AS b, l.i AS li, e.i AS ei FROM ranked l JOIN ranked e
      ON e.i < l.i AND 2 * least(length(l.name), length(e.name)) >= 0.8 * (length(l.name) + length(e.name)) - 2
      AND levenshtein(lower(trim(l.name)), lower(e.name)) <= 0.2 * (length(l.name) + length(e.name)) + 1),
    {lcs_sql('pairs')},
    near AS (SELECT li, ei, ratio FROM pairs JOIN ratios USING (a, b) WHERE ratio >= 0.8),
    seen AS (SELECT i, list(ei) FILTER (WHERE ei IS NOT NULL) AS es FROM ranked LEFT JOIN near ON near.li = i GROUP BY i),
    walk(i, leaders) AS (SELECT CAST(0 AS BIGINT), CAST([] AS BIGINT[]) UNION ALL
      SELECT s.i, CASE WHEN list_has_any(leaders, coalesce(s.es, [])) THEN leaders ELSE list_append(leaders, s.i) END
      FROM walk JOIN seen s ON s.i = walk.i + 1),
    leaders AS (SELECT unnest(leaders) AS i FROM walk WHERE i = (SELECT count(*) FROM ranked)),
    best AS (SELECT li, arg_min(ei, (-ratio) * 1e6 + ei / 1e6) AS ei FROM near WHERE ei IN (SELECT i FROM leaders)
      AND li NOT IN (SELECT i FROM leaders) GROUP BY li)
    SELECT r.name, coalesce(c.name, r.name) AS canonical FROM ranked r LEFT JOIN best ON best.li = r.i
    LEFT JOIN ranked c ON c.i = best.ei"""


@query(
    "entity_titles",
    _greedy_sql("SELECT p_name AS name, min(p_partkey) AS id FROM part GROUP BY p_name"),
)
def entity_titles(spark, sf):
    mapping = entities.entity_mapping(table(spark, sf, "part"), "p_name", "p_partkey")
    return mapping.select("name", "canonical")


@query(
    "entity_companies",
    _greedy_sql("SELECT s_name AS name, min(s_suppkey) AS id FROM supplier GROUP BY s_name"),
)
def entity_companies(spark, sf):
    mapping = entities.entity_mapping(table(spark, sf, "supplier"), "s_name", "s_suppkey")
    return mapping.select("name", "canonical")


_TWO_AGREE = " OR ".join(
    f"(x.f{a} <> '' AND x.f{a} = y.f{a} AND x.f{b} <> '' AND x.f{b} = y.f{b})" for a, b in (("t", "c"), ("t", "l"), ("c", "l"))
)


@query(
    "similar_records_blocked",
    f"""WITH RECURSIVE {postings_cte('posting_id', 'title', 'company', 'location')},
    records AS (SELECT t, c, l, min(posting_id) AS id, count(*) AS copies FROM
      (SELECT posting_id, lower(coalesce(title, '')) AS t, lower(coalesce(company, '')) AS c, lower(coalesce(location, '')) AS l
       FROM postings) GROUP BY t, c, l),
    ranked AS (SELECT *, row_number() OVER (ORDER BY id) AS i, {_accents_sql('t')} AS ft, {_accents_sql('c')} AS fc,
      {_accents_sql('l')} AS fl FROM records),
    cand AS (SELECT x.i AS ei, y.i AS li, x.t AS xt, y.t AS yt, x.c AS xc, y.c AS yc, x.l AS xl, y.l AS yl
      FROM ranked x JOIN ranked y ON x.i < y.i AND ({_TWO_AGREE})),
    q AS (SELECT DISTINCT a, b FROM (SELECT xt AS a, yt AS b FROM cand UNION ALL SELECT xc, yc FROM cand UNION ALL SELECT xl, yl FROM cand)
      WHERE a <> '' AND b <> ''), {lcs_sql('q')},
    near AS (SELECT li, ei, (coalesce(rt.ratio, 0) + coalesce(rc.ratio, 0) + coalesce(rl.ratio, 0)) /
        nullif((rt.ratio IS NOT NULL)::INT + (rc.ratio IS NOT NULL)::INT + (rl.ratio IS NOT NULL)::INT, 0) AS score
      FROM cand LEFT JOIN ratios rt ON rt.a = xt AND rt.b = yt LEFT JOIN ratios rc ON rc.a = xc AND rc.b = yc
      LEFT JOIN ratios rl ON rl.a = xl AND rl.b = yl),
    close AS (SELECT * FROM near WHERE score >= 0.8),
    seen AS (SELECT i, list(ei) FILTER (WHERE ei IS NOT NULL) AS es FROM ranked LEFT JOIN close ON close.li = i GROUP BY i),
    walk(i, leaders) AS (SELECT CAST(0 AS BIGINT), CAST([] AS BIGINT[]) UNION ALL
      SELECT s.i, CASE WHEN list_has_any(leaders, coalesce(s.es, [])) THEN leaders ELSE list_append(leaders, s.i) END
      FROM walk JOIN seen s ON s.i = walk.i + 1),
    leaders AS (SELECT unnest(leaders) AS i FROM walk WHERE i = (SELECT count(*) FROM ranked)),
    chosen AS (SELECT li, min(ei) AS ei, arg_min(score, ei) AS score FROM close WHERE ei IN (SELECT i FROM leaders)
      AND li NOT IN (SELECT i FROM leaders) GROUP BY li)
    SELECT r.id, coalesce(x.id, r.id) AS leader, round(coalesce(chosen.score, 1), 9) AS score, r.copies FROM ranked r
    LEFT JOIN chosen ON chosen.li = r.i LEFT JOIN ranked x ON x.i = chosen.ei""",
)
def similar_records_blocked(spark, sf):
    """A rule of its own: records are similar if two fields agree up to accents and the mean ratio reaches 0.8."""
    p = postings(spark, sf, "posting_id", "title", "company", "location")
    fields = ["title", "company", "location"]
    groups = entities.similar_records(p, "posting_id", fields, agreeing=2)
    return groups.select("id", "leader", F.round("score", 9).alias("score"), "copies")


def _field_ratio_sql(name: str, field: str) -> str:
    """CTEs ``{name}`` holding the ratio of any two distinct values of a field."""
    pairs = f"{name}_pairs"
    chain = lcs_sql(pairs).replace("chars AS", f"{name}_chars AS").replace("FROM chars", f"FROM {name}_chars")
    chain = chain.replace("dp(", f"{name}_dp(").replace("FROM dp", f"FROM {name}_dp").replace("ratios AS", f"{name} AS")
    return f"""{pairs} AS (SELECT DISTINCT l.v AS a, r.v AS b FROM (SELECT DISTINCT {field} AS v FROM records WHERE {field} <> '') l,
      (SELECT DISTINCT {field} AS v FROM records WHERE {field} <> '') r), {chain}"""


@query(
    "similar_records",
    f"""WITH RECURSIVE {_KEYED_SQL}, records AS (SELECT t, c, l, min(posting_id) AS id, count(*) AS copies FROM
      (SELECT posting_id, lower(coalesce(job_title_clean, '')) AS t, lower(coalesce(company_name, '')) AS c,
        lower(coalesce(location_clean, '')) AS l FROM keyed) GROUP BY t, c, l),
    ranked AS (SELECT *, row_number() OVER (ORDER BY id) AS i FROM records),
    {_field_ratio_sql('rt', 't')}, {_field_ratio_sql('rc', 'c')}, {_field_ratio_sql('rl', 'l')},
    near AS (SELECT y.i AS li, x.i AS ei, (coalesce(rt.ratio, 0) + coalesce(rc.ratio, 0) + coalesce(rl.ratio, 0)) /
        nullif((rt.ratio IS NOT NULL)::INT + (rc.ratio IS NOT NULL)::INT + (rl.ratio IS NOT NULL)::INT, 0) AS score
      FROM ranked x JOIN ranked y ON x.i < y.i LEFT JOIN rt ON rt.a = x.t AND rt.b = y.t
      LEFT JOIN rc ON rc.a = x.c AND rc.b = y.c LEFT JOIN rl ON rl.a = x.l AND rl.b = y.l),
    close AS (SELECT * FROM near WHERE score >= 0.8),
    seen AS (SELECT i, list(ei) FILTER (WHERE ei IS NOT NULL) AS es FROM ranked LEFT JOIN close ON close.li = i GROUP BY i),
    walk(i, leaders) AS (SELECT CAST(0 AS BIGINT), CAST([] AS BIGINT[]) UNION ALL
      SELECT s.i, CASE WHEN list_has_any(leaders, coalesce(s.es, [])) THEN leaders ELSE list_append(leaders, s.i) END
      FROM walk JOIN seen s ON s.i = walk.i + 1),
    leaders AS (SELECT unnest(leaders) AS i FROM walk WHERE i = (SELECT count(*) FROM ranked)),
    chosen AS (SELECT li, min(ei) AS ei, arg_min(score, ei) AS score FROM close WHERE ei IN (SELECT i FROM leaders)
      AND li NOT IN (SELECT i FROM leaders) GROUP BY li)
    SELECT r.id, coalesce(x.id, r.id) AS leader, round(coalesce(chosen.score, 1), 9) AS score, r.copies FROM ranked r
    LEFT JOIN chosen ON chosen.li = r.i LEFT JOIN ranked x ON x.i = chosen.ei""",
)
def similar_records(spark, sf):
    groups = entities.similar_records(_keyed(spark, sf), "posting_id", KEYS)
    return groups.select("id", "leader", F.round("score", 9).alias("score"), "copies")


_LONG = "lower(p_name || ' ' || p_type || ' ' || p_brand)"


@query("entity_long_titles", _greedy_sql(f"SELECT {_LONG} AS name, min(p_partkey) AS id FROM part GROUP BY name"))
def entity_long_titles(spark, sf):
    """Nearly as many distinct titles as rows, built from few words."""
    rows = table(spark, sf, "part").selectExpr("p_partkey", "lower(concat(p_name, ' ', p_type, ' ', p_brand)) AS title")
    return entities.entity_mapping(rows, "title", "p_partkey").select("name", "canonical")


_TITLES = "SELECT p_name AS name, min(p_partkey) AS id FROM part GROUP BY p_name"
_COMPANIES = (
    "SELECT name, min(p_partkey) AS id FROM (SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN '' WHEN 1 THEN NULL "
    "ELSE p_brand END AS name FROM part) WHERE name IS NOT NULL GROUP BY name"
)


def _entity_sql(kind: str, names: str) -> str:
    return (
        f"SELECT '{kind}' AS entity, count(*) AS total, count(*) AS mapped, count(*) FILTER (WHERE name = canonical) "
        f"AS canonical FROM ({_greedy_sql(names)})"
    )


@query("entity_statistics", f"{_entity_sql('company', _COMPANIES)} UNION ALL {_entity_sql('job_title', _TITLES)}")
def entity_statistics(spark, sf):
    _, statistics = entities.resolve_entities(_keyed(spark, sf), "posting_id")
    return statistics


@query(
    "matching_report",
    f"""SELECT d.*, s.*, c.total AS total_companies, t.total AS total_job_titles, c.mapped AS unique_companies,
      t.mapped AS unique_job_titles, c.canonical AS canonical_companies, t.canonical AS canonical_job_titles,
      similar_records / total_records AS similarity_rate,
      concat_ws(' ', CASE WHEN duplicate_rate > 0.1 THEN '{matching.ADVICE_DUPLICATES}' END,
        CASE WHEN similar_records / total_records > 0.2 THEN '{matching.ADVICE_SIMILARITY}' END) AS recommendations
    FROM ({ORACLES['duplicate_report']}) d, ({_entity_sql('c', _COMPANIES)}) c, ({_entity_sql('t', _TITLES)}) t,
      (SELECT count(*) FILTER (WHERE n > 1) AS similar_groups, sum(n) FILTER (WHERE n > 1) AS similar_records,
        sum(n) AS compared_records FROM (SELECT leader, sum(copies) AS n FROM ({ORACLES['similar_records']}) GROUP BY leader)) s""",
)
def matching_report(spark, sf):
    return matching.matching_report(_keyed(spark, sf), "posting_id").report
