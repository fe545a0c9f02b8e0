"""Queries for the scalar and array functions."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from ..functions import experience, location, salary, schedule, terms, text, vocab
from ..operators.aggregates import with_salary
from ..session import compute_once
from .derive import line_postings, line_postings_cte, postings, postings_cte
from .registry import joined, query, sql_list, table, wide_table

_SP = r"[\s\x0B\x1C-\x1F\x{85}\p{Z}]"
_W = r"\p{L}\p{N}_"


def _clean_sql(col: str) -> str:
    return (
        f"regexp_replace(regexp_replace(regexp_replace(coalesce({col}, ''), '^{_SP}+|{_SP}+$', '', 'g'), "
        f"'{_SP}+', ' ', 'g'), '[^{_W}\\s\\p{{Z}}\\-.,()&/]', '', 'g')"
    )


def _norm_sql(col: str) -> str:
    return f"trim(regexp_replace(coalesce({col}, ''), '{_SP}+', ' ', 'g'))"


def _accents_sql(col: str) -> str:
    return f"trim(regexp_replace(regexp_replace(strip_accents(lower(coalesce({col}, ''))), '[^a-z0-9]', ' ', 'g'), ' +', ' ', 'g'))"


def _signature_sql(col: str) -> str:
    stop = sql_list(text.COMPANY_STOP_WORDS)
    return (
        f"array_to_string(list_sort(list_distinct(list_filter(string_split({_accents_sql(col)}, ' '), "
        f"lambda x: x <> '' AND NOT list_contains({stop}, x)))), ' ')"
    )


# --- text ---------------------------------------------------------------------------------------------------------


@query(
    "text_clean",
    f"SELECT doc_id, md5({_clean_sql('text')}) AS cleaned, length({_clean_sql('text')}) AS n_clean FROM documents",
)
def text_clean(spark, sf):
    docs = wide_table(spark, sf, "documents", "doc_id", "text")
    return docs.select("doc_id", text.clean_text("text").alias("c")).select(
        "doc_id", F.md5("c").alias("cleaned"), F.length("c").alias("n_clean")
    )


@query("text_clean_postings", f"WITH {postings_cte('posting_id', 'title', 'company')} SELECT posting_id, "
       f"{_clean_sql('title')} AS title, {_clean_sql('company')} AS company FROM postings")
def text_clean_postings(spark, sf):
    p = postings(spark, sf, "posting_id", "title", "company")
    return p.select("posting_id", text.clean_text("title").alias("title"), text.clean_text("company").alias("company"))


@query("text_norm", f"SELECT conv_id, turn, {_norm_sql('text')} AS norm FROM conversations")
def text_norm(spark, sf):
    return table(spark, sf, "conversations").select("conv_id", "turn", text.norm_text("text").alias("norm"))


@query(
    "text_composite_key",
    f"WITH {postings_cte('posting_id', 'title', 'company', 'location')} SELECT posting_id, "
    f"lower({_norm_sql('title')}) || '__' || lower({_norm_sql('company')}) || '__' || lower({_norm_sql('location')}) AS k "
    "FROM postings",
)
def text_composite_key(spark, sf):
    p = postings(spark, sf, "posting_id", "title", "company", "location")
    return p.select("posting_id", text.composite_key("title", "company", "location").alias("k"))


@query("text_strip_accents", f"SELECT doc_id, md5({_accents_sql('text')}) AS folded FROM documents")
def text_strip_accents(spark, sf):
    return wide_table(spark, sf, "documents", "doc_id", "text").select("doc_id", F.md5(text.strip_accents("text")).alias("folded"))


@query(
    "text_signature",
    f"WITH {postings_cte('posting_id', 'title', 'company')} SELECT posting_id, {_signature_sql('title')} AS title_sig, "
    f"{_signature_sql('company')} AS company_sig FROM postings",
)
def text_signature(spark, sf):
    p = postings(spark, sf, "posting_id", "title", "company")
    return p.select(
        "posting_id",
        text.signature_tokens("title").alias("title_sig"),
        text.signature_tokens("company").alias("company_sig"),
    )


@query(
    "text_block_key",
    f"WITH {postings_cte('posting_id', 'title', 'company', 'location')} SELECT posting_id, sha256("
    f"{_accents_sql('location')} || '|' || {_signature_sql('title')} || '|' || {_signature_sql('company')}) AS block_key "
    "FROM postings",
)
def text_block_key(spark, sf):
    p = postings(spark, sf, "posting_id", "title", "company", "location")
    return p.select("posting_id", text.block_key("location", "title", "company").alias("block_key"))


_SCHED_FOLD = f"regexp_replace(strip_accents(lower(trim(coalesce(schedule, '')))), '{_SP}+', ' ', 'g')"


@query(
    "text_fold_schedule",
    f"WITH {postings_cte('posting_id', 'schedule')} SELECT posting_id, {_SCHED_FOLD} AS folded FROM postings",
)
def text_fold_schedule(spark, sf):
    p = postings(spark, sf, "posting_id", "schedule")
    return p.select("posting_id", text.fold_schedule("schedule").alias("folded"))


@query(
    "text_normal_forms",
    "SELECT doc_id, md5(nfc_normalize(text)) AS nfc FROM documents",
)
def text_normal_forms(spark, sf):
    """Decompose, then recompose: a round trip through both normal forms."""
    docs = wide_table(spark, sf, "documents", "doc_id", "text")
    return docs.select("doc_id", F.md5(text.normalize_unicode(text.normalize_unicode("text", "NFD"), "NFC")).alias("nfc"))


@query(
    "text_strip_newlines",
    "SELECT doc_id, md5(replace(text, chr(10), '')) AS text, lang, source, n_chars FROM documents",
)
def text_strip_newlines(spark, sf):
    return text.strip_newlines(table(spark, sf, "documents")).withColumn("text", F.md5("text"))


# --- location -------------------------------------------------------------------------------------------------------

_PARTS = "string_split(trim(location), ',')"


@query(
    "location_parts",
    f"""WITH {postings_cte('posting_id', 'location')} SELECT posting_id,
    coalesce(trim({_PARTS}[1]), '') AS city, coalesce(trim({_PARTS}[2]), '') AS state,
    CASE WHEN len({_PARTS}) > 1 THEN trim({_PARTS}[-1]) ELSE '' END AS province FROM postings""",
)
def location_parts(spark, sf):
    p = postings(spark, sf, "posting_id", "location")
    return p.select(
        "posting_id",
        location.extract_city("location").alias("city"),
        location.extract_state("location").alias("state"),
        location.vietnamese_province("location").alias("province"),
    )


@query(
    "location_city",
    f"""WITH {postings_cte('posting_id', 'location')} SELECT posting_id,
    coalesce(list_filter({sql_list(location.CITIES)}, lambda x: contains(location, x))[1], trim({_PARTS}[1]), '') AS city,
    list_filter({sql_list(location.PROVINCES)}, lambda x: contains(lower(location), lower(x)))[1] AS province
    FROM postings""",
)
def location_city(spark, sf):
    p = postings(spark, sf, "posting_id", "location")
    return p.select(
        "posting_id",
        location.vietnamese_city("location").alias("city"),
        location.extract_location("location").alias("province"),
    )


@query(
    "location_split",
    f"""WITH {postings_cte('posting_id', 'location')} SELECT posting_id,
    trim(regexp_split_to_array(location, ',\\s*')[1], ' ') AS location_area,
    trim(regexp_split_to_array(location, ',\\s*')[2], ' ') AS province FROM postings""",
)
def location_split(spark, sf):
    p = postings(spark, sf, "posting_id", "location")
    return p.select(
        "posting_id",
        location.location_area("location").alias("location_area"),
        location.location_province("location").alias("province"),
    )


# --- salary ---------------------------------------------------------------------------------------------------------

_B0, _B1 = f"(?:^|[^{_W}])", f"(?:$|[^{_W}])"
_N = r"(\d[\d.,]*)"
_U = "(triệu|tr|trđ|trd|million|nghìn|ngàn|ngan|k)"
_DASH = r"\s*-\s*"
_MUL = (
    "CASE WHEN lower({u}) IN ('triệu','tr','trđ','trd','million') THEN 1e6 "
    "WHEN lower({u}) IN ('nghìn','ngàn','ngan','k') THEN 1e3 ELSE 1.0 END"
)
_NORMAL = (
    "SELECT *, CASE WHEN trim(salary_text) <> '' AND NOT regexp_matches(lower(salary_text), "
    "'thương lượng|thoả thuận|thỏa thuận|negotiable') THEN regexp_replace(regexp_replace(trim(salary_text), "
    "'[–—−]', '-', 'g'), '\\s*to\\s*', '-', 'gi') END AS s FROM postings"
)


def _dig(x: str) -> str:
    return f"TRY_CAST(regexp_replace({x}, '[^0-9]', '', 'g') AS DOUBLE)"


def _dec(x: str) -> str:
    return (
        f"(CASE WHEN len(regexp_replace({x}, '[^.,]', '', 'g')) <= 1 "
        f"THEN TRY_CAST(replace({x}, ',', '.') AS DOUBLE) ELSE {_dig(x)} END)"
    )


def _mul(u: str) -> str:
    return "(" + _MUL.format(u=u) + ")"


def _named(pattern: str, names: list[str]) -> str:
    return f"CASE WHEN regexp_matches(s, '{pattern}') THEN regexp_extract(s, '{pattern}', {sql_list(names)}) END"


def _salary_a_sql(cte: str, columns: str) -> str:
    usd_range = rf"(?i){_N}\s*(?:usd|\$)?{_DASH}{_N}\s*(?:usd|\$)?"
    usd_one = rf"(?i)(?:usd|\$)\s*{_N}|{_N}\s*(?:usd|\$)"
    unit_range = rf"(?i){_B0}{_N}\s*{_U}?{_DASH}{_N}\s*{_U}?{_B1}"
    unit_one = rf"(?i){_B0}{_N}\s*{_U}{_B1}"
    one = rf"{_B0}(\d[\d.,]+){_B1}"
    eff1, eff2 = "coalesce(nullif(ur.u1,''), nullif(ur.u2,''))", "coalesce(nullif(ur.u2,''), nullif(ur.u1,''))"
    small = f"({_dig('ur.n1')} < 1e6 AND {_dig('ur.n2')} < 1e6)"
    one_value = f"(CASE WHEN {_dig('o.n')} < 1e6 THEN {_dig('o.n')} * 24000 ELSE {_dig('o.n')} END)"

    def end(n: str, eff: str) -> str:
        return f"""CASE WHEN usd AND xr IS NOT NULL THEN {_dig('xr.' + n)} * 24000
          WHEN usd AND xo IS NOT NULL THEN {_dig("coalesce(nullif(xo.n1,''), xo.n2)")} * 24000
          WHEN ur IS NOT NULL AND {eff} IS NOT NULL THEN {_dec('ur.' + n)} * {_mul(eff)}
          WHEN ur IS NOT NULL THEN {_dig('ur.' + n)} * (CASE WHEN {small} THEN 24000 ELSE 1 END)
          WHEN uo IS NOT NULL THEN {_dec('uo.n')} * {_mul('uo.u')}
          WHEN o IS NOT NULL THEN {one_value} END"""

    return f"""WITH {cte}, normal AS ({_NORMAL}), g AS (SELECT *, regexp_matches(s, '(?i)usd|\\$') AS usd,
      {_named(usd_range, ['n1', 'n2'])} AS xr, {_named(usd_one, ['n1', 'n2'])} AS xo,
      {_named(unit_range, ['n1', 'u1', 'n2', 'u2'])} AS ur, {_named(unit_one, ['n', 'u'])} AS uo,
      {_named(one, ['n'])} AS o FROM normal), r AS (SELECT *, {end('n1', eff1)} AS salary_min,
      {end('n2', eff2)} AS salary_max FROM g) {columns}"""


def _salary_b_sql(cte: str, columns: str) -> str:
    unit_range = rf"(?i){_N}\s*{_U}?{_DASH}{_N}\s*{_U}?"
    one = r"(\d[\d.,]+)"
    eff1, eff2 = "coalesce(nullif(ur.u1,''), ur.u2)", "coalesce(nullif(ur.u2,''), ur.u1)"
    one_value = f"(CASE WHEN {_dec('o.n')} < 1e6 THEN {_dec('o.n')} * 24000 ELSE {_dec('o.n')} END)"

    def end(n: str, eff: str) -> str:
        return f"""CASE WHEN usd AND xr IS NOT NULL THEN {_dec('xr.' + n)} * 24000
          WHEN usd AND xo IS NOT NULL THEN {_dec('xo.n')} * 24000
          WHEN ur IS NOT NULL THEN {_dec('ur.' + n)} * {_mul(eff)}
          WHEN uo IS NOT NULL THEN {_dec('uo.n')} * {_mul('uo.u')}
          WHEN o IS NOT NULL THEN {one_value} END"""

    return f"""WITH {cte}, normal AS ({_NORMAL}), g AS (SELECT *, regexp_matches(s, '(?i)usd|\\$') AS usd,
      {_named(_N + _DASH + _N, ['n1', 'n2'])} AS xr, {_named(rf'(?i){_N}' + r'\s*(?:usd|\$)', ['n'])} AS xo,
      {_named(unit_range, ['n1', 'u1', 'n2', 'u2'])} AS ur, {_named(rf'(?i){_N}' + r'\s*' + _U, ['n', 'u'])} AS uo,
      {_named(one, ['n'])} AS o FROM normal), r AS (SELECT *, {end('n1', eff1)} AS salary_min,
      {end('n2', eff2)} AS salary_max FROM g) {columns}"""


_SALARY_COLUMNS = "SELECT posting_id, salary_min, salary_max, (salary_min + salary_max) / 2 AS salary_avg FROM r"


def _salary_frame(p, fn):
    return p.select("posting_id", fn("salary_text").alias("s")).select(
        "posting_id",
        F.col("s.min").alias("salary_min"),
        F.col("s.max").alias("salary_max"),
        salary.salary_average(F.col("s.min"), F.col("s.max")).alias("salary_avg"),
    )


@query("salary_dialect_a", _salary_a_sql(postings_cte("posting_id", "salary_text"), _SALARY_COLUMNS))
def salary_dialect_a(spark, sf):
    return _salary_frame(postings(spark, sf, "posting_id", "salary_text"), salary.salary_range_a)


@query(
    "salary_pair",
    _salary_a_sql(postings_cte("posting_id", "salary_text"), "SELECT posting_id, salary_min AS low, salary_max AS high FROM r"),
)
def salary_pair(spark, sf):
    """Salary ranges carried as arrays of two, taken apart again as doubles."""
    p = postings(spark, sf, "posting_id", "salary_text")
    pair = p.select("posting_id", salary.as_pair(salary.salary_range_a("salary_text")).alias("pair"))
    return pair.select("posting_id", *[F.get("pair", F.lit(i)).cast("double").alias(n) for i, n in enumerate(("low", "high"))])


@query("salary_dialect_b", _salary_b_sql(postings_cte("posting_id", "salary_text"), _SALARY_COLUMNS))
def salary_dialect_b(spark, sf):
    return _salary_frame(postings(spark, sf, "posting_id", "salary_text"), salary.salary_range_b)


@query("salary_dialect_a_lines", _salary_a_sql(line_postings_cte("posting_id", "salary_text"), _SALARY_COLUMNS))
def salary_dialect_a_lines(spark, sf):
    return _salary_frame(line_postings(spark, sf, "posting_id", "salary_text"), salary.salary_range_a)


_AMOUNT = r"(\d+(?:,\d{3})*(?:\.\d{2})?)"
_K_TEXT = r"regexp_replace(trim(salary_text), '(\d+(?:,\d{3})*)\s*[Kk]', '\1000', 'g')"


@query(
    "salary_dollars",
    f"""WITH {postings_cte('posting_id', 'salary_text')}, k AS (SELECT posting_id, {_K_TEXT} AS s FROM postings),
    g AS (SELECT posting_id, {_named(rf'[$]?{_AMOUNT}' + r'\s*[-–—]\s*' + rf'[$]?{_AMOUNT}', ['a', 'b'])} AS r,
      {_named(rf'[$]?{_AMOUNT}', ['a'])} AS o FROM k)
    SELECT posting_id, CAST(replace(coalesce(r.a, o.a), ',', '') AS DOUBLE) AS salary_min,
      CAST(replace(coalesce(r.b, o.a), ',', '') AS DOUBLE) AS salary_max FROM g""",
)
def salary_dollars(spark, sf):
    p = postings(spark, sf, "posting_id", "salary_text")
    return p.select("posting_id", salary.dollar_range("salary_text").alias("s")).select(
        "posting_id", F.col("s.min").alias("salary_min"), F.col("s.max").alias("salary_max")
    )


_BIN_RANGE = (
    "list_transform(generate_series(CAST(floor({a} / 5) AS BIGINT), CAST(floor(least({b}, 100) / 5) AS BIGINT)), "
    "lambda i: i * 5)"
)


@query(
    "salary_bins_numbers",
    f"""WITH v AS (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN NULL ELSE o_totalprice * 50 END AS lo,
      CASE o_orderkey % 5 WHEN 0 THEN NULL ELSE o_totalprice * (o_custkey % 90) END AS hi,
      CASE o_orderkey % 2 WHEN 0 THEN 'usd' ELSE 'VND' END AS cur FROM orders),
    m AS (SELECT *, CASE cur WHEN 'usd' THEN floor(lo / 10000 * 24 / 1000) ELSE floor(lo / 1000000) END AS a,
      CASE cur WHEN 'usd' THEN floor(hi / 10000 * 24 / 1000) ELSE floor(hi / 1000000) END AS b FROM v)
    SELECT o_orderkey, array_to_string(CASE WHEN a IS NULL AND b IS NULL THEN []
      WHEN a IS NULL OR b IS NULL OR a = b THEN [CAST(least(floor(coalesce(a, b) / 5) * 5, 100) AS BIGINT)]
      ELSE {_BIN_RANGE.format(a='least(a, b)', b='greatest(a, b)')} END, ';') AS bins FROM m""",
)
def salary_bins_numbers(spark, sf):
    o = table(spark, sf, "orders").selectExpr(
        "o_orderkey",
        "CASE o_orderkey % 4 WHEN 0 THEN NULL ELSE o_totalprice * 50 END AS lo",
        "CASE o_orderkey % 5 WHEN 0 THEN NULL ELSE o_totalprice * (o_custkey % 90) END AS hi",
        "CASE o_orderkey % 2 WHEN 0 THEN 'usd' ELSE 'VND' END AS cur",
    )
    scale = F.when(F.col("cur") == "usd", 10000).otherwise(1)
    bins = salary.salary_bins_from_numbers(F.col("lo") / scale, F.col("hi") / scale, F.col("cur"))
    return o.select("o_orderkey", joined(bins).alias("bins"))


def _bins_text_sql(cte: str, tail: str) -> str:
    hits = " || ".join(
        f"regexp_extract_all(t, '{p}', {g})"
        for p, g in [
            (r"(?i)lương(?:từ| )+ ([\d.]+)", 1),
            (r"(?i)([\d.\- ]+(?:triệu| )+)đồng", 1),
            (r"[\d.,]+.000.000", 0),
            (r"(?i)[\d \-]+\d *(?:triệu|m)", 0),
            (r"[$](?:\d+|,)", 0),
            (r"(?i)[\d,]+ *(?:USD|[$])+", 0),
            (r"[\d.,]+,000,000", 0),
        ]
    )
    dollars = (
        "CASE WHEN starts_with(h, '$') THEN h[2:] WHEN contains(h, '$') THEN h[:-2] "
        "WHEN contains(h, 'USD') THEN replace(h, 'USD', '') WHEN contains(h, 'usd') THEN replace(h, 'usd', '') END"
    )

    def million(x: str) -> str:
        spelled = f"regexp_replace({x}, 'triệu|Triệu|TRIỆU|m|M', '000000', 'g')"
        return f"floor(TRY_CAST(regexp_replace({spelled}, '[., ]', '', 'g') AS DOUBLE) / 1e6)"

    return f"""WITH {cte}, x AS (SELECT salary_text, unnest(list_distinct({hits})) AS h FROM
        (SELECT DISTINCT salary_text, salary_text AS t FROM postings)),
      d AS (SELECT salary_text, TRY_CAST(trim(replace({dollars}, ',', '')) AS DOUBLE) AS usd,
        string_split(trim(trim(h), '-'), '-') AS p FROM x),
      v AS (SELECT salary_text, usd, p, {million('p[1]')} AS m1, {million('p[2]')} AS m2,
        TRY_CAST(trim(regexp_replace(p[1], '[.,]', '', 'g')) AS DOUBLE) AS start FROM d),
      b AS (SELECT salary_text, unnest(CASE WHEN usd IS NOT NULL THEN
          [CAST(least(floor(floor(usd * 24 / 1000) / 5) * 5, 100) AS BIGINT)]
        WHEN len(p) = 1 THEN [CAST(least(floor(m1 / 5) * 5, 100) AS BIGINT)]
        WHEN start IS NOT NULL AND m2 IS NOT NULL THEN {_BIN_RANGE.format(a='start', b='m2')} END) AS bin FROM v),
      s AS (SELECT salary_text, list_sort(list(DISTINCT bin)) AS l FROM b WHERE bin IS NOT NULL GROUP BY salary_text),
      f AS (SELECT salary_text, CASE WHEN len(l) = 2 THEN generate_series(l[1], l[2], 5) ELSE l END AS l FROM s)
      {tail}"""


@query(
    "salary_bins_text",
    _bins_text_sql(
        postings_cte("posting_id", "salary_text"),
        "SELECT posting_id, coalesce(array_to_string(l, ';'), '') AS bins FROM postings LEFT JOIN f USING (salary_text)",
    ),
)
def salary_bins_text(spark, sf):
    p = postings(spark, sf, "posting_id", "salary_text")
    return p.select("posting_id", joined(salary.salary_bins_from_text("salary_text")).alias("bins"))


@query(
    "salary_known",
    _bins_text_sql(
        line_postings_cte("posting_id", "salary_text"),
        "SELECT posting_id, array_to_string(l, ';') AS bins FROM postings JOIN f USING (salary_text)",
    ),
)
def salary_known(spark, sf):
    """Postings whose salary names at least one bin."""
    p = line_postings(spark, sf, "posting_id", "salary_text")
    p = compute_once(p, "Salaries", salary.salary_bins_from_text("salary_text"))
    return with_salary(p).select("posting_id", joined(F.col("Salaries")).alias("bins"))


# --- experience, age, schedule --------------------------------------------------------------------------------------


def _wording_sql(patterns: list[tuple[str, int]]) -> str:
    branches = []
    for p, groups in patterns:
        value = f"CAST(regexp_extract(t, '{p}', 1) AS BIGINT)"
        if groups == 2:
            value = f"CAST(floor(({value} + CAST(regexp_extract(t, '{p}', 2) AS BIGINT)) / 2) AS BIGINT)"
        branches.append(f"WHEN regexp_matches(t, '{p}') THEN {value}")
    return " ".join(branches)


_EXP_N = r"(\d+)\+?\s*"
_EN = _wording_sql(
    [
        (_EXP_N + r"to\s*(\d+)\s*years?", 2), (_EXP_N + r"-\s*(\d+)\s*years?", 2),
        (_EXP_N + r"years?\s*(?:of\s*)?experience", 1), (_EXP_N + r"years?\s*exp", 1), (_EXP_N + r"yrs?\s*exp", 1),
        (_EXP_N + "years?", 1), (_EXP_N + "yr", 1), (_EXP_N + f"y{_B1}", 1),
    ]
)
_VI = _wording_sql(
    [
        (_EXP_N + r"-\s*(\d+)\s*năm", 2), (_EXP_N + r"đến\s*(\d+)\s*năm", 2),
        (_EXP_N + r"năm\s*kinh\s*nghiệm", 1), (_EXP_N + r"năm\s*exp", 1), (_EXP_N + "năm", 1), (_EXP_N + f"n{_B1}", 1),
    ]
)


@query(
    "experience_years",
    f"""WITH {postings_cte('posting_id', 'experience_text')},
    t AS (SELECT posting_id, lower(experience_text) AS t FROM postings)
    SELECT posting_id, CASE {_EN} END AS english, CASE WHEN regexp_matches(t,
      'không yêu cầu|không cần kinh nghiệm|fresh graduate|sinh viên mới ra trường') THEN 0 {_VI} END AS vietnamese FROM t""",
)
def experience_years(spark, sf):
    p = postings(spark, sf, "posting_id", "experience_text")
    return p.select(
        "posting_id",
        experience.english_experience("experience_text").alias("english"),
        experience.vietnamese_experience("experience_text").alias("vietnamese"),
    )


def _expand_sql(step: int, cap: int) -> str:
    return (
        f"CASE WHEN len(n) = 2 THEN list_transform(generate_series(CAST(floor(n[1] / {step}) AS BIGINT), "
        f"CAST(floor(least(n[2], {cap}) / {step}) AS BIGINT)), lambda i: i * {step}) ELSE n END"
    )


_NUMBERS = (
    f"list_transform(regexp_extract_all(regexp_replace(coalesce(experience_text, ''), '[{_W}]+', ' \\0 ', 'g'), "
    f"'{_B0}(\\d+){_B1}', 1), lambda x: CAST(x AS BIGINT))"
)


@query(
    "experience_lists",
    f"""WITH {postings_cte('posting_id', 'experience_text')},
    n AS (SELECT posting_id, {_NUMBERS} AS n FROM postings),
    e AS (SELECT posting_id, {_expand_sql(1, 10)} AS years, {_expand_sql(5, 45)} AS ages FROM n)
    SELECT posting_id, array_to_string(years, ';') AS years, array_to_string(ages, ';') AS ages,
      CASE WHEN list_min(years) = list_max(years) THEN list_min(years) || ' năm'
           WHEN len(years) > 0 THEN list_min(years) || ' - ' || list_max(years) || ' năm' END AS rendered FROM e""",
)
def experience_lists(spark, sf):
    p = postings(spark, sf, "posting_id", "experience_text")
    years = experience.experience_list("experience_text")
    return p.select("posting_id", years.alias("years"), experience.age_list("experience_text").alias("ages")).select(
        "posting_id",
        joined(F.col("years")).alias("years"),
        joined(F.col("ages")).alias("ages"),
        experience.render_experience(F.col("years")).alias("rendered"),
    )


@query(
    "work_schedule",
    f"""WITH {postings_cte('posting_id', 'schedule')},
    f AS (SELECT posting_id, schedule, {_SCHED_FOLD} AS t,
      list_transform(regexp_extract_all(schedule, '(\\d{{1,2}}:\\d{{2}})', 1), lambda x:
        CAST(string_split(x, ':')[1] AS INT) * 60 + CAST(string_split(x, ':')[2] AS INT)) AS m FROM postings),
    h AS (SELECT *, coalesce(list_sum(list_transform(generate_series(1, len(m) // 2),
        lambda i: greatest(0, (m[2 * i] - m[2 * i - 1]) / 60))), 0) AS clock,
      coalesce(TRY_CAST(regexp_extract(t, '(\\d{{1,2}})\\s*(?:h|gio|tieng)', 1) AS DOUBLE), 0) AS spoken,
      TRY_CAST(regexp_extract(t, 'thu\\s*([2-7])\\s*-\\s*thu\\s*([2-7])', 1) AS INT) AS d1,
      TRY_CAST(regexp_extract(t, 'thu\\s*([2-7])\\s*-\\s*thu\\s*([2-7])', 2) AS INT) AS d2,
      len(list_distinct(regexp_extract_all(t, 'thu\\s*([2-7])', 1))) AS named,
      CASE WHEN regexp_matches(t, 'chu\\s*nhat|cn') THEN 1 ELSE 0 END AS sunday FROM f),
    w AS (SELECT *, CASE WHEN clock = 0 THEN spoken ELSE clock END AS h0,
      CASE WHEN d2 >= d1 THEN d2 - d1 + 1 WHEN named > 0 AND regexp_matches(t, '\\d+\\s*thu\\s*7\\s*/\\s*thang')
        THEN greatest(named + sunday, 5) WHEN named > 0 THEN named + sunday END AS days FROM h),
    l AS (SELECT *, nullif(CASE WHEN h0 >= 8.5 THEN h0 - 1 ELSE h0 END, 0) AS hours FROM w)
    SELECT posting_id, CAST(hours AS DOUBLE) AS hours, CAST(days AS DOUBLE) AS days,
      CASE WHEN schedule IS NULL OR schedule = '' THEN NULL
        WHEN contains(t, 'toan thoi gian') OR contains(t, 'full time') THEN 'Toàn thời gian'
        WHEN contains(t, 'ban thoi gian') OR contains(t, 'part time') THEN 'Bán thời gian'
        WHEN (hours IS NOT NULL OR days IS NOT NULL) AND coalesce(hours, 8) * coalesce(days, 5) >= 35
          THEN 'Toàn thời gian' ELSE 'Bán thời gian' END AS schedule FROM l""",
)
def work_schedule(spark, sf):
    p = postings(spark, sf, "posting_id", "schedule").withColumn("t", text.fold_schedule("schedule"))
    return p.select(
        "posting_id",
        schedule.hours_per_day(F.col("schedule"), F.col("t")).alias("hours"),
        schedule.days_per_week(F.col("t")).alias("days"),
        schedule.classify_work_schedule("schedule").alias("schedule"),
    )


# --- vocabularies ---------------------------------------------------------------------------------------------------

_BOTH = "coalesce(description, '') || ' ' || coalesce(skills, '')"


def _match_sql(expr: str, entries: list[str], values: list[str] | None = None) -> str:
    """Regular-expression match per entry, escaping everything but ``.`` and ``*``."""
    escaped = [re.sub(r"([+()|\[\]{}^$?\\-])", r"\\\1", e) for e in entries]
    rows = ", ".join(f"{{'p': '{p}', 'v': '{v}'}}" for p, v in zip(escaped, values or entries))
    found = f"list_filter([{rows}], lambda r: regexp_matches({expr}, r.p, 'i'))"
    return f"coalesce(array_to_string(list_transform({found}, lambda r: r.v), ';'), '')"


def _doc_query(name: str, entries: list[str], fn) -> None:
    sql = _match_sql("' ' || text", entries)

    @query(name, f"SELECT doc_id, {sql} AS found FROM documents")
    def run(spark, sf):
        docs = wide_table(spark, sf, "documents", "doc_id", "text")
        return docs.select("doc_id", joined(fn(F.lit(""), F.col("text"))).alias("found"))


_doc_query("vocab_frameworks_documents", terms.FRAMEWORKS, vocab.extract_frameworks)
_doc_query("vocab_programming_documents", terms.PROGRAMMING_LANGUAGES, vocab.extract_programming_languages)
_doc_query("vocab_knowledge_documents", terms.KNOWLEDGE, vocab.extract_knowledge)
_doc_query("vocab_design_patterns_documents", terms.DESIGN_PATTERNS, vocab.extract_design_patterns)


@query(
    "vocab_skills_documents",
    f"SELECT doc_id, array_to_string(list_filter({sql_list(terms.SKILLS)}, lambda x: contains(lower(text), x)), ';') AS found "
    "FROM documents",
)
def vocab_skills_documents(spark, sf):
    return wide_table(spark, sf, "documents", "doc_id", "text").select("doc_id", joined(vocab.extract_skills("text")).alias("found"))


@query(
    "vocab_postings",
    f"""WITH {postings_cte('posting_id', 'description', 'skills', 'education', 'industry')} SELECT posting_id,
    {_match_sql(_BOTH, terms.FRAMEWORKS)} AS frameworks,
    {_match_sql(_BOTH, terms.PROGRAMMING_LANGUAGES)} AS programming,
    {_match_sql(_BOTH, terms.KNOWLEDGE)} AS knowledge,
    {_match_sql(_BOTH, terms.DESIGN_PATTERNS)} AS design_patterns,
    {_match_sql("coalesce(skills, '')", list(terms.LANGUAGES), list(terms.LANGUAGES.values()))} AS languages,
    {_match_sql("coalesce(education, '')", terms.EDUCATION)} AS education,
    {_match_sql("coalesce(industry, '')", list(terms.JOB_TYPES), list(terms.JOB_TYPES.values()))} AS job_types
    FROM postings""",
)
def vocab_postings(spark, sf):
    p = postings(spark, sf, "posting_id", "description", "skills", "education", "industry")
    return p.select(
        "posting_id",
        joined(vocab.extract_frameworks("description", "skills")).alias("frameworks"),
        joined(vocab.extract_programming_languages("description", "skills")).alias("programming"),
        joined(vocab.extract_knowledge("description", "skills")).alias("knowledge"),
        joined(vocab.extract_design_patterns("description", "skills")).alias("design_patterns"),
        joined(vocab.extract_languages("skills")).alias("languages"),
        joined(vocab.extract_education("education")).alias("education"),
        joined(vocab.extract_job_type("industry")).alias("job_types"),
    )


def label_values() -> str:
    """``(term, category)`` rows of the label table for the checking SQL."""
    return "(VALUES " + ", ".join(f"('{t}', '{c}')" for t, c in terms.KNOWLEDGE_LABELS.items()) + ") AS labels(term, category)"


def knowledge_terms_sql() -> str:
    """One row per posting and knowledge term, with its vocabulary position."""
    values = ", ".join(f"({i}, '{t}')" for i, t in enumerate(terms.KNOWLEDGE))
    return (
        f"found AS (SELECT posting_id, ord, term FROM postings, (VALUES {values}) AS v(ord, term) "
        f"WHERE contains(lower({_BOTH}), lower(term)))"
    )


@query(
    "vocab_grouped_knowledge",
    f"""WITH {postings_cte('posting_id', 'description', 'skills')}, {knowledge_terms_sql()},
    first AS (SELECT posting_id, arg_min(category, ord) AS category FROM found JOIN {label_values()} USING (term)
      GROUP BY posting_id)
    SELECT posting_id, category FROM postings LEFT JOIN first USING (posting_id)""",
)
def vocab_grouped_knowledge(spark, sf):
    p = postings(spark, sf, "posting_id", "description", "skills")
    knowledge = vocab.extract_knowledge("description", "skills")
    return p.select("posting_id", vocab.grouped_knowledge(knowledge).alias("category"))


_GROUP_VALUES = ", ".join(
    f"('{g}', '{t}')" for g, members in terms.KNOWLEDGE_GROUPS.items() for t in members
)


@query(
    "vocab_group_headings",
    f"""WITH {postings_cte('posting_id', 'description', 'skills')}
    SELECT category, count(*) AS n_terms, count(DISTINCT posting_id) AS n_postings
    FROM postings, (VALUES {_GROUP_VALUES}) AS g(category, term)
    WHERE contains(lower({_BOTH}), lower(term)) GROUP BY category""",
)
def vocab_group_headings(spark, sf):
    """Postings per category heading, from the inverse term map."""
    p = postings(spark, sf, "posting_id", "description", "skills")
    pairs = {f"{g}|{t}": t for g, members in terms.KNOWLEDGE_GROUPS.items() for t in members}
    body = vocab.posting_text("description", "skills")
    flags = F.array(
        *[F.struct(F.lit(k.split("|")[0]).alias("category"), F.lit(t.lower()).alias("needle")) for k, t in pairs.items()]
    )
    hits = text.let(F.lower(body), lambda t: F.filter(flags, lambda x: F.contains(t, x["needle"])))
    rows = p.select("posting_id", F.explode(hits).alias("h")).select("posting_id", F.col("h.category").alias("category"))
    per_posting = rows.groupBy("category", "posting_id").agg(F.count("*").alias("n"))
    return per_posting.groupBy("category").agg(F.sum("n").alias("n_terms"), F.count("*").alias("n_postings"))
