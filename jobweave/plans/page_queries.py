"""Queries over stored web pages, and over pages rendered from the postings."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.html import (
    Page,
    plain_text,
    reported_total,
    set_query_parameter,
    url_path,
)
from ..operators import pages as pg
from ..session import deal
from ..sources.schemas import DETAIL_ORDER
from ..sources.sinks import in_order
from .derive import postings, postings_cte
from .features import _norm_sql
from .registry import query, table, wide_table

HOST = "https://pages.example"


def _plain_sql(col: str) -> str:
    text = f"regexp_replace({col}, '<script.*?</script\\s*>|<style.*?</style\\s*>|<!--.*?-->', ' ', 'gis')"
    text = f"regexp_replace({text}, '<[^>]*>', ' ', 'gs')"
    for entity, char in [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·"), ("&nbsp;", " "), ("&amp;", "&")]:
        text = f"replace({text}, '{entity}', '{char}')"
    return _norm_sql(text)


@query("page_text", f"SELECT page_id, md5({_plain_sql('html')}) AS body FROM pages")
def page_text(spark, sf):
    return wide_table(spark, sf, "pages", "page_id", "html").select("page_id", F.md5(plain_text("html")).alias("body"))


@query("page_text_parsed", f"SELECT page_id, md5({_plain_sql('html')}) AS body FROM pages")
def page_text_parsed(spark, sf):
    """The same text by way of the element arrays."""
    pages = pg.parsed(wide_table(spark, sf, "pages", "page_id", "html"))
    return pages.select("page_id", F.md5(Page("page").all_text()).alias("body"))


_LINKS_SQL = f"""a AS (SELECT url, unnest(regexp_extract_all(html, '(?is)<a\\b[^>]*?\\bhref="([^"]*)"[^>]*>(.*?)</a>', 1)) AS href,
    unnest(regexp_extract_all(html, '(?is)<a\\b[^>]*?\\bhref="([^"]*)"[^>]*>(.*?)</a>', 2)) AS title,
    generate_subscripts(regexp_extract_all(html, '(?is)<a\\b[^>]*?\\bhref="([^"]*)"[^>]*>(.*?)</a>', 1), 1) - 1 AS position FROM pages),
  l AS (SELECT url, position, CASE WHEN starts_with(href, '/') THEN '{HOST}' || href WHEN starts_with(href, 'http') THEN href
    ELSE '{HOST}/' || href END AS link, title FROM a WHERE regexp_matches(href, '^/[a-zà-ÿ]')
    QUALIFY row_number() OVER (PARTITION BY url, href ORDER BY position) = 1)"""


def _links(spark, sf):
    return pg.listing_links(wide_table(spark, sf, "pages", "url", "html"), "url", "html", "^/[a-zà-ÿ]", HOST)


@query("page_links", f"WITH {_LINKS_SQL} SELECT url, link, title FROM l")
def page_links(spark, sf):
    return _links(spark, sf).select("url", "link", "title")


@query(
    "page_links_numbered",
    f"WITH {_LINKS_SQL}, f AS (SELECT * FROM l QUALIFY row_number() OVER (PARTITION BY link ORDER BY url, position) = 1) "
    "SELECT link, title, row_number() OVER (ORDER BY url, position) AS stt FROM f",
)
def page_links_numbered(spark, sf):
    return pg.numbered_links(_links(spark, sf), ["url", "position"]).select("link", "title", "stt")


@query(
    "page_headings",
    "SELECT page_id, md5(" + _plain_sql("regexp_extract(html, '<h1>(.*?)</h1>', 1, 's')") + ") AS heading, "
    "md5(" + _plain_sql("regexp_extract(html, '<title>(.*?)</title>', 1, 's')") + ") AS title, "
    "len(regexp_extract_all(html, '<li>')) AS n_items FROM pages",
)
def page_headings(spark, sf):
    pages = pg.parsed(wide_table(spark, sf, "pages", "page_id", "html"))
    page = Page("page")
    return pages.select(
        "page_id",
        F.md5(page.first_text("h1")).alias("heading"),
        F.md5(page.first_text("title")).alias("title"),
        F.size(page.find("nav", "ul", "li")).alias("n_items"),
    )


@query(
    "page_url_parameters",
    """WITH p AS (SELECT page_id, url, regexp_extract(url, '^([^#]*)', 1) AS base, regexp_extract(url, '(#.*)$', 1) AS frag FROM pages)
    SELECT page_id, CASE WHEN regexp_matches(url, '[?&]page=') THEN regexp_replace(base, '([?&]page=)[^&]*', '\\17')
      ELSE base || CASE WHEN contains(base, '?') THEN '&' ELSE '?' END || 'page=7' END || frag AS paged,
      base || CASE WHEN contains(base, '?') THEN '&' ELSE '?' END || 'l=' || page_id || frag AS located,
      regexp_extract(base, '^[a-z]+://[^/?]*([^?]*)', 1) AS path FROM p""",
)
def page_url_parameters(spark, sf):
    pages = table(spark, sf, "pages")
    return pages.select(
        "page_id",
        set_query_parameter("url", "page", "7").alias("paged"),
        set_query_parameter("url", "l", F.col("page_id").cast("string")).alias("located"),
        url_path("url").alias("path"),
    )


@query(
    "page_chunks",
    "SELECT page_id // 10 AS chunk, page_id AS page, url || '&p=' || page_id AS page_url FROM pages",
)
def page_chunks(spark, sf):
    """Page ranges of ten, unfolded to one address per page."""
    pages = table(spark, sf, "pages").select("page_id", "url")
    ranges = pages.groupBy(F.floor(F.col("page_id") / 10).alias("chunk")).agg(
        F.min("page_id").alias("first"), F.max("page_id").alias("last")
    )
    unfolded = ranges.select("chunk", F.explode(F.sequence("first", "last")).alias("page"))
    joined = unfolded.join(pages.withColumnRenamed("page_id", "page"), "page")
    return joined.select("chunk", "page", F.concat("url", F.lit("&p="), F.col("page").cast("string")).alias("page_url"))


# --- pages rendered from postings ---------------------------------------------------------------------------------------


def _html(*parts: str) -> str:
    """``concat`` of literal markup and column expressions (given in braces)."""
    pieces = []
    for part in parts:
        pieces.append(f"coalesce({part[1:-1]}, '')" if part.startswith("{") else f"'{part}'")
    return "concat(" + ", ".join(pieces) + ")"


JOBOKO_PAGE = _html(
    '<html><body><div class="nw-company-hero"><div class="nw-company-hero__info"><h2><a href="/c">', "{company}",
    '</a></h2></div><div class="nw-company-hero__address"><a href="#">Địa điểm làm việc: ', "{location}",
    '</a></div></div><div class="nw-job-list__main"><div class="block-entry"><div class="item"><div class="item-content">'
    'Thu nhập: <span class="fw-bold">', "{salary_text}", '</span></div></div><div class="item"><div class="item-content">'
    "Kinh nghiệm: ", "{experience_text}", '</div></div><div class="item"><div class="item-content">Chức vụ: <b class="fw-bold">',
    "{job_level}", "</b></div></div></div><h3>Mô tả  công việc</h3><p>", "{description}", "</p><ul><li>một</li><li>hai</li></ul>"
    '<h3>Yêu cầu ứng viên</h3> <div class="job-requirement">', "{skills}", "</div><h3>Quyền lợi</h3><p>Thưởng</p></div>"
    '<h4 class="nw-job-detail__heading">Quy mô công ty</h4><div class="nw-job-detail__text">', "{CAST(posting_id AS STRING)}",
    ' nhân viên</div><div class="mt-1 fz-16">Hạn nộp: ', "{deadline}", "</div><p>(1.", "{CAST(posting_id + 100 AS STRING)}", " việc)</p></body></html>",
)


def _joboko_pages(spark, sf):
    """Rendered pages; every fourth was stored a second time after it had gone."""
    rows = postings(spark, sf).withColumn("crawl", F.explode(F.expr("sequence(1, IF(posting_id % 4 = 0, 2, 1))")))
    return rows.selectExpr(
        "concat('https://vn.joboko.com/x/', CAST(posting_id AS STRING)) AS url",
        "crawl",
        f"CASE crawl WHEN 1 THEN {JOBOKO_PAGE} ELSE '<p>Không còn</p>' END AS html",
    )


def _trimmed(col: str) -> str:
    return f"trim({_norm_sql(col)})"


@query(
    "joboko_details",
    f"""WITH {postings_cte()} SELECT posting_id AS stt, title AS ten_cong_viec,
    CASE WHEN posting_id % 9 = 0 THEN '' ELSE {_trimmed('company')} END AS ten_cong_ty,
    CASE WHEN posting_id % 9 = 0 THEN '' ELSE {_trimmed('location')} END AS dia_diem_lam_viec,
    CASE WHEN posting_id % 9 = 0 THEN '' ELSE {_trimmed('salary_text')} END AS muc_luong,
    CASE WHEN posting_id % 9 = 0 THEN '' ELSE {_trimmed('experience_text')} END AS kinh_nghiem,
    CASE WHEN posting_id % 9 = 0 THEN '' ELSE {_trimmed('description')} || chr(10) || 'một hai' END AS mo_ta_chi_tiet,
    CASE WHEN posting_id % 9 = 0 THEN '' ELSE {_trimmed('skills')} END AS ki_nang_yeu_cau,
    '' AS loai_cong_viec, CASE WHEN posting_id % 9 = 0 THEN '' ELSE {_trimmed('job_level')} END AS cap_bac,
    CASE WHEN posting_id % 9 = 0 THEN '' ELSE posting_id || ' nhân viên' END AS quy_mo,
    CASE WHEN posting_id % 9 = 0 THEN '' ELSE deadline END AS han_nop,
    'IT / Phần mềm / IOT / Điện tử viễn thông' AS nganh_nghe,
    CASE WHEN posting_id % 9 = 0 THEN 'https://vn.joboko.com/lost/' ELSE 'https://vn.joboko.com/x/' END || posting_id AS link FROM postings""",
)
def joboko_details(spark, sf):
    """Listed postings joined to their rendered pages; every ninth page is missing."""
    links = postings(spark, sf, "posting_id", "title").selectExpr(
        "posting_id AS stt",
        "title AS ten",
        "concat(CASE WHEN posting_id % 9 = 0 THEN 'https://vn.joboko.com/lost/' ELSE 'https://vn.joboko.com/x/' END, "
        "CAST(posting_id AS STRING)) AS link",
    )
    return pg.joboko_details(links, _joboko_pages(spark, sf), order=["crawl"])


@query(
    "page_reported_total",
    f"WITH {postings_cte('posting_id')} SELECT 'https://vn.joboko.com/x/' || posting_id AS url, "
    "CAST('1' || (posting_id + 100) AS BIGINT) AS total FROM postings UNION ALL "
    "SELECT 'https://vn.joboko.com/x/' || posting_id, -1 FROM postings WHERE posting_id % 4 = 0 UNION ALL SELECT url, -1 FROM pages",
)
def page_reported_total(spark, sf):
    rendered = _joboko_pages(spark, sf).select("url", "html")
    both = rendered.unionByName(table(spark, sf, "pages").select("url", "html"))
    return both.select("url", reported_total("html").alias("total"))


JOBOKO_LISTING = _html(
    '<div class="nw-job-list__list"><div class="item"><div class="item-head"><h2 class="item-title"><a href="/viec-lam-abc-xvi',
    "{CAST(posting_id % 500 AS STRING)}", '"> ', "{p_name}", ' </a></h2></div></div><div class="item"><div class="item-head">'
    '<h2 class="item-title"><a href="https://vn.joboko.com/viec-lam-ky-sư-xvi', "{CAST(posting_id AS STRING)}",
    '">Kỹ sư</a></h2></div></div><div class="item"><div class="item-head"><h2 class="item-title"><a href="/tin-tuc">Tin</a></h2>'
    '</div></div></div><a href="/viec-lam-z-xvi1">Ngoài</a><a class="job-link clickable-outside" href="/tim/',
    "{CAST(posting_id AS STRING)}", '">x</a>',
)


def _listing_pages(spark, sf):
    rows = deal(table(spark, sf, "part").selectExpr("p_partkey AS posting_id", "p_name"))
    return pg.parsed(rows.selectExpr("posting_id", f"{JOBOKO_LISTING} AS html"))


@query(
    "joboko_links",
    "SELECT p_partkey AS posting_id, 'https://vn.joboko.com/viec-lam-abc-xvi' || (p_partkey % 500) AS link, p_name AS title FROM part "
    "UNION ALL SELECT p_partkey, 'https://vn.joboko.com/viec-lam-ky-sư-xvi' || p_partkey, 'Kỹ sư' FROM part",
)
def joboko_links(spark, sf):
    return pg.joboko_links(_listing_pages(spark, sf), "posting_id").drop("position")


@query("careerlink_links", "SELECT p_partkey AS posting_id, '/tim/' || p_partkey AS link FROM part")
def careerlink_links(spark, sf):
    return pg.careerlink_links(_listing_pages(spark, sf), "posting_id").drop("position")


CAREERLINK_PAGE = _html(
    '<h1 class="job-title mb-0">', "{CASE WHEN posting_id % 8 = 0 THEN NULL ELSE description END}", '</h1><p class="org-name mb-2">',
    "{company}", '</p><div id="job-location"><span>Tại</span> <a>', "{location}", '</a></div><div id="job-salary"><i></i>'
    '<span class="text-primary"> ', "{salary_text}", ' </span></div><div><i class="cli-suitcase-simple"></i><span>', "{experience_text}",
    '</span></div><div id="section-job-description"><div class="rich-text-content"><p>', "{description}", "</p><p>Hết</p></div></div>"
    '<div id="section-job-skills"><div class="rich-text-content">', "{skills}", "</div></div>"
    '<div class="row job-summary d-flex"><div><div class="my-0 summary-label">Loại công việc</div><div>', "{job_type}",
    '</div></div><div><div class="my-0 summary-label">Cấp bậc</div><div>', "{job_level}",
    '</div></div><div><div class="my-0 summary-label">Học vấn</div><div>', "{education}",
    '</div></div><div><div class="my-0 summary-label">Giới tính</div><div>', "{CASE WHEN posting_id % 3 = 0 THEN 'Nam' ELSE 'Nữ' END}",
    '</div></div><div><div class="my-0 summary-label">Tuổi</div><div>', "{CAST(posting_id % 40 + 18 AS STRING)}",
    '</div></div><div><div class="my-0 summary-label">Ngành nghề</div><div>', "{industry}", "</div></div></div>",
)


@query(
    "careerlink_details",
    f"""WITH {postings_cte()} SELECT posting_id, CASE WHEN posting_id % 8 = 0 THEN '' ELSE description END AS "tên công việc",
    coalesce(company, '') AS "tên công ty", trim('Tại ' || trim(coalesce(location, ''))) AS "Địa điểm công việc",
    trim(coalesce(salary_text, '')) AS "Mức lương", trim(coalesce(experience_text, '')) AS "Kinh nghiệm",
    description || 'Hết' AS "mô tả công việc", trim(coalesce(skills, '')) AS "kĩ năng yêu cầu",
    coalesce(job_type, '') AS "loại công việc", coalesce(job_level, '') AS "cấp bậc", coalesce(education, '') AS "học vấn",
    CASE WHEN posting_id % 3 = 0 THEN 'Nam' ELSE 'Nữ' END AS "giới tính", CAST(posting_id % 40 + 18 AS VARCHAR) AS "tuổi",
    coalesce(industry, '') AS "ngành nghề" FROM postings WHERE posting_id % 10 <> 3""",
)
def careerlink_details(spark, sf):
    """Rendered pages; every tenth has no title element and is dropped."""
    rows = postings(spark, sf).selectExpr(
        "posting_id", f"CASE WHEN posting_id % 10 = 3 THEN '<p>Không có</p>' ELSE {CAREERLINK_PAGE} END AS html"
    )
    return pg.careerlink_details(pg.parsed(rows), "posting_id")


def _fact(title: str, value: str) -> list[str]:
    return [
        f'<div class="job-detail__info--section"><div class="job-detail__info--section-content-title">{title}</div>'
        '<div class="job-detail__info--section-content-value">', value, "</div></div>",
    ]


TOPCV_PAGE = _html(
    '<h1 class="job-detail__info--title">', "{description}", "</h1>", *_fact("Mức lương", "{salary_text}"),
    *_fact("Địa điểm", "{location}"), *_fact("Kinh nghiệm", "{experience_text}"),
    '<div class="job-detail__info--deadline">Hạn nộp hồ sơ: ', "{deadline}", '</div><div class="job-tags"><a class="item">',
    "{job_type}", '</a><a class="item">IT</a></div><div class="job-description"><div class="job-description__item"><h3>Mô tả công việc</h3>'
    '<div class="job-description__item--content">', "{description}", '</div></div><div class="job-description__item"><h3>Yêu cầu ứng viên</h3>'
    '<div class="job-description__item--content">', "{skills}", '</div></div><div class="job-description__item"><h3>Địa điểm làm việc</h3>'
    '<div class="job-description__item--content"><div>Tầng 1</div><div>', "{location}", '</div></div></div>'
    '<div class="job-description__item"><h3>Thời gian làm việc</h3><div class="job-description__item--content"><ul><li>Thứ 2</li></ul></div></div></div>'
    '<a class="company" href="/cong-ty/', "{CAST(posting_id % 40 AS STRING)}", '"><span class="company-name">', "{company}", "</span></a>",
)
TOPCV_CARD = _html(
    '<div class="job-item-search-result"><h3 class="title"><a href="/viec-lam/', "{CAST(posting_id - posting_id % 3 AS STRING)}",
    '.html"> ', "{job_type}", '</a></h3><a class="company" href="/cong-ty/9"><span class="company-name">', "{company}",
    '</span></a><label class="title-salary">', "{salary_text}", '</label><label class="address"><span class="city-text">', "{location}",
    '</span></label><label class="exp"><span>', "{experience_text}", '</span></label></div><div class="job-item-search-result"><p>Quảng cáo</p></div>',
)
TOPCV_COMPANY = _html(
    '<title>CT ', "{CAST(posting_id AS STRING)}", ' | TopCV tuyển dụng</title><div class="company-overview"><ul><li><strong>Website:</strong> https://c',
    "{CAST(posting_id AS STRING)}", ".example</li><li>Quy mô: ", "{CAST(posting_id * 5 AS STRING)}", " người</li><li><b>Lĩnh vực</b> - ", "{job_type}",
    '</li><li>Địa chỉ： Số 1</li><li>Không rõ</li></ul></div><div class="company-description"> Giới  thiệu ', "{job_level}", "</div>",
)


def _blank(col: str) -> str:
    return f"nullif({_trimmed(col)}, '')"


@query(
    "topcv_jobs",
    f"""WITH {postings_cte()} SELECT posting_id AS job_url, description AS detail_title, {_blank('salary_text')} AS detail_salary,
    {_blank('location')} AS detail_location, {_blank('experience_text')} AS detail_experience, deadline,
    job_type || '; IT' AS tags, description AS desc_mota, {_blank('skills')} AS desc_yeucau, CAST(NULL AS VARCHAR) AS desc_quyenloi,
    concat_ws('; ', 'Tầng 1', {_blank('location')}) AS working_addresses, 'Thứ 2' AS working_times,
    'https://www.topcv.vn/cong-ty/' || (posting_id % 40) AS company_url_from_job FROM postings""",
)
def topcv_jobs(spark, sf):
    rows = postings(spark, sf).selectExpr("posting_id", f"{TOPCV_PAGE} AS html")
    return pg.topcv_jobs(pg.parsed(rows), "posting_id")


@query(
    "topcv_results",
    f"""WITH {postings_cte()} SELECT posting_id, job_type AS title, 'https://www.topcv.vn/viec-lam/' || (posting_id - posting_id % 3) || '.html' AS job_url,
    {_blank('company')} AS company, 'https://www.topcv.vn/cong-ty/9' AS company_url, {_blank('salary_text')} AS salary_list,
    {_blank('location')} AS address_list, {_blank('experience_text')} AS exp_list FROM postings""",
)
def topcv_results(spark, sf):
    rows = postings(spark, sf).selectExpr("posting_id", f"{TOPCV_CARD} AS html")
    return pg.topcv_results(pg.parsed(rows), "posting_id").drop("position")


def _companies(spark, sf):
    rows = postings(spark, sf).selectExpr(
        "concat('https://www.topcv.vn/cong-ty/', CAST(posting_id AS STRING)) AS url", f"{TOPCV_COMPANY} AS html"
    )
    return pg.topcv_companies(pg.parsed(rows))


_COMPANY_SQL = f"""SELECT 'https://www.topcv.vn/cong-ty/' || posting_id AS company_url, 'CT ' || posting_id AS company_name_full,
    'https://c' || posting_id || '.example' AS company_website, (posting_id * 5) || ' người' AS company_size,
    job_type AS company_industry, 'Số 1' AS company_address, {_trimmed("'Giới thiệu ' || coalesce(job_level, '')")} AS company_description
    FROM postings"""


@query("topcv_companies", f"WITH {postings_cte()} {_COMPANY_SQL}")
def topcv_companies(spark, sf):
    return _companies(spark, sf)


@query(
    "topcv_rows",
    f"""WITH {postings_cte()}, companies AS ({_COMPANY_SQL}),
    cards AS (SELECT *, posting_id - posting_id % 3 AS job FROM postings QUALIFY row_number() OVER (PARTITION BY posting_id - posting_id % 3 ORDER BY posting_id) = 1)
    SELECT row_number() OVER (ORDER BY c.posting_id) AS stt, c.job_type AS title,
      'https://www.topcv.vn/viec-lam/' || c.job || '.html' AS job_url, j.description AS detail_title, j.deadline AS deadline,
      k.company_name_full, k.company_website, k.company_size
    FROM cards c LEFT JOIN postings j ON j.posting_id = c.job AND j.posting_id % 6 <> 0
    LEFT JOIN companies k ON k.company_url = 'https://www.topcv.vn/cong-ty/' || CASE WHEN j.posting_id IS NULL THEN 9 ELSE j.posting_id % 40 END""",
)
def topcv_rows(spark, sf):
    """Cards, posting pages (every sixth missing, every fifth stored twice) and company pages in one row."""
    rows = postings(spark, sf)
    cards = pg.topcv_results(pg.parsed(rows.selectExpr("posting_id", f"{TOPCV_CARD} AS html")), "posting_id")
    twice = rows.filter("posting_id % 6 <> 0").withColumn("n", F.expr("IF(posting_id % 5 = 0, 2, 1)"))
    stored = twice.select("*", F.explode(F.sequence(F.lit(1), "n")))
    job_pages = stored.selectExpr(
        "concat('https://www.topcv.vn/viec-lam/', CAST(posting_id AS STRING), '.html') AS url", f"{TOPCV_PAGE} AS html"
    )
    merged = pg.topcv_rows(cards, pg.topcv_jobs(pg.parsed(job_pages)), _companies(spark, sf), ["posting_id"])
    columns = ["stt", "title", "job_url", "detail_title", "deadline", "company_name_full", "company_website", "company_size"]
    return in_order(merged, DETAIL_ORDER).select(*columns)
