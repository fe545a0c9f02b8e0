"""Stored pages: selectors, fallbacks and the records of the three sites."""

import pyarrow as pa
from pyspark.sql import functions as F

from jobweave.functions import html
from jobweave.functions.html import Page, plain_text
from jobweave.operators import pages as pg
from jobweave.operators import ranking
from jobweave.plans import page_queries
from jobweave.plans.derive import postings
from jobweave.session import cut_lineage


def page(spark, markup, url="u"):
    return pg.parsed(spark.createDataFrame([(url, markup)], "url string, html string"))


def value(spark, markup, expression):
    return page(spark, markup).select(expression(Page("page")).alias("v")).first()["v"]


def test_outline_nesting(spark):
    markup = '<div id="a" class="x y"><p>one<br>two <b>three</b></p><p>four</div><script>var t="</p>";</script><!-- c -->five &amp; six'
    row = page(spark, markup).first()["page"]
    tags = [e["tag"] for e in row["elements"]]
    assert tags == ["div", "p", "br", "b", "p", "script"]
    assert row["elements"][0]["classes"] == ["x", "y"]
    assert value(spark, markup, lambda p: p.text(p.first(p.find("#a")))) == "one two three four"
    assert value(spark, markup, lambda p: p.all_text()) == "one two three four five & six"
    assert value(spark, markup, lambda p: F.size(p.find("div.x.y", "p"))) == 2
    assert value(spark, markup, lambda p: F.size(p.find("p,b"))) == 3
    assert value(spark, markup, lambda p: p.first_text("div", "b", "i")) is None


def test_unclosed_and_stray_tags(spark):
    assert value(spark, "<p>a<p>b</i></p>c", lambda p: p.text(p.first(p.find("p")))) == "a b c"
    assert value(spark, None, lambda p: p.all_text()) == ""


def test_description_stops_at_next_section(spark):
    markup = (
        "<h2>Mô tả công việc</h2><p>a</p><strong>không dừng</strong><div>b <i>c</i></div><span>x</span><h3>Quyền lợi</h3><p>d</p>"
    )
    assert value(spark, markup, pg.joboko_description) == "a\nb c"
    assert value(spark, '<b>mô tả</b><p></p><div class="nw-wysiwyg"> khối  chữ </div>', pg.joboko_description) == "khối chữ"
    assert value(spark, '<div class="nw-job-list__main"><p>x</p></div><div class="nw-wysiwyg">ngoài</div>', pg.joboko_description) == ""


def test_requirements(spark):
    assert value(spark, '<h3>Yêu cầu</h3><p>a</p><div class="z job-requirement">b</div>', pg.joboko_requirements) == "b"
    assert value(spark, "<h3>Yêu cầu ứng viên</h3><p>a</p><h3>Thông tin khác</h3><p>b</p>", pg.joboko_requirements) == "a"
    assert value(spark, "<strong>YÊU CẦU</strong><ul><li>a</li><li>b</li></ul>", pg.joboko_requirements) == "a b"
    assert value(spark, "<p>không có</p>", pg.joboko_requirements) == ""


def test_facts(spark):
    main = '<div class="nw-job-list__main"><div class="block-entry">{}</div></div>'
    item = '<div class="item"><div class="item-content">{}</div></div>'
    markup = main.format(item.format("Mức lương: <b class='fw-bold'>10 triệu</b>") + item.format("Kinh nghiệm: 2 năm") + "<div class='item'>x</div>")
    assert value(spark, markup, lambda p: pg.joboko_facts(p, pg.FACT_LABELS)["muc_luong"]) == "10 triệu"
    assert value(spark, markup, lambda p: pg.joboko_facts(p, pg.FACT_LABELS)["kinh_nghiem"]) == "2 năm"
    assert value(spark, markup, lambda p: pg.joboko_facts(p, pg.FACT_LABELS)["cap_bac"]) == ""


def test_company_place_size_deadline(spark):
    markup = '<div class="nw-company-hero__address">Địa điểm làm việc: Hà Nội .</div>'
    assert value(spark, markup, pg.joboko_place) == "Hà Nội"
    assert value(spark, markup, pg.joboko_company) == ""
    sizes = {
        '<h4>Quy mô công ty</h4><div class="nw-job-detail__text">50</div>': "50",
        '<div><h4>Quy mô công ty</h4></div><p><i class="nw-job-detail__text">60</i></p>': "60",
        '<div><b>Quy mô công ty</b> <p class="xnw-job-detail__text">70</p></div>': "70",
        "<p>Quy mô công ty : 80 người</p>": "80 người",
        "<p>khác</p>": "",
    }
    for html, want in sizes.items():
        assert value(spark, html, pg.joboko_company_size) == want
    deadlines = {
        '<div class="mt-1 fz-16">Hạn nộp: 18/11/2025</div>': "18/11/2025",
        "<p>hạn nộp : 1/2/2025</p>": "1/2/2025",
        "<div><b>Hạn nộp</b><i>3/4/2025</i></div>": "3/4/2025",
        "<p>khác</p>": "",
    }
    for html, want in deadlines.items():
        assert value(spark, html, pg.joboko_deadline) == want


def test_joboko_links(spark):
    href = '<a href="{}"> {} </a>'
    fallback = href.format("/viec-lam-a-xvi1", "A") + href.format("viec-lam-a-xvi1", "không") + href.format("https://vn.joboko.com/viec-lam-a-xvi1", "lặp") + href.format("/viec-lam-b-xvix", "sai")
    rows = pg.joboko_links(page(spark, fallback)).collect()
    assert [(r["link"], r["title"]) for r in rows] == [("https://vn.joboko.com/viec-lam-a-xvi1", "A")]


def test_joboko_details_keeps_rows_without_page(spark):
    links = spark.createDataFrame([(1, "A", "u"), (2, "B", ""), (3, None, "gone")], "stt int, ten string, link string")
    stored = spark.createDataFrame([("u", '<div class="nw-company-hero__info"><h2><a>CT</a></h2></div>')], "url string, html string")
    rows = {r["stt"]: r for r in pg.joboko_details(links, stored).collect()}
    assert (rows[1]["ten_cong_ty"], rows[2]["ten_cong_ty"], rows[3]["ten_cong_viec"]) == ("CT", "", "")
    assert pg.joboko_details(links, stored, strict=True).count() == 1


def test_topcv_details(spark):
    box = "job-detail__info--section"
    markup = (
        f'<h1> Kỹ sư </h1><div class="{box}"><div class="{box}-content-title">MỨC LƯƠNG</div><div class="{box}-content-value">10  triệu</div></div>'
        f'<div class="{box}"><div class="{box}-content-title">Địa điểm</div>Hà Nội</div>'
        '<div class="job-detail__information-detail--actions-label">Hạn nộp hồ sơ: mai</div>'
        '<div class="job-description"><div class="job-description__item"><h3>Quyền lợi</h3><div class="job-description__item--content">cũ</div></div>'
        '<div class="job-description__item"><h3>Quyền lợi</h3><div class="job-description__item--content">mới</div></div></div>'
        '<a href="https://www.topcv.vn/cong-ty/x">ct</a>'
    )
    row = pg.topcv_jobs(page(spark, markup)).first()
    assert (row["detail_title"], row["detail_salary"], row["detail_location"]) == ("Kỹ sư", "10 triệu", "Địa điểm Hà Nội")
    assert (row["deadline"], row["desc_quyenloi"], row["tags"], row["working_times"]) == ("Hạn nộp hồ sơ: mai", "mới", None, None)
    assert row["company_url_from_job"] == "https://www.topcv.vn/cong-ty/x"


def test_topcv_company(spark):
    markup = (
        '<meta property="og:title" content="Công ty A | TopCV - tuyển"><div class="company-detail"><div class="row"><b>Trang web:</b> a.vn</div>'
        '<p class="item">Quy mô： 10-20</p><li>Ngành: IT</li><li>Ngành: Bán lẻ</li><li>không nhãn</li></div><div class="description"></div>'
        '<section class="company-description">Mô tả</section>'
    )
    row = pg.topcv_companies(page(spark, markup)).first()
    assert tuple(row)[1:] == ("Công ty A", "a.vn", "10-20", "Bán lẻ", None, "Mô tả")
    assert tuple(pg.topcv_companies(page(spark, "<p>x</p>")).first())[1:] == (None,) * 6


def test_careerlink_contact_is_opt_in(spark):
    markup = (
        '<h1 class="job-title mb-0">Kế\ntoán</h1><div id="section-job-contact-information"><ul class="list-unstyled contact-person">'
        "<li> An </li><li>0123</li></ul></div>"
    )
    assert "thông tin liên hệ" not in pg.careerlink_details(page(spark, markup)).columns
    row = pg.careerlink_details(page(spark, markup), contact=True).first()
    assert row["thông tin liên hệ"] == ["An", "0123"] and row["tên công việc"] == "Kếtoán" and row["Mức lương"] is None


def test_plain_text_equals_parsed_text(spark):
    markup = "<html><style>p{}</style><body><p>a<b>b</b> c</p><ul><li>d</li></ul><!-- x --></body></html>"
    got = spark.createDataFrame([(markup,)], "html string").select(plain_text("html")).first()[0]
    assert got == value(spark, markup, lambda p: p.all_text()) == "a b c d"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filtered_pages_are_parsed_once(spark):
    """the filter on the title was copied below the step that deals the pages, with a parse of its own."""
    rows = spark.createDataFrame([(1, '<h1 class="job-title mb-0">A</h1>'), (2, "<p>x</p>")], "url int, html string")
    details = pg.careerlink_details(pg.parsed(rows.repartition(4)))
    assert _plan(details).count("ArrowEvalPython") == 1
    assert [(r["url"], r["tên công việc"]) for r in details.collect()] == [(1, "A")]


def test_rows_of_one_file_are_dealt_to_many_tasks(spark, tmp_path):
    """one row group was read, rendered and parsed by one task."""
    columns = "id AS p_partkey, 'ring' AS p_name, 'Brand#1' AS p_brand, 'SMALL' AS p_type, 7 AS p_size"
    spark.range(100).selectExpr(*columns.split(", ")).coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    for rows in (page_queries._listing_pages(spark, str(tmp_path)), postings(spark, str(tmp_path))):
        tasks = rows.groupBy(F.spark_partition_id().alias("task")).count().collect()
        assert len(tasks) > 8 and max(t["count"] for t in tasks) < 20


def test_an_element_given_as_expression_is_found_once(spark):
    """the element was looked for again at every text it was compared with."""
    pages = page(spark, "<p>a <b>b</b></p><p>c</p>")
    for read in (lambda p, e: p.text(e), lambda p, e: p.raw_text(e), lambda p, e: p.siblings_after(e), lambda p, e: p.next_node(e), lambda p, e: p.parent_of(e)):
        p = Page("page")
        plan = pages.select(read(p, p.first(p.find("p"))).alias("v"))._jdf.queryExecution().analyzed().toString()
        assert plan.count(" = p)") == 1


def test_elements_know_what_lies_below(spark):
    got = page(spark, "<div>a<p>b<br>c</p></div>d<i>e").first()["page"]
    below = {e["tag"]: [x["tag"] for x in got["elements"][e["place"] :][: e["inside"]]] for e in got["elements"]}
    texts = {e["tag"]: "".join(t["text"] for t in got["texts"][e["text_place"] - 1 :][: e["text_count"]]) for e in got["elements"]}
    assert below == {"div": ["p", "br"], "p": ["br"], "br": [], "i": []}
    assert texts == {"div": "abc", "p": "bc", "br": "", "i": "e"}


def test_pages_become_arrow_columns_in_pieces(monkeypatch):
    """the elements of a whole batch were held as Python objects."""
    pages = pa.array(["<p>a", None, "", "<div class='x y'>b</div>c", "<i>d</i>"])
    whole, pieces, ended = html.outlines(pages).to_pylist(), [], html._Outline.arrays
    monkeypatch.setattr(html, "HELD", 1)
    monkeypatch.setattr(html._Outline, "arrays", lambda self: pieces.append(len(self.element_ends) - 1) or ended(self))
    assert html.outlines(pages).to_pylist() == whole
    assert max(pieces) <= 3 and sum(pieces) == 5


def test_topcv_records_are_read_once(spark):
    """choosing one record of an address parsed the posting and company pages twice."""
    parses = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(value):
        parses.add(1)
        return value

    jobs = spark.createDataFrame([("https://a/1", "A", "c"), ("https://a/1", "A", "c")], "job_url string, detail_title string, company_url_from_job string")
    cards = spark.createDataFrame([(1, "https://a/1", "c")], "posting_id int, job_url string, company_url string")
    companies = spark.createDataFrame([("c", "C")], "company_url string, company_name_full string")
    rows = pg.topcv_rows(cards, jobs.withColumn("detail_title", seen("detail_title")), companies.withColumn("company_name_full", seen("company_name_full")), ["posting_id"]).collect()
    assert [(r["stt"], r["detail_title"], r["company_name_full"]) for r in rows] == [(1, "A", "C")]
    assert parses.value == 3


def test_topcv_records_pass_no_broadcast(spark, monkeypatch, tmp_path):
    """records were estimated at the size of the table their pages came from, and sent whole through the driver."""
    plans = []

    def kept(df):
        plans.append(_plan(df))
        return cut_lineage(df)

    def stored(name, rows, schema):
        """Rows of a file, whose size Spark knows."""
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}")
        return spark.read.parquet(f"{tmp_path}/{name}")

    monkeypatch.setattr(pg, "cut_lineage", kept)
    monkeypatch.setattr(ranking, "cut_lineage", kept)
    cards = [(1, "https://a/1?x", "c"), (2, "https://a/1?y", "d"), (3, "https://a/3", "d"), (4, "https://a/4", None), (5, "https://a/5", "gone")]
    jobs = [("https://a/1?x", "A", "e"), ("https://a/1?x", "A", "e"), ("https://a/4", "D", None), (None, "N", "c")]
    companies = [("c", "C"), ("d", "D"), ("d", "D"), ("e", "E"), (None, "N")]
    rows = pg.topcv_rows(
        stored("cards", cards, "posting_id int, job_url string, company_url string"),
        stored("jobs", jobs, "job_url string, detail_title string, company_url_from_job string"),
        stored("companies", companies, "company_url string, company_name_full string"),
        ["posting_id"],
    )
    got = [(r["stt"], r["posting_id"], r["detail_title"], r["company_name_full"]) for r in rows.collect()]
    assert got == [(1, 1, "A", "E"), (2, 3, None, "D"), (3, 4, "D", None), (4, 5, None, None)]
    assert "BroadcastExchange" not in "".join(plans)
    assert sum(plan.count("SortMergeJoin") for plan in plans) == 4
