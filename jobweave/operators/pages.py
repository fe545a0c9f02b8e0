"""Records out of stored web pages of the three sites."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.html import HEADINGS, Page, absolute_url, link_pairs, parse_page, url_path
from ..functions.text import SPACE, let, strip
from ..session import cut_lineage
from .ranking import keep_first, lookup, renumber

# Site addresses, link forms, constants.
HOSTS = {
    "careerlink": "https://www.careerlink.vn",
    "joboko": "https://vn.joboko.com",
    "topcv": "https://www.topcv.vn",
}
JOBOKO_LINK = r"(?iu)/viec-lam-[\p{L}\p{N}_\-]+-xvi[0-9]+"
JOBOKO_INDUSTRY = "IT / Phần mềm / IOT / Điện tử viễn thông"
# Headings that end a section.
SECTION_STOPS = [
    "yêu cầu", "quyền lợi", "quyền lợi được hưởng", "thông tin khác", "địa điểm",
    "cách thức ứng tuyển", "thông tin",
]
# Label words of a posting's fact list.
FACT_LABELS = {
    "muc_luong": ["Thu nhập", "Mức lương", "Lương"],
    "kinh_nghiem": ["Kinh nghiệm"],
    "loai_cong_viec": ["Loại hình"],
    "cap_bac": ["Chức vụ", "Cấp bậc"],
}


def _has(text: Column, needle: str) -> Column:
    return F.contains(F.lower(text), F.lit(needle.lower()))


def _has_any(text: Column, needles: list[str]) -> Column:
    return F.lower(text).rlike("|".join(re.escape(needle.lower()) for needle in needles))


def _with(items: Column, field: str, value: str, first: bool = False) -> Column:
    """The last (or first) item whose field has this value."""
    return F.try_element_at(F.filter(items, lambda i: i[field] == value), F.lit(1 if first else -1))


def _filled(text: Column) -> Column:
    """Null instead of an empty text."""
    return F.nullif(text, F.lit(""))


def _first_filled(values: Column) -> Column:
    return F.get(F.filter(values, lambda v: v.isNotNull() & (v != "")), F.lit(0))


def parsed(pages: DataFrame, html: str = "html", name: str = "page") -> DataFrame:
    return pages.withColumn(name, parse_page(html)).drop(html)


# --- links ------------------------------------------------------------------------------------------------------------


def _unique_links(anchors: Column, host: str) -> Column:
    """``href, title`` structs with absolute addresses, first occurrence per page; no shuffle is needed."""
    links = F.transform(
        anchors, lambda a: F.struct(absolute_url(a["href"], host).alias("link"), a["title"].alias("title"))
    )

    def first_only(found: Column) -> Column:
        addresses = F.transform(found, lambda l: l["link"])
        return let(
            addresses, lambda names: F.filter(found, lambda l, i: F.array_position(names, l["link"]) == i + 1)
        )

    return let(links, first_only)


def listing_links(pages: DataFrame, url: str, html: str, pattern: str, host: str) -> DataFrame:
    """``url, position, link, title``: matching links of each listing page, first occurrence per page."""
    links = _unique_links(link_pairs(html, pattern), host)
    return pages.select(url, F.posexplode(links).alias("position", "a")).select(url, "position", "a.*")


def joboko_links(pages: DataFrame, url: str = "url") -> DataFrame:
    """Links of the result list, or of any posting address when the list is missing."""
    page = Page("page")
    listed = page.find("div.nw-job-list__list", ".item", ".item-head", ".item-title", "a")
    anywhere = F.filter(
        page.find("a"), lambda a: F.contains(a["href"], F.lit("/viec-lam-")) & F.contains(a["href"], F.lit("-xvi"))
    )
    anchors = let(listed, lambda l: F.when(F.size(l) > 0, l).otherwise(anywhere))
    titled = F.transform(
        anchors, lambda a: F.struct(strip(a["href"]).alias("href"), page.text(a, "", collapse=False).alias("title"))
    )
    postings = F.filter(titled, lambda a: a["href"].rlike(JOBOKO_LINK))
    rows = pages.select(url, F.posexplode(_unique_links(postings, HOSTS["joboko"])).alias("position", "a"))
    return rows.select(url, "position", "a.*")


def careerlink_links(pages: DataFrame, url: str = "url") -> DataFrame:
    anchors = Page("page").find("a.job-link.clickable-outside")
    rows = pages.select(url, F.posexplode(anchors).alias("position", "a"))
    return rows.select(url, "position", F.col("a.href").alias("link"))


def numbered_links(links: DataFrame, order: list[str]) -> DataFrame:
    """All listing pages together: each link once, numbered in order of appearance."""
    return renumber(keep_first(links, ["link"], order), *order)


# --- joboko detail ------------------------------------------------------------------------------------------------------


def _following_text(page: Page, heading: Column) -> Column:
    """Blocks after a heading up to the next stop heading, one per line."""

    def body(siblings: Column) -> Column:
        stops = F.filter(
            siblings, lambda s: s["tag"].isin(*HEADINGS) & _has_any(page.text(s), SECTION_STOPS)
        )
        limit = F.coalesce(F.get(stops, F.lit(0))["node"], F.lit(2**31 - 1))
        blocks = F.filter(siblings, lambda s: s["tag"].isin("p", "div", "ul", "ol") & (s["node"] < limit))
        return strip(F.array_join(F.array_remove(F.transform(blocks, lambda e: page.text(e)), ""), "\n"))

    return let(page.siblings_after(heading), body)


def _scoped(page: Page, selector: str) -> Column:
    """Matches in the main block, or in the page when it has none."""
    return let(
        page.first(page.find(".nw-job-list__main")),
        lambda main: F.when(main.isNotNull(), page.find(selector, inside=main)).otherwise(page.find(selector)),
    )


def joboko_description(page: Page) -> Column:
    titled = F.filter(
        _scoped(page, ",".join(HEADINGS)),
        lambda h: let(page.text(h), lambda t: _has(t, "Mô tả công việc") | (F.lower(t) == "mô tả")),
    )
    sections = F.transform(titled, lambda h: _following_text(page, h))
    block = let(page.first(_scoped(page, ".nw-wysiwyg")), lambda e: page.text(e))
    return F.coalesce(_first_filled(sections), block, F.lit(""))


def joboko_requirements(page: Page) -> Column:
    def about(tags: str) -> Column:
        return F.filter(_scoped(page, tags), lambda h: _has(page.text(h), "Yêu cầu"))

    def first_section(h: Column) -> Column:
        block = F.get(F.filter(page.siblings_after(h), lambda s: F.array_contains(s["classes"], "job-requirement")), F.lit(0))
        return let(
            block,
            lambda b: F.when(b.isNotNull(), page.text(b)).otherwise(F.nullif(_following_text(page, h), F.lit(""))),
        )

    first = let(page.first(about("h3")), lambda h: F.when(h.isNotNull(), first_section(h)))
    rest = _first_filled(F.transform(about(",".join(HEADINGS)), lambda h: _following_text(page, h)))
    return F.coalesce(first, rest, F.lit(""))


def joboko_facts(page: Page, labels: dict[str, list[str]]) -> Column:
    """Per field the bold value of the first fact whose label holds one of its words, else the label itself.

    The facts are read once for all fields.
    """
    items = page.find(".nw-job-list__main", ".block-entry", ".item")
    facts = F.transform(
        items,
        lambda item: F.struct(
            page.first_text(".item-content", inside=item).alias("label"),
            F.nullif(page.first_text(".fw-bold", inside=item, separator=""), F.lit("")).alias("value"),
        ),
    )

    def first(found: Column, words: list[str]) -> Column:
        def pick(fact: Column) -> Column:
            result = F.lit(None).cast("string")
            for word in reversed(words):
                bare = strip(F.replace(fact["label"], F.lit(f"{word}:"), F.lit("")))
                result = F.when(_has(fact["label"], word), F.coalesce(fact["value"], bare)).otherwise(result)
            return result

        hits = F.filter(F.transform(found, pick), lambda v: v.isNotNull())
        return F.coalesce(F.get(hits, F.lit(0)), F.lit(""))

    return let(facts, lambda found: F.struct(*[first(found, words).alias(name) for name, words in labels.items()]))


def joboko_company(page: Page) -> Column:
    return F.coalesce(page.first_text(".nw-company-hero__info", "h2", "a", separator=""), F.lit(""))


def joboko_place(page: Page) -> Column:
    address = page.first(page.find(".nw-company-hero__address"))

    def read(e: Column) -> Column:
        linked = F.nullif(page.first_text("a", inside=e, separator=""), F.lit(""))
        text = F.regexp_replace(F.coalesce(linked, page.text(e)), rf"(?iu)^địa điểm làm việc:[{SPACE}]*", "")
        return F.regexp_replace(text, "^[ .]+|[ .]+$", "")

    return F.coalesce(let(address, read), F.lit(""))


def joboko_company_size(page: Page) -> Column:
    holder = "nw-job-detail__text"
    heads = F.filter(
        page.find(".nw-job-detail__heading,h2,h3,h4,strong,b,span"), lambda h: _has(page.text(h), "Quy mô công ty")
    )

    def near(sibling: Column) -> Column:
        own = F.array_contains(sibling["classes"], holder)
        return F.when(own, page.text(sibling)).otherwise(page.first_text(f".{holder}", inside=sibling))

    def size(h: Column) -> Column:
        parent = page.parent_of(h)
        inside = let(
            parent,
            lambda p: page.text(
                page.first(
                    F.filter(
                        page.elements,
                        lambda e: page.below(e, p) & F.exists(e["classes"], lambda c: F.contains(c, F.lit(holder))),
                    )
                )
            ),
        )
        candidates = F.array(
            let(page.next_node(h), near), let(parent, lambda p: let(page.next_node(p), near)), inside
        )
        return _first_filled(candidates)

    fallback = F.nullif(
        strip(F.regexp_extract(page.all_text(), rf"(?iu)Quy mô công ty[{SPACE}]*:?[{SPACE}]*([^\n]+)", 1)), F.lit("")
    )
    return F.coalesce(_first_filled(F.transform(heads, size)), fallback, F.lit(""))


def _after_colon(text: Column) -> Column:
    return strip(F.regexp_replace(text, "(?s)^[^:]*:", ""))


def joboko_deadline(page: Page) -> Column:
    boxes = F.filter(page.find("div.mt-1.fz-16"), lambda e: F.contains(page.text(e), F.lit("Hạn nộp")))
    boxed = let(page.first(boxes), lambda e: F.when(e.isNotNull(), _after_colon(page.text(e))))

    def mentioned(t: Column) -> Column:
        owner = page.first(F.filter(page.elements, lambda e: e["node"] == t["parent"]))
        full = page.text(owner)
        after = F.nullif(page.text(page.first(page.siblings_after(owner))), F.lit(""))
        return F.when(F.contains(full, F.lit(":")), _after_colon(full)).otherwise(after)

    mentions = F.transform(F.filter(page.texts, lambda t: _has(t["text"], "Hạn nộp")), mentioned)
    return F.coalesce(boxed, F.get(F.filter(mentions, lambda m: m.isNotNull()), F.lit(0)), F.lit(""))


def one_per_address(rows: DataFrame, address: str, order: list[Column | str] | None = None) -> DataFrame:
    """The first row of each address in ``order``, by content where none is given; a null address is kept out.

    The winner is chosen on the order and a hash of the row, so whole pages are neither sorted nor compared; a
    hot address shrinks to one narrow row a task.  What wins is dealt evenly for the parsing that follows.

    Sizes are estimated from the columns that were read, a fraction of the rows made of them, so the join is named: one
    chosen by such a size sends an address of every row through the driver.
    """
    place = F.struct(*(order or []), F.xxhash64(*sorted(rows.columns)))
    known = rows.filter(F.col(address).isNotNull()).withColumn("_place", place)
    first = known.groupBy(F.col(address).alias("_address")).agg(F.min("_place").alias("_first")).hint("merge")
    won = known.join(first, (F.col(address) == F.col("_address")) & (F.col("_place") == F.col("_first")), "left_semi")
    spark = rows.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # rows that are equal throughout are one; the others have addresses of their own
    return won.drop("_place").repartition(tasks, address).dropDuplicates([address])


def joboko_details(
    links: DataFrame, pages: DataFrame, strict: bool = False, order: list[Column | str] | None = None
) -> DataFrame:
    """The 14-field record of each listed posting.

    A page stored several times counts once: the first in ``order`` (such as the crawl time).

    A posting without a link or page keeps its row with blank fields; with
    ``strict`` it is left out.
    """
    page = Page("page")
    fields = {
        "ten_cong_ty": joboko_company(page),
        "dia_diem_lam_viec": joboko_place(page),
        "mo_ta_chi_tiet": joboko_description(page),
        "ki_nang_yeu_cau": joboko_requirements(page),
        "quy_mo": joboko_company_size(page),
        "han_nop": joboko_deadline(page),
        "facts": joboko_facts(page, FACT_LABELS),
    }
    read = parsed(one_per_address(pages, "url", order)).select(F.col("url").alias("link"), *[f.alias(n) for n, f in fields.items()])
    facts = read.select("*", "facts.*").drop("facts")
    # rows without a link have no page, so they need not meet in one task
    has_link = F.coalesce(F.col("link"), F.lit("")) != ""
    rows = links.filter(has_link).join(facts, "link", "inner" if strict else "left")
    if not strict:
        rows = rows.unionByName(links.filter(~has_link), allowMissingColumns=True)
    blank = lambda name: F.coalesce(F.col(name), F.lit("")).alias(name)
    return rows.select(
        "stt",
        F.coalesce("ten", F.lit("")).alias("ten_cong_viec"),
        *[
            blank(n)
            for n in (
                "ten_cong_ty", "dia_diem_lam_viec", "muc_luong", "kinh_nghiem", "mo_ta_chi_tiet",
                "ki_nang_yeu_cau", "loai_cong_viec", "cap_bac", "quy_mo", "han_nop",
            )
        ],
        F.lit(JOBOKO_INDUSTRY).alias("nganh_nghe"),
        blank("link"),
    )


# --- topcv --------------------------------------------------------------------------------------------------------------


def topcv_results(pages: DataFrame, url: str = "url") -> DataFrame:
    """One row per card of a search page."""
    page, host = Page("page"), HOSTS["topcv"]

    def card(e: Column) -> Column:
        title = page.first(page.find("h3.title", "a[href]", inside=e))
        company_link = page.first(page.find("a.company[href]", inside=e))
        return F.struct(
            _filled(page.text(title)).alias("title"),
            absolute_url(title["href"], host).alias("job_url"),
            _filled(page.first_text("a.company", ".company-name", inside=e)).alias("company"),
            F.when(company_link.isNotNull(), absolute_url(company_link["href"], host)).alias("company_url"),
            _filled(page.first_text("label.title-salary", inside=e)).alias("salary_list"),
            _filled(page.first_text("label.address", ".city-text", inside=e)).alias("address_list"),
            _filled(page.first_text("label.exp", "span", inside=e)).alias("exp_list"),
        )

    cards = F.transform(page.find("div.job-item-search-result"), card)
    rows = pages.select(url, F.posexplode(cards).alias("position", "card"))
    return rows.select(url, "position", "card.*").filter(F.col("job_url").isNotNull())


# Titles of a posting page's fact boxes, sections and lists, and the column each fills.
JOB_FACTS = {"detail_salary": "Mức lương", "detail_location": "Địa điểm", "detail_experience": "Kinh nghiệm"}
JOB_SECTIONS = {"desc_mota": "Mô tả công việc", "desc_yeucau": "Yêu cầu ứng viên", "desc_quyenloi": "Quyền lợi"}
JOB_LISTS = {"working_addresses": "Địa điểm làm việc", "working_times": "Thời gian làm việc"}


def topcv_facts(page: Page, titles: dict[str, str]) -> Column:
    """Per field the value of the first fact box with its title.  The boxes are read once for all fields."""
    box = ".job-detail__info--section"
    facts = F.transform(
        page.find(box),
        lambda s: F.struct(
            F.lower(F.coalesce(page.first_text(f"{box}-content-title", inside=s), F.lit(""))).alias("title"),
            F.coalesce(page.first_text(f"{box}-content-value", inside=s), page.text(s)).alias("value"),
        ),
    )

    def first(found: Column, title: str) -> Column:
        return F.nullif(F.get(F.filter(found, lambda f: f["title"] == title.lower()), F.lit(0))["value"], F.lit(""))

    return let(facts, lambda found: F.struct(*[first(found, title).alias(name) for name, title in titles.items()]))


def topcv_deadline(page: Page) -> Column:
    texts = F.transform(
        page.find(".job-detail__info--deadline,.job-detail__information-detail--actions-label"), lambda e: page.text(e)
    )
    hit = F.get(F.filter(texts, lambda t: F.contains(t, F.lit("Hạn nộp"))), F.lit(0))
    date = F.nullif(F.regexp_extract(hit, "([0-9]{1,2}/[0-9]{1,2}/[0-9]{4})", 1), F.lit(""))
    return F.coalesce(date, hit)


def _joined(values: Column) -> Column:
    return F.nullif(F.array_join(F.array_remove(values, ""), "; "), F.lit(""))


def topcv_sections(page: Page, titles: dict[str, str]) -> Column:
    """Per field the text of the last description block with its heading.  The blocks are read once for all fields."""
    blocks = F.transform(
        page.find(".job-description", ".job-description__item"),
        lambda e: F.struct(
            F.coalesce(page.first_text("h3", inside=e), F.lit("")).alias("heading"),
            page.first_text(".job-description__item--content", inside=e).alias("body"),
        ),
    )

    def last(found: Column, title: str) -> Column:
        bodies = F.filter(found, lambda b: (b["heading"] == title) & b["body"].isNotNull())
        return F.nullif(F.try_element_at(bodies, F.lit(-1))["body"], F.lit(""))

    return let(blocks, lambda found: F.struct(*[last(found, title).alias(name) for name, title in titles.items()]))


def topcv_lists(page: Page, titles: dict[str, str]) -> Column:
    """Per field the entries of the blocks whose heading holds its words, joined by semicolons."""
    blocks = F.transform(
        page.find(".job-description__item"),
        lambda e: F.struct(
            e.alias("element"), F.transform(page.find("h3", inside=e), lambda h: page.text(h)).alias("headings")
        ),
    )

    def entries(found: Column, title: str) -> Column:
        titled = F.filter(found, lambda b: F.exists(b["headings"], lambda h: F.contains(h, F.lit(title))))
        return _joined(F.flatten(F.transform(titled, lambda b: content(b["element"]))))

    def content(e: Column) -> Column:
        return F.transform(page.find(".job-description__item--content", "div,li", inside=e), lambda d: page.text(d))

    return let(blocks, lambda found: F.struct(*[entries(found, title).alias(name) for name, title in titles.items()]))


def topcv_company_link(page: Page) -> Column:
    named = page.first(page.find("a.company[href]"))
    other = page.first(F.filter(page.find("a[href]"), lambda a: F.contains(a["href"], F.lit("/cong-ty/"))))
    return let(F.coalesce(named, other), lambda a: F.when(a.isNotNull(), absolute_url(a["href"], HOSTS["topcv"])))


def topcv_jobs(pages: DataFrame, url: str = "url") -> DataFrame:
    """Detail record of a posting page."""
    page = Page("page")
    read = pages.select(
        F.col(url).alias("job_url"),
        _filled(page.first_text(".job-detail__info--title,h1")).alias("detail_title"),
        topcv_facts(page, JOB_FACTS).alias("facts"),
        topcv_deadline(page).alias("deadline"),
        _joined(F.transform(page.find(".job-tags", "a.item"), lambda a: page.text(a))).alias("tags"),
        topcv_sections(page, JOB_SECTIONS).alias("sections"),
        topcv_lists(page, JOB_LISTS).alias("lists"),
        topcv_company_link(page).alias("company_url_from_job"),
    )
    return read.select(
        "job_url", "detail_title", "facts.*", "deadline", "tags", "sections.*", "lists.*", "company_url_from_job"
    )


# Where a company page may keep its name, facts and description, best first.
COMPANY_NAMES = ["h1.company-name", "h1.title", "div.company-header h1", "div.company-info h1"]
COMPANY_META = ["og:title", "og:site_name"]
COMPANY_BOXES = [
    "div.company-overview", "div.company-detail", "div.company-profile", "section#company",
    "section.company-info", "div.box-intro-company", "div.company-info-container",
]
COMPANY_TEXTS = [
    "div.company-description", "div#company-description", "div.box-intro-company", "div.company-introduction",
    "div.description", "section.company-description", "div#readmore-company", "div#readmore-content",
]
COMPANY_FACTS = {
    "company_website": ["website", "trang web"],
    "company_size": ["quy mô", "size", "nhân sự"],
    "company_industry": ["lĩnh vực", "industry", "ngành"],
    "company_address": ["địa chỉ", "address"],
}


def topcv_companies(pages: DataFrame, url: str = "url") -> DataFrame:
    """Company record: name, website, size, industry, address, description."""
    page = Page("page")
    names = [page.first_text(*css.split(" ")) for css in COMPANY_NAMES]
    names += [_with(page.find("meta"), "property", p, first=True)["content"] for p in COMPANY_META]
    names.append(page.first_text("title"))
    name = F.regexp_replace(_first_filled(F.array(*names)), rf"(?iu)[{SPACE}]*\|[{SPACE}]*TopCV.*$", "")

    def fact(row: Column) -> Column:
        """``struct<label,value>`` of one line."""
        text = page.text(row)
        bold = page.first_text("strong,b", inside=row)
        edge = r" :\-–—"
        rest = F.regexp_replace(
            F.regexp_replace(text, F.concat(F.lit(r"(?iu)\Q"), bold, F.lit(r"\E")), F.lit("")), f"^[{edge}]+|[{edge}]+$", ""
        )
        split = r"^([^:：]+)[:：]\s*(.+)$"
        label = F.when(bold.isNotNull(), bold).otherwise(strip(F.regexp_extract(text, split, 1)))
        value = F.when(bold.isNotNull(), rest).otherwise(strip(F.regexp_extract(text, split, 2)))
        return F.struct(F.lower(label).alias("label"), value.alias("value"))

    rows = "li,.row,.item,.info-item,.company-info-item,.dl,.d-flex"
    boxes = F.coalesce(*[page.first(page.find(css)) for css in COMPANY_BOXES])
    lines = let(boxes, lambda b: F.when(b.isNotNull(), page.find(rows, inside=b)).otherwise(page.find(rows)))
    facts = F.filter(F.transform(lines, fact), lambda f: (f["label"] != "") & (f["value"] != ""))

    def kind(f: Column) -> Column:
        result = F.lit(None).cast("string")
        for field, words in reversed(COMPANY_FACTS.items()):
            result = F.when(_has_any(f["label"], words), F.lit(field)).otherwise(result)
        return result

    kinds = pages.select(
        F.col(url).alias("company_url"),
        name.alias("company_name_full"),
        F.transform(facts, lambda f: F.struct(kind(f).alias("kind"), f["value"].alias("value"))).alias("_facts"),
        _first_filled(F.array(*[page.first_text(css) for css in COMPANY_TEXTS])).alias("company_description"),
    )
    last = {field: _with(F.col("_facts"), "kind", field)["value"] for field in COMPANY_FACTS}
    return kinds.select("company_url", "company_name_full", *[v.alias(k) for k, v in last.items()], "company_description")


def topcv_rows(cards: DataFrame, jobs: DataFrame, companies: DataFrame, order: list[str]) -> DataFrame:
    """Search card, posting page and company page in one numbered row per posting.

    A posting is known by the path of its address; pages that are missing leave
    nulls, and of pages stored several times one counts.
    """
    # the records are read twice to choose one of an address, which must not parse their pages twice
    jobs, companies = cut_lineage(jobs), cut_lineage(companies.withColumnRenamed("company_url", "_company"))
    first = keep_first(cards, [url_path("job_url")], order)
    # records are joined by sorting, for their estimated size is that of the table the pages came from
    rows = first.join(one_per_address(jobs, "job_url").hint("merge"), "job_url", "left")
    rows = rows.withColumn("_company", F.coalesce("company_url_from_job", "company_url"))
    found = cut_lineage(one_per_address(companies, "_company"))
    return renumber(lookup(cut_lineage(rows), found.hint("merge"), ["_company"]).drop("_company"), *order)


# --- careerlink ---------------------------------------------------------------------------------------------------------

# Summary labels and the column each fills, tried in this order.
SUMMARY_LABELS = {
    "Loại công việc": "loại công việc",
    "Cấp bậc": "cấp bậc",
    "Học vấn": "học vấn",
    "Giới tính": "giới tính",
    "Tuổi": "tuổi",
    "Ngành nghề": "ngành nghề",
}


def careerlink_details(pages: DataFrame, url: str = "url", contact: bool = False) -> DataFrame:
    """Detail record; pages without a posting title are dropped.

    Contact lines are personal data and stay out unless asked for.
    """
    page = Page("page")

    def plain(text: Column) -> Column:
        return F.replace(text, F.lit("\n"), F.lit(""))

    def section(name: str) -> Column:
        box = page.first(page.find(f"#{name}"))
        return let(box, lambda b: plain(page.first_text("div.rich-text-content", inside=b, separator="", collapse=False)))

    icon = page.first(page.find("i.cli-suitcase-simple"))
    years = let(
        icon,
        lambda i: page.text(page.first(F.filter(page.siblings_after(i), lambda s: s["tag"] == "span")), "", collapse=False),
    )
    labels = page.find("div.row.job-summary.d-flex", "div.my-0.summary-label")

    def kind_of(text: Column) -> Column:
        kind = F.lit(None).cast("string")
        for words, name in reversed(SUMMARY_LABELS.items()):
            kind = F.when(F.contains(text, F.lit(words)), F.lit(name)).otherwise(kind)
        return kind

    def fact(label: Column) -> Column:
        kind = let(page.raw_text(label), kind_of)
        following = page.first(F.filter(page.siblings_after(label), lambda s: s["tag"] == "div"))
        return F.struct(kind.alias("kind"), page.raw_text(following).alias("value"))

    columns = [
        plain(page.raw_text(page.first(page.find("h1.job-title.mb-0")))).alias("tên công việc"),
        plain(page.raw_text(page.first(page.find("p.org-name.mb-2")))).alias("tên công ty"),
        plain(page.first_text("div#job-location", collapse=False)).alias("Địa điểm công việc"),
        plain(page.first_text("div#job-salary", "span.text-primary", separator="", collapse=False)).alias("Mức lương"),
        plain(years).alias("Kinh nghiệm"),
        section("section-job-description").alias("mô tả công việc"),
        section("section-job-skills").alias("kĩ năng yêu cầu"),
        F.transform(labels, fact).alias("_facts"),
    ]
    if contact:
        lines = page.find("#section-job-contact-information", "ul.list-unstyled", "li")
        columns.append(F.transform(lines, lambda e: page.text(e, "", collapse=False)).alias("thông tin liên hệ"))
    rows = pages.select(url, *columns).filter(F.col("`tên công việc`").isNotNull())
    return rows.withColumns(
        {name: plain(_with(F.col("_facts"), "kind", name)["value"]) for name in SUMMARY_LABELS.values()}
    ).drop("_facts")
