"""Posting-like columns derived from the driver's tables.

The expressions are plain SQL read the same way by Spark and by the checking
database, so that both sides see the same postings.  Only the *input* is
shared; every operator is written twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import deal, spread
from .registry import table

SALARY_FORMS = """CASE {k} % 20
 WHEN 0 THEN 'Thỏa thuận'
 WHEN 1 THEN concat(CAST({n} AS STRING), ' - ', CAST({n} + 7 AS STRING), ' triệu VNĐ')
 WHEN 2 THEN concat('Upto ', CAST({n} AS STRING), ' triệu VND')
 WHEN 3 THEN concat('Từ ', CAST({n} AS STRING), ',000 USD')
 WHEN 4 THEN concat(CAST({n} AS STRING), '.000.000 VND')
 WHEN 5 THEN concat('Từ ', CAST({n} AS STRING), ' Triệu - Dưới ', CAST({n} + 5 AS STRING), ' Triệu VNĐ / Tháng')
 WHEN 6 THEN concat(CAST({n} * 20 AS STRING), ' - ', CAST({n} * 25 AS STRING))
 WHEN 7 THEN ''
 WHEN 8 THEN concat('$', CAST({n} * 30 AS STRING), ' - $', CAST({n} * 40 AS STRING))
 WHEN 9 THEN concat('Lên đến ', CAST({n} AS STRING), ' Tr VND')
 WHEN 10 THEN concat(CAST({n} AS STRING), '–', CAST({n} + 3 AS STRING), ' tr')
 WHEN 11 THEN concat('1,', CAST(100 + {n} AS STRING), ' to 2,', CAST(100 + {n} AS STRING), ' usd')
 WHEN 12 THEN concat('lương từ ', CAST({n} AS STRING), ' triệu đồng')
 WHEN 13 THEN concat(CAST({n} AS STRING), ',5 triệu')
 WHEN 14 THEN concat('$', CAST({n} AS STRING), 'K-$', CAST({n} + 20 AS STRING), 'K')
 WHEN 15 THEN concat(CAST({n} AS STRING), '.000.000 - ', CAST({n} + 9 AS STRING), '.000.000')
 WHEN 16 THEN 'Negotiable'
 WHEN 17 THEN concat(CAST({n} AS STRING), ' trình')
 WHEN 18 THEN concat(CAST({n} * 100 AS STRING), 'USD')
 ELSE CAST(NULL AS STRING) END"""

EXPERIENCE_FORMS = """CASE {k} % 13
 WHEN 0 THEN concat(CAST({n} % 12 AS STRING), ' năm')
 WHEN 1 THEN concat(CAST({n} % 6 AS STRING), ' - ', CAST({n} % 17 AS STRING), ' năm')
 WHEN 2 THEN 'Dưới 1 năm'
 WHEN 3 THEN 'Không yêu cầu'
 WHEN 4 THEN ''
 WHEN 5 THEN concat(CAST({n} AS STRING), '+ years of experience')
 WHEN 6 THEN concat(CAST({n} AS STRING), '-', CAST({n} + 3 AS STRING), ' Years')
 WHEN 7 THEN concat('0,', CAST({n} % 9 AS STRING), ' năm')
 WHEN 8 THEN concat('1 năm, ', CAST({n} AS STRING), ' năm kinh nghiệm')
 WHEN 9 THEN concat(CAST({n} % 5 AS STRING), ' đến ', CAST({n} % 5 + 4 AS STRING), ' năm')
 WHEN 10 THEN concat(CAST({n} AS STRING), ' to ', CAST({n} + 2 AS STRING), ' years, ', CAST({n} AS STRING), 'n')
 WHEN 11 THEN concat(CAST({n} + 10 AS STRING), ' - ', CAST({n} % 30 + 20 AS STRING), ', ', CAST({n} AS STRING), ' yr')
 ELSE CAST(NULL AS STRING) END"""

LOCATION_FORMS = """CASE {k} % 12
 WHEN 0 THEN 'Thanh Xuân, Hà Nội'
 WHEN 1 THEN 'Quận 1, Hồ Chí Minh'
 WHEN 2 THEN 'Toàn Quốc'
 WHEN 3 THEN 'Đà Nẵng'
 WHEN 4 THEN '  Hải Châu ,  Đà Nẵng '
 WHEN 5 THEN 'Côn Đảo, Bà Rịa-Vũng Tàu'
 WHEN 6 THEN 'Thừa Thiên - Huế'
 WHEN 7 THEN 'Thủ Đức, TP, Hồ Chí Minh'
 WHEN 8 THEN ''
 WHEN 9 THEN CAST(NULL AS STRING)
 WHEN 10 THEN concat({a}, ', ', {b})
 ELSE 'BÌNH DƯƠNG' END"""

SKILL_FORMS = """CASE {k} % 10
 WHEN 0 THEN concat('Tiếng Anh tốt, thành thạo Java, Spring và Git; ', {a})
 WHEN 1 THEN 'Python, Django, Machine Learning, phân tích dữ liệu'
 WHEN 2 THEN 'English, TIẾNG NHẬT, Japan N2; kiểm thử, Black Box, tester'
 WHEN 3 THEN 'ReactJS, NodeJS, CSS, ASP.NET, SQL Server, internet'
 WHEN 4 THEN concat('Excel, Word, Office, Photoshop ', {b})
 WHEN 5 THEN 'Tốt nghiệp Cao đẳng, Cử nhân hoặc Kỹ sư; Linux, mạng máy tính, router'
 WHEN 6 THEN 'MVC, Microservice, Docker, Kubernetes, AWS, CI/CD, DevOps'
 WHEN 7 THEN ''
 WHEN 8 THEN CAST(NULL AS STRING)
 ELSE 'C# , C++, PL/SQL, Proooc, BrSE, IT Support, tiếng trung' END"""

SCHEDULE_FORMS = """CASE {k} % 12
 WHEN 0 THEN 'Thứ 2 - Thứ 6 (từ 08:00 đến 17:30)'
 WHEN 1 THEN 'Thứ 2, Thứ 4'
 WHEN 2 THEN concat('Làm ', CAST({n} % 12 AS STRING), ' giờ mỗi ngày')
 WHEN 3 THEN 'Full time'
 WHEN 4 THEN 'Bán  thời gian'
 WHEN 5 THEN 'Toàn thời gian; Làm tại nhà'
 WHEN 6 THEN concat('Thứ ', CAST({n} % 3 + 2 AS STRING), ' - Thứ 7, 8:00 - 12:00, 13:30 - 17:00')
 WHEN 7 THEN 'Thứ 2, thứ 3, thứ 4, Chủ Nhật, 9:00 - 12:30'
 WHEN 8 THEN '2 thứ 7/tháng, thứ 2'
 WHEN 9 THEN ''
 WHEN 10 THEN CAST(NULL AS STRING)
 ELSE 'Linh hoạt' END"""

_PART = {"k": "p_partkey", "n": "p_size", "a": "p_type", "b": "p_brand"}

# alias -> expression over ``part``
POSTING = {
    "posting_id": "p_partkey",
    "source": "CASE p_partkey % 3 WHEN 0 THEN 'careerlink' WHEN 1 THEN 'joboko' ELSE 'topcv' END",
    "title": "concat(' ', upper(p_name), '  #', p_type, '! ')",
    "company": "CASE p_partkey % 7 WHEN 0 THEN '' WHEN 1 THEN CAST(NULL AS STRING) "
    "ELSE concat('Công ty TNHH ', p_brand, ' (', p_name, ')') END",
    "location": LOCATION_FORMS.format(**_PART),
    "salary_text": SALARY_FORMS.format(**_PART),
    "experience_text": EXPERIENCE_FORMS.format(**_PART),
    "description": "concat('Tuyển ', p_name, ' làm việc với ', p_type, ', ', p_brand, ' mỗi ngày')",
    "skills": SKILL_FORMS.format(**_PART),
    "schedule": SCHEDULE_FORMS.format(**_PART),
    "industry": "CASE p_partkey % 4 WHEN 0 THEN 'CNTT - Phần mềm' WHEN 1 THEN 'cntt - phần cứng / mạng; CNTT - Phần mềm' "
    "WHEN 2 THEN p_type ELSE CAST(NULL AS STRING) END",
    "job_type": "CASE p_partkey % 3 WHEN 0 THEN 'Nhân viên toàn thời gian' ELSE p_type END",
    "job_level": "CASE p_partkey % 5 WHEN 0 THEN 'Quản lý' WHEN 1 THEN CAST(NULL AS STRING) ELSE 'Nhân viên' END",
    "education": "CASE p_partkey % 4 WHEN 0 THEN 'Cử nhân' WHEN 1 THEN 'cao đẳng / TRUNG CẤP' WHEN 2 THEN '' "
    "ELSE CAST(NULL AS STRING) END",
    "deadline": "concat(CAST(p_partkey % 31 + 1 AS STRING), '/', CAST(p_partkey % 12 + 1 AS STRING), '/2025')",
    "link": "concat('https://jobs.example/viec-lam-', CAST(p_partkey % 997 AS STRING), '-', CAST(p_size AS STRING))",
}

_LINE = {"k": "(l_orderkey + l_linenumber)", "n": "CAST(l_quantity AS INT)", "a": "l_returnflag", "b": "l_linestatus"}

# alias -> expression over ``lineitem``: the same postings at the size of the largest table
LINE_POSTING = {
    "posting_id": "l_orderkey * 10 + l_linenumber",
    "company_id": "l_suppkey",
    "title_id": "l_partkey",
    "location": LOCATION_FORMS.format(**_LINE),
    "salary_text": SALARY_FORMS.format(**_LINE),
    "experience_text": EXPERIENCE_FORMS.format(**_LINE),
    "skills": SKILL_FORMS.format(**_LINE),
}


def _select(columns: dict[str, str], names: tuple[str, ...]) -> list[str]:
    return [f"{columns[n]} AS {n}" for n in (names or columns)]


def postings(spark: SparkSession, sf_dir: str, *names: str) -> DataFrame:
    return deal(table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")).selectExpr(
        *_select(POSTING, names)
    )


def line_postings(spark: SparkSession, sf_dir: str, *names: str) -> DataFrame:
    return spread(table(spark, sf_dir, "lineitem").selectExpr(*_select(LINE_POSTING, names)))


def postings_cte(*names: str) -> str:
    """``postings AS (…)`` for use after WITH in the checking SQL."""
    return f"postings AS (SELECT {', '.join(_select(POSTING, names))} FROM part)"


def line_postings_cte(*names: str) -> str:
    return f"postings AS (SELECT {', '.join(_select(LINE_POSTING, names))} FROM lineitem)"


# Raw columns of each source, taken from the postings.
RAW = {
    "careerlink": {
        "tên công việc": "title", "tên công ty": "company", "Địa điểm công việc": "location",
        "Mức lương": "salary_text", "Kinh nghiệm": "experience_text", "mô tả công việc": "description",
        "kĩ năng yêu cầu": "skills", "loại công việc": "job_type", "cấp bậc": "job_level",
        "học vấn": "education", "ngành nghề": "industry",
    },
    "joboko": {
        "ten_cong_viec": "title", "ten_cong_ty": "company", "dia_diem_lam_viec": "location",
        "muc_luong": "salary_text", "kinh_nghiem": "experience_text", "mo_ta_chi_tiet": "description",
        "ki_nang_yeu_cau": "skills", "loai_cong_viec": "job_type", "cap_bac": "job_level",
        "han_nop": "deadline", "nganh_nghe": "industry", "link": "link",
    },
    "topcv": {
        "tên công việc": "title", "công ty": "company", "địa điểm làm việc": "location",
        "lương": "salary_text", "yêu cầu kinh nghiệm": "experience_text", "mô tả chi tiết": "description",
        "kĩ năng yêu cầu": "skills", "quyền lợi": "industry", "thời gian làm việc": "schedule", "hạn nộp": "deadline",
    },
}


def raw_frames(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The postings as the three raw source tables, in their own column names."""
    rows = postings(spark, sf_dir)
    return {
        source: rows.filter(f"source = '{source}'").selectExpr(
            "posting_id", *[f"{expr} AS `{name}`" for name, expr in columns.items()]
        )
        for source, columns in RAW.items()
    }
