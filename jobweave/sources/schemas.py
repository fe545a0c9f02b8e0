"""Column dialects of the sources and the fixed record schemas."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)


# Raw columns per source.
CAREERLINK = _strings(
    "tên công việc", "tên công ty", "Địa điểm công việc", "Mức lương", "Kinh nghiệm", "mô tả công việc",
    "kĩ năng yêu cầu", "loại công việc", "cấp bậc", "học vấn", "giới tính", "tuổi", "ngành nghề",
).add("thông tin liên hệ", T.ArrayType(T.StringType()))

JOBOKO = T.StructType([T.StructField("stt", T.IntegerType())] + _strings(
    "ten_cong_viec", "ten_cong_ty", "dia_diem_lam_viec", "muc_luong", "kinh_nghiem", "mo_ta_chi_tiet",
    "ki_nang_yeu_cau", "loai_cong_viec", "cap_bac", "quy_mo", "han_nop", "nganh_nghe", "link",
).fields)

TOPCV = T.StructType([T.StructField("stt", T.IntegerType())] + _strings(
    "tên công việc", "công ty", "địa điểm làm việc", "lương", "yêu cầu kinh nghiệm", "mô tả chi tiết",
    "kĩ năng yêu cầu", "quyền lợi", "thời gian làm việc", "hạn nộp",
).fields)

SOURCES = {"careerlink": CAREERLINK, "joboko": JOBOKO, "topcv": TOPCV}

LINK_LIST = T.StructType([T.StructField("stt", T.IntegerType())] + _strings("ten", "link").fields)
LINK_CSV = T.StructType([T.StructField("stt", T.IntegerType())] + _strings("tên việc", "link").fields)

# The standard record.
STANDARD_COLUMNS = [
    "source", "job_title_clean", "company_name", "location_clean", "industry", "job_description",
    "skills", "job_type", "job_level", "education", "salary_text", "experience_text",
]
# Computed by the cleaners but left out of the standard record.
WIDE_COLUMNS = ["city", "state", "country", "salary_min", "salary_max", "experience", "benefits", "company_size", "work_time"]

# Input of the feature job.
FEATURE_INPUT = _strings(
    "source", "job_title_clean", "company_name", "location_clean", "salary_min", "salary_max",
    "job_type", "job_level", "experience", "industry", "skills", "job_description", "education",
    "salary_text", "experience_text",
)

# The typed record.
TYPED_RECORD = T.StructType([
    T.StructField("id", T.IntegerType()),
    T.StructField("source", T.StringType()),
    T.StructField("original_id", T.StringType()),
    T.StructField("job_title", T.StringType()),
    T.StructField("company_name", T.StringType()),
    T.StructField("location", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("salary_min", T.IntegerType()),
    T.StructField("salary_max", T.IntegerType()),
    T.StructField("salary_currency", T.StringType()),
    T.StructField("job_type", T.StringType()),
    T.StructField("industry", T.StringType()),
    T.StructField("sector", T.StringType()),
    T.StructField("skills", T.ArrayType(T.StringType())),
    T.StructField("education_level", T.StringType()),
    T.StructField("experience_years", T.IntegerType()),
    T.StructField("job_description", T.StringType()),
    T.StructField("sentiment_score", T.DoubleType()),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("updated_at", T.TimestampType()),
])

# Labels given to a detail row on export.
EXPORT_LABELS = {
    "stt": "stt",
    "detail_title": "tên công việc",
    "company_name_full": "công ty",
    "detail_location": "địa điểm làm việc",
    "detail_salary": "lương",
    "detail_experience": "yêu cầu kinh nghiệm",
    "desc_mota": "mô tả chi tiết",
    "desc_yeucau": "kĩ năng yêu cầu",
    "desc_quyenloi": "quyền lợi",
    "working_times": "thời gian làm việc",
    "job_level": "cấp bậc",
    "education": "học vấn",
    "deadline": "hạn nộp",
}

# Column order of a joined detail row.
DETAIL_ORDER = [
    "stt", "title", "detail_title", "job_url", "company", "company_name_full", "company_url",
    "company_url_from_job", "salary_list", "detail_salary", "address_list", "detail_location",
    "exp_list", "detail_experience", "deadline", "tags", "working_addresses", "working_times",
    "desc_mota", "desc_yeucau", "desc_quyenloi", "company_website", "company_size",
    "company_industry", "company_address", "company_description",
]
