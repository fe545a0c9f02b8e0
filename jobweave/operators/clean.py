"""Per-source cleaning, standard columns, and combining the sources."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.experience import vietnamese_experience
from ..functions.location import vietnamese_city, vietnamese_province
from ..functions.salary import salary_range_a
from ..functions.text import clean_text
from ..sources.schemas import STANDARD_COLUMNS, WIDE_COLUMNS


@dataclass(frozen=True)
class Dialect:
    """How a source names its columns.  ``blank`` columns are always null."""

    aliases: dict[str, str] = field(default_factory=dict)
    extra_aliases: dict[str, str] = field(default_factory=dict)
    texts: dict[str, str] = field(default_factory=dict)
    location: str = "địa điểm"
    salary: str = "mức lương"
    experience: str = "kinh nghiệm"
    blank: tuple[str, ...] = ("rating",)
    salary_always: bool = True
    benefits: str | None = None
    work_time: str | None = None


# Column names of each source.
DIALECTS = {
    "careerlink": Dialect(
        texts={
            "job_title_clean": "tên công việc",
            "company_name": "tên công ty",
            "industry": "ngành nghề",
            "job_description": "mô tả công việc",
            "job_type": "loại công việc",
            "job_level": "cấp bậc",
            "education": "học vấn",
        },
        location="Địa điểm công việc",
        salary="Mức lương",
        experience="Kinh nghiệm",
        blank=("rating", "company_size"),
        salary_always=False,
    ),
    "joboko": Dialect(
        aliases={
            "ten_cong_viec": "tên công việc",
            "ten_cong_ty": "tên công ty",
            "dia_diem_lam_viec": "địa điểm",
            "muc_luong": "mức lương",
            "kinh_nghiem": "kinh nghiệm",
            "mo_ta_chi_tiet": "mô tả công việc",
            "ki_nang_yeu_cau": "kĩ năng yêu cầu",
            "loai_cong_viec": "loại công việc",
            "cap_bac": "cấp bậc",
            "nganh_nghe": "ngành nghề",
        },
        extra_aliases={"quy_mo": "quy mô công ty"},
        texts={
            "job_title_clean": "tên công việc",
            "company_name": "tên công ty",
            "industry": "ngành nghề",
            "job_description": "mô tả công việc",
            "job_type": "loại công việc",
            "job_level": "cấp bậc",
            "company_size": "quy mô công ty",
        },
        blank=("rating", "education"),
    ),
    "topcv": Dialect(
        aliases={
            "công ty": "tên công ty",
            "địa điểm làm việc": "địa điểm",
            "lương": "mức lương",
            "mô tả chi tiết": "mô tả công việc",
        },
        extra_aliases={"yêu cầu kinh nghiệm": "kinh nghiệm"},
        texts={
            "job_title_clean": "tên công việc",
            "company_name": "tên công ty",
            "job_description": "mô tả công việc",
        },
        blank=("rating", "company_size", "industry", "job_type", "job_level", "education"),
        benefits="quyền lợi",
        work_time="thời gian làm việc",
    ),
}
SKILLS_COLUMN = "kĩ năng yêu cầu"
# Read only with ``extended``: present in the data, ignored by the fixed rules.
EXTENDED_TEXTS = {"topcv": {"job_level": "cấp bậc", "education": "học vấn"}}


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def alias_columns(df: DataFrame, aliases: dict[str, str]) -> DataFrame:
    """Copy old to new names where the old one exists and the new one does not."""
    present = set(df.columns)
    return df.withColumns({new: _q(old) for old, new in aliases.items() if old in present and new not in present})


def clean_source(df: DataFrame, source: str, form: str | None = None, extended: bool = False) -> DataFrame:
    """Cleaned columns added to the raw ones, in one projection.

    ``extended`` also reads columns that the fixed rules overlook.  A source
    without a dialect passes through unchanged.
    """
    dialect = DIALECTS.get(source)
    if dialect is None:
        return df
    aliases = dict(dialect.aliases)
    texts = dict(dialect.texts)
    blank = set(dialect.blank)
    if extended:
        aliases |= dialect.extra_aliases
        texts |= EXTENDED_TEXTS.get(source, {})
        blank -= set(EXTENDED_TEXTS.get(source, {}))
    df = alias_columns(df, aliases)
    has = set(df.columns)
    null = F.lit(None).cast("string")

    out: dict[str, Column] = {"source": F.lit(source)}
    out |= {target: clean_text(_q(raw), form) for target, raw in texts.items() if raw in has}
    if dialect.location in has:
        place = _q(dialect.location)
        out |= {
            "location_clean": clean_text(place, form),
            "city": vietnamese_city(place),
            "state": vietnamese_province(place),
            "country": F.lit("Vietnam"),
        }
    if dialect.salary in has:
        df = df.withColumn("_pay", salary_range_a(_q(dialect.salary)))
        out |= {"salary_text": _q(dialect.salary), "salary_min": F.col("_pay.min"), "salary_max": F.col("_pay.max")}
    elif dialect.salary_always:
        number = F.lit(None).cast("double")
        out |= {"salary_text": null, "salary_min": number, "salary_max": number}
    out["skills"] = clean_text(_q(SKILLS_COLUMN), form) if SKILLS_COLUMN in has else F.lit("")
    if dialect.experience in has:
        years = vietnamese_experience(_q(dialect.experience))
        out |= {"experience_text": _q(dialect.experience), "experience": years}
    else:
        out |= {"experience_text": null, "experience": F.lit(None).cast("bigint")}
    out["benefits"] = clean_text(_q(dialect.benefits), form) if dialect.benefits in has else F.lit("")
    if dialect.work_time:
        out["work_time"] = clean_text(_q(dialect.work_time), form) if dialect.work_time in has else null
    out |= {name: null for name in blank}
    return df.withColumns(out).drop("_pay")


def clean_all(frames: dict[str, DataFrame], **options) -> dict[str, DataFrame]:
    return {source: clean_source(df, source, **options) for source, df in frames.items()}


def standardize(df: DataFrame, wide: bool = False, extra: Iterable[str] = ()) -> DataFrame:
    """The standard columns only (and ``extra`` ones to keep); a missing one is null."""
    names = [*STANDARD_COLUMNS, *(WIDE_COLUMNS if wide else []), *extra]
    return df.select(*[_q(n) if n in df.columns else F.lit(None).cast("string").alias(n) for n in names])


def standardize_all(frames: dict[str, DataFrame], wide: bool = False) -> dict[str, DataFrame]:
    return {source: standardize(df, wide) for source, df in frames.items()}


def combine(frames: dict[str, DataFrame]) -> DataFrame:
    """One frame with a ``source`` column; columns missing from a source are null."""
    tagged = [df.withColumn("source", F.lit(source)) for source, df in frames.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


# Helper columns dropped before export.
DROPPED = ("original_id", "sector", "sentiment_score")


def drop_helpers(df: DataFrame, names: tuple[str, ...] = DROPPED) -> DataFrame:
    return df.drop(*names)


# Raw columns that can stand for a matching key, best first.
MATCH_CANDIDATES = {
    "careerlink": {
        "job_title_clean": ["tên công việc"],
        "company_name": ["tên công ty"],
        "location_clean": ["Địa điểm công việc"],
    },
    "joboko": {
        "job_title_clean": ["ten_cong_viec", "tên công việc"],
        "company_name": ["ten_cong_ty", "tên công ty"],
        "location_clean": ["dia_diem_lam_viec", "địa điểm", "Địa điểm công việc"],
    },
    "topcv": {
        "job_title_clean": ["tên công việc"],
        "company_name": ["công ty", "tên công ty"],
        "location_clean": ["địa điểm làm việc", "địa điểm", "Địa điểm công việc"],
    },
}
KEY_COLUMNS = ["job_title_clean", "company_name", "location_clean"]
# Words that give away a key column when none of the standard ones exist.
KEY_HINTS = [
    ["title", "job", "công việc", "ten"],
    ["company", "cong ty", "công ty"],
    ["location", "dia diem", "địa điểm"],
]


def map_raw_for_matching(df: DataFrame, source: str) -> DataFrame:
    """Matching keys taken from the first raw candidate column that exists."""
    picks = {}
    for target, candidates in MATCH_CANDIDATES.get(source, {}).items():
        found = next((c for c in candidates if c in df.columns), None)
        if found:
            picks[target] = _q(found)
    return df.withColumns(picks)


def key_columns(columns: list[str]) -> list[str]:
    """Standard key columns present, else one column per hint list."""
    present = [c for c in KEY_COLUMNS if c in columns]
    if present:
        return present
    hits = [next((c for c in columns if any(h in c.lower() for h in hints)), None) for hints in KEY_HINTS]
    return [c for c in hits if c]
