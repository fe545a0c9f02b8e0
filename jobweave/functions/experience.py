"""Years of experience, age ranges."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import SPACE, WORD, _c, let

_S = f"[{SPACE}]*"
_N = rf"([0-9]+)\+?{_S}"

# English wordings, tried in this order; two numbers mean a range.
ENGLISH_WORDINGS = [
    (rf"{_N}to{_S}([0-9]+){_S}years?", 2),
    (rf"{_N}-{_S}([0-9]+){_S}years?", 2),
    (rf"{_N}years?{_S}(?:of{_S})?experience", 1),
    (rf"{_N}years?{_S}exp", 1),
    (rf"{_N}yrs?{_S}exp", 1),
    (rf"{_N}years?", 1),
    (rf"{_N}yr", 1),
    (rf"{_N}y(?![{WORD}])", 1),
]
# Vietnamese wordings, tried in this order.
VIETNAMESE_WORDINGS = [
    (rf"{_N}-{_S}([0-9]+){_S}năm", 2),
    (rf"{_N}đến{_S}([0-9]+){_S}năm", 2),
    (rf"{_N}năm{_S}kinh{_S}nghiệm", 1),
    (rf"{_N}năm{_S}exp", 1),
    (rf"{_N}năm", 1),
    (rf"{_N}n(?![{WORD}])", 1),
]
# Phrases that mean no experience is needed.
NO_EXPERIENCE = ["không yêu cầu", "không cần kinh nghiệm", "fresh graduate", "sinh viên mới ra trường"]
NO_EXPERIENCE_SPACED = rf"không{_S}yêu{_S}cầu|không{_S}cần{_S}kinh{_S}nghiệm"

EXPERIENCE_CAP = 10
AGE_STEP, AGE_CAP = 5, 45


def _first_wording(text: Column, wordings: list[tuple[str, int]]) -> Column:
    """Number (or floored mean of two) of the first wording that matches."""
    result = None
    for pattern, groups in wordings:
        first = F.regexp_extract(text, pattern, 1).try_cast("bigint")
        if groups == 2:
            second = F.regexp_extract(text, pattern, 2).try_cast("bigint")
            value = F.floor((first + second) / 2)
        else:
            value = first
        hit = text.rlike(pattern)
        result = F.when(hit, value) if result is None else result.when(hit, value)
    return result


def english_experience(col: Column | str) -> Column:
    return let(F.lower(_c(col)), lambda t: _first_wording(t, ENGLISH_WORDINGS))


def vietnamese_experience(col: Column | str) -> Column:
    def body(text: Column) -> Column:
        none = text.rlike("|".join(NO_EXPERIENCE))
        spaced = F.when(text.rlike(NO_EXPERIENCE_SPACED), F.lit(0).cast("bigint"))
        return F.when(none, F.lit(0).cast("bigint")).otherwise(
            F.coalesce(_first_wording(text, VIETNAMESE_WORDINGS), spaced)
        )

    return let(F.lower(_c(col)), body)


def _integers(col: Column) -> Column:
    pattern = F.lit(rf"(?=[0-9])(?<![{WORD}])([0-9]+)(?![{WORD}])")
    found = F.regexp_extract_all(F.coalesce(col, F.lit("")), pattern, F.lit(1))
    return F.transform(found, lambda x: x.try_cast("int"))


def _expand(numbers: Column, step: int, cap: int) -> Column:
    """Two numbers become the stepped range between them, ``cap`` at most."""
    low = F.floor(F.get(numbers, F.lit(0)) / step)
    high = F.floor(F.least(F.get(numbers, F.lit(1)), F.lit(cap)) / step)
    steps = F.transform(F.sequence(low, high), lambda i: (i * step).cast("int"))
    spread = F.when(low <= high, steps).otherwise(F.array().cast("array<int>"))
    return F.when(F.size(numbers) == 2, spread).otherwise(numbers)


def experience_list(col: Column | str) -> Column:
    """All integers; exactly two are a range, clipped at ten; null gives []."""
    return let(_integers(_c(col)), lambda xs: _expand(xs, 1, EXPERIENCE_CAP))


def age_list(col: Column | str) -> Column:
    """All integers; exactly two are a range in five-year steps, clipped at 45."""
    return let(_integers(_c(col)), lambda xs: _expand(xs, AGE_STEP, AGE_CAP))


def render_experience(years: Column) -> Column:
    """``[1,2,3]`` as ``1 - 3 năm``, ``[2]`` as ``2 năm``, empty as null."""
    low, high = F.array_min(years), F.array_max(years)
    return F.when(low == high, F.concat(low.cast("string"), F.lit(" năm"))).when(
        low < high, F.concat(low.cast("string"), F.lit(" - "), high.cast("string"), F.lit(" năm"))
    )
