"""City, province and state out of free-text locations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import SPACE, _c, constant, let, strip

# Province names, in alphabetical order.
PROVINCES = [
    "An Giang", "Bà Rịa-Vũng Tàu", "Bắc Giang", "Bắc Kạn", "Bạc Liêu", "Bắc Ninh", "Bến Tre",
    "Bình Định", "Bình Dương", "Bình Phước", "Bình Thuận", "Cà Mau", "Cần Thơ", "Cao Bằng",
    "Đà Nẵng", "Đắk Lắk", "Đắk Nông", "Điện Biên", "Đồng Nai", "Đồng Tháp", "Gia Lai", "Hà Giang",
    "Hà Nam", "Hà Nội", "Hà Tĩnh", "Hải Dương", "Hải Phòng", "Hậu Giang", "Hồ Chí Minh",
    "Hòa Bình", "Hưng Yên", "Khánh Hòa", "Kiên Giang", "Kon Tum", "Lai Châu", "Lâm Đồng",
    "Lạng Sơn", "Lào Cai", "Long An", "Nam Định", "Nghệ An", "Ninh Bình", "Ninh Thuận", "Phú Thọ",
    "Phú Yên", "Quảng Bình", "Quảng Nam", "Quảng Ngãi", "Quảng Ninh", "Quảng Trị", "Sóc Trăng",
    "Sơn La", "Tây Ninh", "Thái Bình", "Thái Nguyên", "Thanh Hóa", "Thừa Thiên - Huế",
    "Tiền Giang", "Trà Vinh", "Tuyên Quang", "Vĩnh Long", "Vĩnh Phúc", "Yên Bái",
]

# Names for city lookup, the five centrally run cities first.
CITIES = [
    "Hà Nội", "Hồ Chí Minh", "Đà Nẵng", "Hải Phòng", "Cần Thơ", "An Giang", "Bà Rịa - Vũng Tàu",
    "Bắc Giang", "Bắc Kạn", "Bạc Liêu", "Bắc Ninh", "Bến Tre", "Bình Định", "Bình Dương",
    "Bình Phước", "Bình Thuận", "Cà Mau", "Cao Bằng", "Đắk Lắk", "Đắk Nông", "Điện Biên",
    "Đồng Nai", "Đồng Tháp", "Gia Lai", "Hà Giang", "Hà Nam", "Hà Tĩnh", "Hải Dương", "Hậu Giang",
    "Hòa Bình", "Hưng Yên", "Khánh Hòa", "Kiên Giang", "Kon Tum", "Lai Châu", "Lâm Đồng",
    "Lạng Sơn", "Lào Cai", "Long An", "Nam Định", "Nghệ An", "Ninh Bình", "Ninh Thuận", "Phú Thọ",
    "Phú Yên", "Quảng Bình", "Quảng Nam", "Quảng Ngãi", "Quảng Ninh", "Quảng Trị", "Sóc Trăng",
    "Sơn La", "Tây Ninh", "Thái Bình", "Thái Nguyên", "Thanh Hóa", "Thừa Thiên Huế", "Tiền Giang",
    "Trà Vinh", "Tuyên Quang", "Vĩnh Long", "Vĩnh Phúc", "Yên Bái",
]


def _parts(col: Column) -> Column:
    return F.split(strip(col), ",", -1)


def _first_in(names: list[str], text: Column, fold: bool = False) -> Column:
    """First listed name that is a substring of ``text``."""
    pairs = constant(
        [{"needle": n.lower() if fold else n, "name": n} for n in names], "array<struct<needle:string,name:string>>"
    )
    hit = let(F.lower(text) if fold else text, lambda t: F.filter(pairs, lambda p: F.contains(t, p["needle"])))
    return F.get(hit, F.lit(0))["name"]


def extract_city(col: Column | str) -> Column:
    """Part before the first comma."""
    return F.coalesce(strip(F.get(_parts(_c(col)), F.lit(0))), F.lit(""))


def extract_state(col: Column | str) -> Column:
    """Second comma part, or ''."""
    return F.coalesce(strip(F.get(_parts(_c(col)), F.lit(1))), F.lit(""))


def vietnamese_city(col: Column | str) -> Column:
    """First known city contained in the text, else the part before the first comma."""
    col = _c(col)
    return F.coalesce(_first_in(CITIES, col), extract_city(col))


def vietnamese_province(col: Column | str) -> Column:
    """Last comma part when there are several, else ''."""
    parts = _parts(_c(col))
    last = F.when(F.size(parts) > 1, strip(F.element_at(parts, -1)))
    return F.coalesce(last, F.lit(""))


def extract_location(col: Column | str) -> Column:
    """First province matched without regard to case, else null."""
    return _first_in(PROVINCES, _c(col), fold=True)


def location_area(col: Column | str) -> Column:
    return F.trim(F.get(F.split(_c(col), rf",[{SPACE}]*", -1), F.lit(0)))


def location_province(col: Column | str) -> Column:
    return F.trim(F.get(F.split(_c(col), rf",[{SPACE}]*", -1), F.lit(1)))
