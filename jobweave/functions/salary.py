"""Salary text to numbers: two dialects, a dollar variant, and 5-million bins.

The two Vietnamese dialects give different answers on purpose; both are kept
under their own name (:func:`salary_range_a`, :func:`salary_range_b`).
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import BOUNDARY, SPACE, WORD, _c, compatibility_fold, constant, let, strip

USD_TO_VND = 24000.0
BIN_SIZE = 5
BIN_CAP = 100

# Phrases that mean "negotiable".
NEGOTIABLE = ["thương lượng", "thoả thuận", "thỏa thuận", "negotiable"]
# Unit words and their factors, in alternation order.
UNITS = {
    "triệu": 1e6, "tr": 1e6, "trđ": 1e6, "trd": 1e6, "million": 1e6,
    "nghìn": 1e3, "ngàn": 1e3, "ngan": 1e3, "k": 1e3,
}
IMPLICIT_USD_LIMIT = 1_000_000

_S = f"[{SPACE}]*"
_NUM = r"([0-9][0-9.,]*)"
_UNIT = "(" + "|".join(UNITS) + ")"
_DASH = f"{_S}-{_S}"
_RANGE_TYPE = "struct<min:double,max:double>"


def _digits(number: Column) -> Column:
    return F.regexp_replace(number, "[^0-9]", "").try_cast("double")


def _decimal(number: Column) -> Column:
    """One comma or dot is a decimal point; several are thousands separators."""

    def body(text: Column) -> Column:
        return F.when(text.rlike("[.,].*[.,]"), _digits(text)).otherwise(F.translate(text, ",", ".").try_cast("double"))

    return let(number, body)


def unit_multiplier(unit: Column) -> Column:
    """Factor of a unit word, 1 when there is none."""
    return F.coalesce(F.try_element_at(constant(UNITS, "map<string,double>"), F.lower(unit)), F.lit(1.0))


def _pair(low: Column, high: Column) -> Column:
    return F.struct(low.alias("min"), high.alias("max"))


def _same(value: Column) -> Column:
    return _pair(value, value)


def _prepare(text: Column) -> Column:
    """Lower case, with dashes and "to" as ``-``; null when negotiable or without any number.

    Lower case loses nothing, since only numbers and unit words are read, and
    spares every later pattern the case-insensitive match.
    """

    def body(low: Column) -> Column:
        useful = low.rlike("[0-9]") & ~low.rlike("|".join(NEGOTIABLE))
        dashed = F.translate(low, "–—−", "---")
        joined = F.when(F.contains(low, F.lit("to")), F.regexp_replace(dashed, f"{_S}to{_S}", "-")).otherwise(dashed)
        return F.when(useful, joined)

    return let(F.lower(text), body)


def _mentions_usd(text: Column) -> Column:
    return F.contains(text, F.lit("usd")) | F.contains(text, F.lit("$"))


def _implicit_usd(value: Column, rate: float) -> Column:
    return F.when(value < IMPLICIT_USD_LIMIT, value * rate).otherwise(value)


def _implicit_usd_range(low: Column, high: Column, rate: float) -> Column:
    usd = (low < IMPLICIT_USD_LIMIT) & (high < IMPLICIT_USD_LIMIT)
    return F.when(usd, _pair(low * rate, high * rate)).otherwise(_pair(low, high))


def _match(text: Column, pattern: str, body: Callable[[Column], Column]) -> Column:
    """``body`` of the first match, or null; the text is searched once."""
    found = F.regexp_extract(text, pattern, 0)
    return let(found, lambda m: F.when(m != "", body(m)))


def _number_in(match: Column, last: bool = False) -> Column:
    """The first (or last) number of a short match."""
    numbers = F.regexp_extract_all(match, F.lit(_NUM), F.lit(1))
    return F.element_at(numbers, -1 if last else 1)


def _sides(match: Column) -> Column:
    """The parts of a range before and after its dash."""
    return F.split(match, "-", 2)


def _unit_in(match: Column) -> Column:
    """Unit word right after the number, in full, or null."""
    return F.nullif(F.regexp_extract(match, f"[0-9.,]{_S}{_UNIT}$", 1), F.lit(""))


def _or_nothing(salary: Column) -> Column:
    """Both ends null instead of a null struct."""
    nothing = F.struct(F.lit(None).cast("double").alias("min"), F.lit(None).cast("double").alias("max"))
    return F.coalesce(salary.cast(_RANGE_TYPE), nothing)


def salary_range_a(col: Column | str, usd_to_vnd: float = USD_TO_VND) -> Column:
    """``struct<min,max>`` in VND, used by the integration cleaners.

    Digits next to a dollar sign are read without decimals; a range without a
    unit, and a bare number, below one million count as dollars.
    """
    mark = r"(?:usd|\$)"
    start = f"(?=[0-9])(?<![{WORD}])"  # a word boundary before a digit, rejected cheaply elsewhere
    usd_range = rf"{_NUM}{_S}{mark}?{_DASH}{_NUM}"
    usd_single = rf"{mark}{_S}{_NUM}|{_NUM}{_S}{mark}"
    unit_range = rf"{start}{_NUM}{_S}{_UNIT}?{_DASH}{_NUM}(?:{_S}{_UNIT})?{_S}{BOUNDARY}"
    unit_single = rf"{start}{_NUM}{_S}{_UNIT}(?![{WORD}])"
    plain_single = rf"{start}[0-9][0-9.,]+{BOUNDARY}"

    def dollars(match: Column) -> Column:
        return _pair(_digits(_number_in(match)) * usd_to_vnd, _digits(_number_in(match, last=True)) * usd_to_vnd)

    def spread(match: Column) -> Column:
        def ends(parts: Column) -> Column:
            low, high = F.get(parts, F.lit(0)), F.get(parts, F.lit(1))
            units = F.struct(_unit_in(strip(low)).alias("low"), _unit_in(strip(high)).alias("high"))

            def scaled(u: Column) -> Column:
                plain = _implicit_usd_range(_digits(_number_in(low)), _digits(_number_in(high)), usd_to_vnd)
                named = _pair(
                    _decimal(_number_in(low)) * unit_multiplier(F.coalesce(u["low"], u["high"])),
                    _decimal(_number_in(high)) * unit_multiplier(F.coalesce(u["high"], u["low"])),
                )
                return F.when(F.coalesce(u["low"], u["high"]).isNotNull(), named).otherwise(plain)

            return let(units, scaled)

        return let(_sides(match), ends)

    def body(text: Column) -> Column:
        dash = F.contains(text, F.lit("-"))
        usd = F.coalesce(
            F.when(dash, _match(text, usd_range, dollars)),
            _match(text, usd_single, lambda m: _same(_digits(_number_in(m)) * usd_to_vnd)),
        )
        return F.coalesce(
            F.when(_mentions_usd(text), usd),
            F.when(dash, _match(text, unit_range, spread)),
            _match(text, unit_single, lambda m: _same(_decimal(_number_in(m)) * unit_multiplier(_unit_in(m)))),
            _match(text, plain_single, lambda m: _same(_implicit_usd(_digits(m), usd_to_vnd))),
        )

    return _or_nothing(let(_prepare(strip(_c(col))), body))


def salary_range_b(col: Column | str, usd_to_vnd: float = USD_TO_VND) -> Column:
    """``struct<min,max>`` in VND, used by the feature job.

    A single comma or dot is always a decimal point, and unit words need no
    word boundary after them.
    """
    plain_range = f"{_NUM}{_DASH}{_NUM}"
    unit_range = rf"{_NUM}{_S}{_UNIT}?{_DASH}{_NUM}(?:{_S}{_UNIT})?"
    usd_single = rf"{_NUM}{_S}(?:usd|\$)"
    unit_single = rf"{_NUM}{_S}{_UNIT}"

    def dollars(match: Column) -> Column:
        return _pair(_decimal(_number_in(match)) * usd_to_vnd, _decimal(_number_in(match, last=True)) * usd_to_vnd)

    def spread(match: Column) -> Column:
        def ends(parts: Column) -> Column:
            low, high = F.get(parts, F.lit(0)), F.get(parts, F.lit(1))
            units = F.struct(_unit_in(strip(low)).alias("low"), _unit_in(strip(high)).alias("high"))
            return let(
                units,
                lambda u: _pair(
                    _decimal(_number_in(low)) * unit_multiplier(F.coalesce(u["low"], u["high"])),
                    _decimal(_number_in(high)) * unit_multiplier(F.coalesce(u["high"], u["low"])),
                ),
            )

        return let(_sides(match), ends)

    def body(text: Column) -> Column:
        dash = F.contains(text, F.lit("-"))
        usd = F.coalesce(
            F.when(dash, _match(text, plain_range, dollars)),
            _match(text, usd_single, lambda m: _same(_decimal(_number_in(m)) * usd_to_vnd)),
        )
        return F.coalesce(
            F.when(_mentions_usd(text), usd),
            F.when(dash, _match(text, unit_range, spread)),
            _match(text, unit_single, lambda m: _same(_decimal(_number_in(m)) * unit_multiplier(_unit_in(m)))),
            _match(text, "[0-9][0-9.,]+", lambda m: _same(_implicit_usd(_decimal(m), usd_to_vnd))),
        )

    return _or_nothing(let(_prepare(strip(_c(col))), body))


def as_pair(salary: Column) -> Column:
    """The array form ``[min, max]`` of a salary struct."""
    return F.array(salary["min"], salary["max"])


def dollar_range(col: Column | str) -> Column:
    """Dollar amounts such as ``$50K-$70K`` as ``struct<min,max>``."""
    amount = r"[0-9]+(?:,[0-9]{3})*(?:\.[0-9]{2})?"

    def values(match: Column) -> Column:
        found = F.regexp_extract_all(match, F.lit(amount), F.lit(0))
        number = lambda i: F.regexp_replace(F.element_at(found, i), ",", "").try_cast("double")
        return _pair(number(1), number(-1))

    def body(text: Column) -> Column:
        return F.coalesce(_match(text, rf"{amount}{_S}[-–—]{_S}\$?{amount}", values), _match(text, amount, values))

    expanded = F.regexp_replace(strip(_c(col)), rf"([0-9]+(?:,[0-9]{{3}})*){_S}[Kk]", "$1000")
    return _or_nothing(let(expanded, body))


def salary_average(low: Column, high: Column) -> Column:
    """Mid-point, null unless both ends are known."""
    return ((low + high) / F.lit(2.0)).cast("double")


# --- bins of five million VND, capped at one hundred -----------------------------------------------------------------


def _bin(million: Column) -> Column:
    return F.least(F.floor(million / BIN_SIZE) * BIN_SIZE, F.lit(BIN_CAP)).cast("int")


def _bin_range(low: Column, high: Column) -> Column:
    """All bins from ``low`` to ``high`` million; empty when ``low`` lies above."""
    first = F.floor(low / BIN_SIZE)
    last = F.floor(F.least(high, F.lit(float(BIN_CAP))) / BIN_SIZE)
    bins = F.transform(F.sequence(first, last), lambda i: (i * BIN_SIZE).cast("int"))
    return F.when(first <= last, bins).otherwise(F.array().cast("array<int>"))


def salary_bins_from_numbers(low: Column, high: Column, currency: Column) -> Column:
    """Bins covered by a numeric salary range in VND or USD."""

    def million(value: Column) -> Column:
        value = value.try_cast("double")
        return F.when(F.upper(currency) == "USD", F.floor(value * 24 / 1000)).otherwise(F.floor(value / 1_000_000))

    def body(ends: Column) -> Column:
        a, b = ends["a"], ends["b"]
        single = F.array(_bin(F.coalesce(a, b)))
        spread = _bin_range(F.least(a, b).cast("double"), F.greatest(a, b).cast("double"))
        return (
            F.when(a.isNull() & b.isNull(), F.array().cast("array<int>"))
            .when(a.isNull() | b.isNull() | (a == b), single)
            .otherwise(spread)
        )

    return let(F.struct(million(low).alias("a"), million(high).alias("b")), body)


# The seven salary mentions, written with flat character classes; the group number says what is kept.
# The last entry lists strings one of which any match must hold, to skip the pattern for other texts.
SALARY_MENTIONS = [
    (r"(?iu)lương(?:từ| )+ ([0-9.]+)", 1, ["lương"]),
    (r"(?iu)([0-9.\- ]+(?:triệu| )+)đồng", 1, ["đồng"]),
    (r"[0-9.,]+.000.000", 0, ["000"]),
    (r"(?iu)[0-9 \-]+[0-9] *(?:triệu|m)", 0, ["triệu", "m"]),
    (r"\$(?:[0-9]+|,)", 0, ["$"]),
    (r"(?i)[0-9,]+ *(?:USD|\$)+", 0, ["usd", "$"]),
    (r"[0-9.,]+,000,000", 0, [",000,000"]),
]


def _mention_bins(hit: Column) -> Column:
    """Bins of one salary mention."""

    def integer(text: Column) -> Column:
        return F.when(strip(text).rlike("^[0-9]+$"), strip(text).try_cast("double"))

    dollars = integer(
        F.regexp_replace(
            F.when(F.startswith(hit, F.lit("$")), F.substr(hit, F.lit(2)))
            .when(F.contains(hit, F.lit("$")), F.substr(hit, F.lit(1), F.length(hit) - 1))
            .when(F.contains(hit, F.lit("USD")), F.replace(hit, F.lit("USD"), F.lit("")))
            .when(F.contains(hit, F.lit("usd")), F.replace(hit, F.lit("usd"), F.lit(""))),
            ",",
            "",
        )
    )

    def million(text: Column) -> Column:
        spelled = F.regexp_replace(text, "triệu|Triệu|TRIỆU|m|M", "000000")
        return F.floor(integer(F.regexp_replace(spelled, "[., ]", "")) / 1_000_000)

    def vnd(parts: Column) -> Column:
        start = integer(F.regexp_replace(F.get(parts, F.lit(0)), "[.,]", ""))
        end = million(F.get(parts, F.lit(1)))
        return F.when(F.size(parts) == 1, F.array(_bin(million(F.get(parts, F.lit(0)))))).otherwise(
            F.when(start.isNotNull() & end.isNotNull(), _bin_range(start, end.cast("double")))
        )

    parts = F.split(F.regexp_replace(strip(hit), "^-+|-+$", ""), "-", -1)
    return F.when(dollars.isNotNull(), F.array(_bin(F.floor(dollars * 24 / 1000)))).otherwise(vnd(parts))


def salary_bins_from_text(col: Column | str) -> Column:
    """Sorted bins of every salary mentioned; two lone bins are joined up."""

    def found(text: Column) -> Column:
        none = F.array().cast("array<string>")

        def search(low: Column) -> Column:
            hits = []
            for pattern, group, needed in SALARY_MENTIONS:
                possible = low.rlike("|".join(re.escape(part) for part in needed))
                hits.append(F.when(possible, F.regexp_extract_all(text, F.lit(pattern), F.lit(group))).otherwise(none))
            return F.array_distinct(F.concat(*hits))

        return F.coalesce(F.when(text.rlike("[0-9$]"), let(F.lower(text), search)), none)

    def fill(bins: Column) -> Column:
        spread = _bin_range(F.get(bins, F.lit(0)).cast("double"), F.get(bins, F.lit(1)).cast("double"))
        return F.when(F.size(bins) == 2, spread).otherwise(bins)

    hits = let(compatibility_fold(F.coalesce(_c(col), F.lit(""))), found)
    bins = F.flatten(F.transform(hits, lambda h: F.coalesce(_mention_bins(h), F.array().cast("array<int>"))))
    return let(F.array_sort(F.array_distinct(F.array_compact(bins))), fill)
