"""Text normalisation as column expressions.

Java's ``\\w``, ``\\s`` and ``\\b`` know ASCII only, so every class is spelled
out: the constants below are the Unicode word, space and boundary classes.
"""

from __future__ import annotations

import json
import sys
import unicodedata
from collections.abc import Callable
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters of texts that are held as Python objects at a time.
HELD = 1 << 20

WORD = r"\p{L}\p{N}_"
SPACE = r"\s\x0B\x1C-\x1F\x85\p{Z}"
BOUNDARY = rf"(?:(?<=[{WORD}])(?![{WORD}])|(?<![{WORD}])(?=[{WORD}]))"

# The same white space, character by character.
SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0" + "".join(
    chr(code) for code in range(0x1000, 0x3001) if chr(code).isspace()
)

# Words ignored in company and title signatures.
COMPANY_STOP_WORDS = (
    "cong ty tnhh mtv mtvv co phan cp tap doan doanh nghiep tmdv tm dv thuong mai dich vu "
    "company jsc llc ltd co., co, inc., inc group viet nam vietnam vn"
).split()


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use the result several times in ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def constant(value, ddl: str) -> Column:
    """A nested constant in one expression; Catalyst folds it into a literal."""
    return F.from_json(F.lit(json.dumps(value, ensure_ascii=False)), ddl)


def strip(col: Column | str) -> Column:
    """Trim Unicode white space on both sides."""
    return F.trim(_c(col), F.lit(SPACES))


def collapse_space(col: Column | str) -> Column:
    """Replace each run of Unicode white space by one blank, then trim."""
    return F.trim(F.regexp_replace(_c(col), rf"[{SPACE}]+", " "))


def normalise(values: pa.Array, form: str) -> pa.Array:
    """Unicode normal form.  Texts become an Arrow column after each ``HELD`` characters, so a batch is never held as objects."""
    done, held, size = [], [], 0
    for value in values:
        value = value.as_py()
        held.append(value if value is None else unicodedata.normalize(form, value))
        size += len(value or "")
        if size >= HELD:
            done.append(pa.array(held, pa.string()))
            held, size = [], 0
    return pa.concat_arrays([*done, pa.array(held, pa.string())])


def normalize_unicode(col: Column | str, form: str) -> Column:
    """Unicode normal form; Spark has no builtin, so one Arrow UDF."""
    return F.arrow_udf(lambda values: normalise(values, form), "string")(_c(col))


def clean_text(col: Column | str, form: str | None = None) -> Column:
    """Null becomes '', white space collapses, symbols outside ``-.,()&/`` go.

    ``form='NFKD'`` also decomposes the result; the default keeps the input's
    composed form so that accented vocabulary terms still match downstream.
    """
    text = F.regexp_replace(strip(_c(col)), rf"[{SPACE}]+", " ")
    text = F.regexp_replace(text, rf"[^{WORD}{SPACE}\-.,()&/]", "")
    text = F.coalesce(text, F.lit(""))
    return normalize_unicode(text, form) if form else text


def norm_text(col: Column | str) -> Column:
    """Null becomes '', white space collapses and is trimmed."""
    return F.coalesce(collapse_space(col), F.lit(""))


def norm_key(col: Column | str, form: str | None = None) -> Column:
    """Lower-cased :func:`norm_text`, for key comparison."""
    col = normalize_unicode(col, form) if form else _c(col)
    return F.lower(norm_text(col))


# Marks, jamo, and the ranges and single characters that the composed form (NFC) replaces.
_NOT_COMPOSED = r"[\p{M}\u1100-\u11ff\u2000\u2001\u2126\u212a\u212b\u2329\u232a\u0374\u037e\u0387\u1f71-\u1ffd\uf900-\ufaff]"


def composed(col: Column | str) -> Column:
    """Composed Unicode form.  Only texts that may not be in it are handed to Python."""
    text = _c(col)
    return F.coalesce(normalize_unicode(F.when(text.rlike(_NOT_COMPOSED), text), "NFC"), text)


def composite_key(title: Column, company: Column, location: Column) -> Column:
    """Key of three texts, the same for every Unicode spelling of them."""
    return F.concat_ws("__", *[norm_key(composed(c)) for c in (title, company, location)])


@lru_cache(maxsize=2)
def _fold_table(compatibility: bool) -> tuple[str, str]:
    """Characters whose decomposition has exactly one non-mark character.

    Computed from the Unicode database: marks map to nothing, accented letters
    to their base letter.
    """
    form = "NFKD" if compatibility else "NFD"
    source, target, dropped = [], [], []
    for code in range(0x80, sys.maxunicode + 1):
        if 0xD800 <= code <= 0xDFFF:
            continue
        char = chr(code)
        base = [c for c in unicodedata.normalize(form, char) if not unicodedata.combining(c)]
        if not base:
            dropped.append(char)
        elif len(base) == 1 and base[0] != char:
            source.append(char)
            target.append(base[0])
    return "".join(source + dropped), "".join(target)


@lru_cache(maxsize=1)
def _compatibility_table() -> tuple[str, str]:
    """Characters whose NFKC form is one other character (wide digits, no-break blanks)."""
    pairs = [
        (char, unicodedata.normalize("NFKC", char))
        for char in map(chr, range(0x80, sys.maxunicode + 1))
        if not 0xD800 <= ord(char) <= 0xDFFF
    ]
    pairs = [(a, b) for a, b in pairs if len(b) == 1 and a != b]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


def compatibility_fold(col: Column | str) -> Column:
    """Replace compatibility characters by their plain form inside the JVM."""
    source, target = _compatibility_table()
    return F.translate(_c(col), source, target)


def drop_marks(col: Column | str, compatibility: bool = False) -> Column:
    """Remove accents (decompose, drop combining marks) inside the JVM."""
    source, target = _fold_table(compatibility)
    return F.translate(_c(col), source, target)


def strip_accents(col: Column | str) -> Column:
    """Lower case, no accents, only ``a-z 0-9`` and single blanks.

    The letter d with stroke has no decomposition and becomes a blank.
    """
    text = drop_marks(F.lower(strip(F.coalesce(_c(col), F.lit("")))), compatibility=True)
    text = F.regexp_replace(text, rf"[^a-z0-9{SPACE}]", " ")
    return collapse_space(text)


def signature_tokens(col: Column | str) -> Column:
    """Sorted distinct tokens of :func:`strip_accents` without stop words."""
    stop = constant(COMPANY_STOP_WORDS, "array<string>")
    tokens = F.array_except(F.split(strip_accents(col), " "), stop)
    return F.array_join(F.array_sort(F.array_remove(tokens, "")), " ")


def fold_schedule(col: Column | str) -> Column:
    """Trim, lower, drop accents and collapse white space, keeping punctuation."""
    text = drop_marks(F.lower(strip(F.coalesce(_c(col), F.lit("")))))
    return F.regexp_replace(text, rf"[{SPACE}]+", " ")


def block_key(city: Column, title: Column, company: Column) -> Column:
    """SHA-256 over city, title signature and company signature."""
    return F.sha2(
        F.concat_ws("|", strip_accents(city), signature_tokens(title), signature_tokens(company)), 256
    )


def strip_newlines(df):
    """Remove literal newlines from every string column."""
    return df.select(
        *[
            F.regexp_replace(F.col(f"`{name}`"), "\n", "").alias(name) if kind == "string" else F.col(f"`{name}`")
            for name, kind in df.dtypes
        ]
    )
