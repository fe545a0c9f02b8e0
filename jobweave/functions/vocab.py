"""Vocabulary lookup in text, returning arrays of terms."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import terms
from .text import WORD, _c, constant, let

_EMPTY = "array<string>"
_HIT = "position:int,value:string"


def _literal(pattern: str) -> bool:
    return not re.search(r"[.*]", pattern)


def vocab_match(
    col: Column | str,
    vocab: Iterable[str] | Mapping[str, str],
    regex: bool = False,
    word_boundary: bool = False,
) -> Column:
    """Vocabulary entries found in the text, in vocabulary order.

    A mapping gives the value returned for each entry.  The text is folded to
    lower case once and scanned with a substring search per entry, which is
    several times cheaper than one regular expression each.  ``regex`` reads
    ``.`` and ``*`` in an entry as operators; ``word_boundary`` demands that an
    entry is not part of a longer word.
    """
    items = vocab.items() if isinstance(vocab, Mapping) else [(v, v) for v in vocab]
    plain, patterns = [], []
    for position, (entry, value) in enumerate(items):
        hit = {"position": position, "value": value}
        if word_boundary:
            patterns.append((rf"(?iu)(?<![{WORD}])\Q{entry.strip()}\E(?![{WORD}])", hit))
        elif regex and not _literal(entry):
            patterns.append(("(?iu)" + entry.replace("+", r"\+").replace(".", r"[^\n]"), hit))
        else:
            plain.append(hit | {"needle": entry.lower()})

    def scan(text: Column) -> Column:
        needles = constant(plain, f"array<struct<{_HIT},needle:string>>")
        found = F.filter(needles, lambda p: F.contains(text, p["needle"]))
        if patterns:
            extra = [F.when(text.rlike(p), constant(hit, f"struct<{_HIT}>")) for p, hit in patterns]
            found = F.array_sort(
                F.concat(
                    F.transform(found, lambda p: F.struct(p["position"].alias("position"), p["value"].alias("value"))),
                    F.array_compact(F.array(*extra)),
                )
            )
        return F.transform(found, lambda h: h["value"])

    text = F.lower(_c(col)) if plain else _c(col)
    return F.coalesce(let(text, scan), F.array().cast(_EMPTY))


def posting_text(description: Column | str, requirements: Column | str) -> Column:
    """Description and requirements joined by a blank; a missing part counts as empty."""
    return F.concat(
        F.coalesce(_c(description), F.lit("")), F.lit(" "), F.coalesce(_c(requirements), F.lit(""))
    )


def extract_frameworks(description, requirements) -> Column:
    return vocab_match(posting_text(description, requirements), terms.FRAMEWORKS, regex=True)


def extract_programming_languages(description, requirements) -> Column:
    return vocab_match(posting_text(description, requirements), terms.PROGRAMMING_LANGUAGES, regex=True)


def extract_knowledge(description, requirements) -> Column:
    return vocab_match(posting_text(description, requirements), terms.KNOWLEDGE)


def extract_design_patterns(description, requirements) -> Column:
    return vocab_match(posting_text(description, requirements), terms.DESIGN_PATTERNS)


def extract_languages(requirements) -> Column:
    """Languages asked for; one named in two ways appears twice."""
    return vocab_match(requirements, terms.LANGUAGES)


def extract_education(text) -> Column:
    return vocab_match(text, terms.EDUCATION)


def extract_job_type(industry) -> Column:
    return vocab_match(industry, terms.JOB_TYPES)


def extract_skills(text) -> Column:
    return vocab_match(text, terms.SKILLS)


def label_of(term: Column) -> Column:
    """Category of a knowledge term, or null."""
    return F.try_element_at(constant(terms.KNOWLEDGE_LABELS, "map<string,string>"), term)


def grouped_knowledge(knowledge: Column | str) -> Column:
    """Category of the first term that has one."""
    return F.get(F.array_compact(F.transform(_c(knowledge), label_of)), F.lit(0))


def label_table(spark) -> DataFrame:
    """``term, category`` dimension (a few dozen rows)."""
    return spark.createDataFrame(list(terms.KNOWLEDGE_LABELS.items()), "term string, category string")


def group_table(spark) -> DataFrame:
    """``category, term`` dimension of the category headings."""
    rows = [(group, term) for group, members in terms.KNOWLEDGE_GROUPS.items() for term in members]
    return spark.createDataFrame(rows, "category string, term string")
