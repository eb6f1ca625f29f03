"""Flesch-Kincaid reading grade (Kincaid et al., 1975) as a native expression.

Words are runs of letters, digits and apostrophes; sentences are runs of ``. ! ?`` (at least one); a
word has as many syllables as it has vowel groups (at least one). Other implementations count
otherwise, so grades agree with theirs only roughly; pass another ``grade`` where that matters.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from .plain import grade_counts, if_ascii
from .text import is_blank

PER_SENTENCE, PER_WORD, OFFSET = 0.39, 11.8, 15.59


def _words(c: Column) -> Column:
    return F.regexp_extract_all(F.lower(c), F.lit(r"[\p{L}\p{N}']+"), F.lit(0))


def _sentences(c: Column) -> Column:
    return F.greatest(F.regexp_count(c, F.lit(r"[.!?]+")), F.lit(1))


def _syllables(words: Column) -> Column:
    return F.aggregate(words, F.lit(0), lambda total, w: total + F.greatest(F.regexp_count(w, F.lit("[aeiouy]+")), F.lit(1)))


def counts(c: Column) -> tuple[Column, Column, Column]:
    """Words, sentences and syllables."""
    return F.size(_words(c)), _sentences(c), _syllables(_words(c))


def _ascii_grade(text: bytes) -> float | None:
    words, sentences, syllables = grade_counts(text)
    return PER_SENTENCE * (words / sentences) + PER_WORD * (syllables / words) - OFFSET if words else None


def reading_grade(c: Column) -> Column:
    """The grade, null where there is no word. Texts of ASCII characters alone are counted as bytes, in Arrow batches."""

    def grade(words: Column) -> Column:
        n = F.size(words).cast("double")
        known = F.lit(PER_SENTENCE) * (n / _sentences(c)) + F.lit(PER_WORD) * (_syllables(words) / n) - F.lit(OFFSET)
        return F.when(n > 0, known)

    # one element's transform binds the words, so that they are found once
    native = F.when(~is_blank(c), F.element_at(F.transform(F.array(_words(c)), grade), 1))
    return if_ascii(c, _ascii_grade, pa.float64(), "double", native)


def is_middle_school_level(c: Column) -> Column:
    """Grade at most 8; null, empty and wordless texts are not."""
    return F.coalesce(reading_grade(c) <= 8.0, F.lit(False))
