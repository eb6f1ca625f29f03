"""Row filters on the text column. Rows whose predicate is null are dropped, as SQL does."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.readability import reading_grade

MAX_GRADE = 8.0


def require_column(df: DataFrame, text_column: str) -> None:
    """Raise before any work if the text column is missing."""
    if text_column not in df.columns:
        raise ValueError(f"no text column {text_column!r}; the table has {df.columns}")


def keyword_predicate(c: Column, keywords: Sequence[str], literal: bool = False) -> Column:
    """Does the lower-cased text hold any of the lower-cased keywords: patterns, or plain parts if ``literal``?"""
    low = F.lower(c)
    if literal:
        return reduce(or_, [low.contains(k.lower()) for k in keywords])
    for k in keywords:
        re.compile(k.lower())  # a broken pattern fails here, not in a task
    return reduce(or_, [low.rlike(k.lower()) for k in keywords])


def filter_by_keywords(df: DataFrame, keywords: Sequence[str], text_column: str = "text", literal: bool = False) -> DataFrame:
    """Rows whose text matches any keyword as a substring pattern (no word boundaries); no keywords: ``df``."""
    return df.where(keyword_predicate(F.col(text_column), keywords, literal)) if keywords else df


def filter_by_readability(df: DataFrame, max_grade: float = MAX_GRADE, text_column: str = "text", grade: Callable[[Column], Column] = reading_grade) -> DataFrame:
    """Rows with a grade of at most ``max_grade``; texts without one are dropped."""
    return df.where(grade(F.col(text_column)) <= max_grade)


def filter_non_empty(df: DataFrame, text_column: str = "text") -> DataFrame:
    """Rows whose normalized text has a character."""
    return df.where(F.length(text_column) > 0)
