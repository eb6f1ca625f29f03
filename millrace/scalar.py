"""The text functions on Python strings, for annotators and other driver-side use.

Each equals its Column counterpart in ``millrace.functions``; tests hold them against each other.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence

_OUTSIDE = re.compile(r"[^a-z0-9 ,.!?\n]+")
_SIGNS = re.compile(r"[,.!?]*([,.!?])")
_PADDED = re.compile(r"\s*([,.!?])\s*")
_TOKEN = re.compile(r"\d+|[a-zA-Z]+(?:'[a-zA-Z]+)?|[^\s\w]")
_GLUED = ("n't", "'s", "'re", "'m", "'ve", "'d")
_GRADE_WORD = re.compile(r"(?:[^\W_]|')+")
ALPHA_RE = re.compile(r"[A-Za-z]+")
CEFR_ORDER = {level: rank for rank, level in enumerate(("A1", "A2", "B1", "B2", "C1", "C2"))}


def normalize_text(s: str | None) -> str:
    if not s:
        return ""
    s = _SIGNS.sub(r"\1", _OUTSIDE.sub(" ", s.lower()))
    s = _PADDED.sub(r" \1 ", re.sub(" +", " ", s))
    return re.sub(" +", " ", s).strip(" \n")


def normalize_iter(lines: Iterable[str]) -> Iterator[str]:
    return (x for x in map(normalize_text, lines) if x)


def normalize_token(tok: str) -> str:
    return tok.strip().lower()


def tokenize_basic(text: str) -> list[str]:
    return _TOKEN.findall(text)


def detokenize_basic(tokens: Sequence[str]) -> str:
    s = " ".join(tokens)
    for pattern in (r"\s+([!,.:;?])", r"([\"'({\[])\s+", r"\s+([\"')}\]])"):
        s = re.sub(pattern, r"\1", s)
    for suffix in _GLUED:
        s = s.replace(" " + suffix, suffix)
    return s


def simple_lemma_like(word: str) -> str:
    """A candidate base form; the first suffix that fits decides."""

    def single(w: str) -> str:
        return w[:-1] if len(w) > 1 and w[-1] == w[-2] else w

    n = len(word)
    rules = (
        ("ies", 4, lambda: word[:-3] + "y"), ("es", 3, lambda: word[:-2]), ("s", 3, lambda: word[:-1]),
        ("ing", 5, lambda: single(word[:-3])), ("ed", 4, lambda: single(word[:-2])), ("ly", 4, lambda: word[:-2]),
    )
    return next((cut() for suffix, least, cut in rules if n > least and word.endswith(suffix)), word)


def preserve_case_like(source_token, replacement):
    """The replacement in the case of the source: all upper, title case, or as it is."""
    head, tail = source_token[:1], source_token[1:]
    if source_token.isupper():
        replacement = replacement.upper()
    elif tail and head.isupper() and tail.islower():
        replacement = " ".join(w[0].upper() + w[1:] for w in replacement.split())
    return replacement


def calculate_readability_grade(text: str | None) -> float | None:
    if not text or text.isspace():
        return None
    return _grade(text)


def _grade(text: str) -> float | None:
    words = _GRADE_WORD.findall(text.lower())
    if not words:
        return None
    sentences = max(1, len(re.findall(r"[.!?]+", text)))
    syllables = sum(max(1, len(re.findall("[aeiouy]+", w))) for w in words)
    return 0.39 * (len(words) / sentences) + 11.8 * (syllables / len(words)) - 15.59


def is_middle_school_level(text: str | None) -> bool:
    grade = _grade(text) if text else None
    return grade is not None and grade <= 8.0
