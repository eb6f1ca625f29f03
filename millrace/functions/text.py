"""Text functions, Column to Column, all JVM-side.

Patterns keep to what Java's regex and RE2 agree on, but for those of ``normalize``, and never use ``\\w``, ``\\b`` or ``\\v``, which
mean other things in Java than in the definitions here.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A maximal run of letters, digits (any script) and underscores.
WORD = r"[\p{L}\p{N}_]+"
#: An ASCII word with one optional apostrophe suffix, a digit run, or one character that is neither word nor space.
TOKEN = r"[a-zA-Z]+(?:'[a-zA-Z]+)?|\p{Nd}+|[^\p{L}\p{N}_\s\p{Z}]"
#: All that Unicode calls white space, and the four ASCII separators.
SPACE = r"[\s\p{Z}\x{85}\x{1C}-\x{1F}]"
#: ``a-z0-9`` one by one: Java looks single characters up in one table, but asks each range in turn, which took
#: most of the time of a negated class.
_KEPT = "abcdefghijklmnopqrstuvwxyz0123456789"


def strip(c: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(c, rf"^{SPACE}+|{SPACE}+$", "")


def is_blank(c: Column) -> Column:
    """Null, or nothing but white space."""
    return c.isNull() | c.rlike(rf"^{SPACE}*$")


def normalize(c: Column) -> Column:
    """Lower case, only ``a-z 0-9 , . ! ?``, spaces and newlines; punctuation runs become their last sign,
    each sign stands between single spaces. Null stays null; what has no such character becomes empty."""
    # one space for each run of spaces and other characters
    kept = F.regexp_replace(F.lower(c), rf"[^{_KEPT},.!?\n]+", " ")
    # white space is taken from its start alone and never given back, so long runs of newlines cost their length
    padded = F.regexp_replace(kept, r"(?:(?<![ \n])[ \n]++|(?=[,.!?]))[,.!?]*([,.!?])[ \n]*", " $1 ")
    return F.trim(F.regexp_replace(padded, " {2,}", " "), F.lit(" \n"))


def normalize_lines(c: Column) -> Column:
    """An array of lines, each normalized, empty results left out."""
    return F.filter(F.transform(c, normalize), lambda x: x != "")


def tokenize(c: Column) -> Column:
    """Words (with an apostrophe suffix), numbers and single signs as an array; other letters are left out."""
    return F.regexp_extract_all(c, F.lit(TOKEN), F.lit(0))


def detokenize(tokens: Column) -> Column:
    """Tokens joined by spaces, signs and brackets closed up, English contractions glued."""
    c = F.array_join(tokens, " ")
    c = F.regexp_replace(c, r"\s+([!,.:;?])", "$1")
    c = F.regexp_replace(c, r"""(["'({\[])\s+""", "$1")
    c = F.regexp_replace(c, r"""\s+(["')}\]])""", "$1")
    for suffix in ("n't", "'s", "'re", "'m", "'ve", "'d"):
        c = F.replace(c, F.lit(f" {suffix}"), F.lit(suffix))
    return c


def _undouble(c: Column) -> Column:
    last, before = F.substring(c, -1, 1), F.expr("NULL")
    before = F.when(F.length(c) >= 2, c.substr(F.length(c) - 1, F.lit(1)))
    return F.when(last == before, c.substr(F.lit(1), F.length(c) - 1)).otherwise(c)


def lemma(word: Column) -> Column:
    """A candidate base form by suffix: ies to y; es, s, ing, ed, ly off, one of a doubled letter with ing and ed."""
    n = F.length(word)

    def cut(k: int) -> Column:
        return word.substr(F.lit(1), n - k)

    return (
        F.when(word.endswith("ies") & (n > 4), F.concat(cut(3), F.lit("y")))
        .when(word.endswith("es") & (n > 3), cut(2))
        .when(word.endswith("s") & (n > 3), cut(1))
        .when(word.endswith("ing") & (n > 5), _undouble(cut(3)))
        .when(word.endswith("ed") & (n > 4), _undouble(cut(2)))
        .when(word.endswith("ly") & (n > 4), cut(2))
        .otherwise(word)
    )


def titlecase(c: Column) -> Column:
    """The first character of each word raised, the rest as it is, white space collapsed."""
    words = F.filter(F.split(c, rf"{SPACE}+"), lambda w: w != "")
    return F.array_join(F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), w.substr(F.lit(2), F.length(w)))), " ")


def preserve_case(source: Column, replacement: Column) -> Column:
    """``replacement`` in the case of ``source``: all upper, title case, or as it is."""
    rest = source.substr(F.lit(2), F.length(source))
    first = F.substring(source, 1, 1)
    upper = (source == F.upper(source)) & (source != F.lower(source))
    title = (F.length(source) > 1) & (first == F.upper(first)) & (first != F.lower(first)) & (rest == F.lower(rest)) & (rest != F.upper(rest))
    return F.when(upper, F.upper(replacement)).when(title, titlecase(replacement)).otherwise(replacement)


def normalize_token(c: Column) -> Column:
    """A dictionary key: stripped and lower-cased."""
    return F.lower(strip(c))


def is_alpha(c: Column) -> Column:
    """Only ASCII letters, at least one."""
    return c.rlike("^[A-Za-z]+$") & ~c.contains("\n")


def number_of_characters(c: Column) -> Column:
    return F.length(c).cast("long")


def number_of_words(c: Column) -> Column:
    """Parts between white space."""
    return F.size(F.filter(F.split(c, rf"{SPACE}+"), lambda w: w != "")).cast("long")


def truncate(c: Column, most: int, mark: str = "...") -> Column:
    """A longer text's first ``most`` characters and ``mark``."""
    return F.when(F.length(c) > most, F.concat(c.substr(1, most), F.lit(mark))).otherwise(c)
