"""How often each word occurs in a corpus."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import is_alpha, tokenize

#: A task hands on what it has counted whenever it holds so many words.
HELD_WORDS = 250_000
_LETTERS = frozenset(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ'")
#: ASCII letters lower-cased, apostrophes, and spaces for all other bytes.
_TABLE = bytes(b if b in _LETTERS else 32 for b in range(256)).lower()


def _plain(word: bytes) -> Iterator[bytes]:
    """The tokens without an apostrophe in a run of letters and apostrophes.

    A token is a run of letters with at most one apostrophe suffix, taken from the left.
    """
    parts = word.split(b"'")
    i = 0
    while i < len(parts):
        if parts[i] and i + 1 < len(parts) and parts[i + 1]:
            i += 2  # one token with its suffix
            continue
        if parts[i]:
            yield parts[i]
        i += 1


def _rows(seen: Counter[bytes]) -> pa.RecordBatch:
    plain: Counter[bytes] = Counter()
    for word in [w for w in seen if b"'" in w]:
        n = seen.pop(word)
        for part in _plain(word):
            plain[part] += n
    seen.update(plain)
    words = pa.array(list(seen), pa.binary()).cast(pa.string())
    return pa.record_batch([words, pa.array(list(seen.values()), pa.int64())], ["w", "n"])


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: Counter[bytes] = Counter()
    for batch in batches:
        for text in batch.column(0):
            if text.is_valid:
                seen.update(text.as_buffer().to_pybytes().translate(_TABLE).split())
                if len(seen) >= HELD_WORDS:
                    yield _rows(seen)
                    seen = Counter()
    yield _rows(seen)


def word_counts(df: DataFrame, text_column: str = "text") -> DataFrame:
    """(w, n): the tokens of ASCII letters alone, lower-cased, and how often each occurs; null texts have none.

    The same as ``word_counts_native``, but counted in the task that reads the text, so rows are words of a
    task, not tokens, and whatever is asked of the words later is asked once a word: Catalyst moves filters
    on the words below an aggregate, where they would run on every token.
    """
    counted = df.select(F.col(f"`{text_column}`").cast("string")).mapInArrow(_count, "w string, n long")
    return counted.groupBy("w").agg(F.sum("n").alias("n"))


def word_counts_native(df: DataFrame, text_column: str = "text") -> DataFrame:
    """The definition of ``word_counts`` in columns."""
    rows = df.select(F.explode(tokenize(F.col(f"`{text_column}`"))).alias("w"))
    return rows.groupBy(F.lower("w").alias("w")).agg(F.count(F.lit(1)).alias("n")).where(is_alpha(F.col("w")))
