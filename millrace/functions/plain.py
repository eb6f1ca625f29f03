"""The plan's text functions on UTF-8 bytes, in Arrow batches.

Java's patterns cost a string a match, 100 to 200 ns for each word, sign or vowel group; here a text is translated and
counted in a few passes. What bytes can't tell goes the way of the Column function.
"""

from __future__ import annotations

import re
import string
from collections.abc import Callable, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

_WORD = string.ascii_letters + string.digits


def _table(classes: Mapping[str, str], rest: str) -> bytes:
    """For ``bytes.translate``: each character of a key to its value, all other bytes to ``rest``."""
    table = bytearray(rest.encode() * 256)
    for chars, new in classes.items():
        for c in chars.encode():
            table[c] = ord(new)
    return bytes(table)


#: Lower case; a space for all that ``normalize`` doesn't keep.
_KEPT = bytes(b if chr(b) in _WORD + ",.!?\n" else 32 for b in range(256)).lower()
#: ``a`` for vowels, ``b`` for what else is in words.
_SOUNDS = _table({_WORD + "'": "b", "aeiouyAEIOUY": "a"}, " ")
_ENDS = _table({".!?": "."}, "x")
#: A run of signs, its last one as a group; the search skips to the set in front.
_SPACES, _SIGNS = re.compile(rb"  +"), re.compile(rb"[,.!?][,.!?]*(?<=(.))")
#: The only other characters whose lower case has an ASCII character.
_KELVIN, _DOTTED_I = "\u212a".encode(), "\u0130".encode()


def over_bytes(c: Column, f: Callable[[bytes], object], arrow_type: pa.DataType, kind: str) -> Column:
    """``f`` of each text's bytes; null stays null."""

    def each(texts: pa.Array) -> pa.Array:
        return pa.array([f(t.as_buffer().to_pybytes()) if t.is_valid else None for t in texts], arrow_type)

    each.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(each, kind)(c)


def if_ascii(c: Column, f: Callable[[bytes], object], arrow_type: pa.DataType, kind: str, other: Column) -> Column:
    """``f`` of the bytes of texts of ASCII characters alone, ``other`` for the rest, which never leave the JVM."""
    ascii_only = F.octet_length(c) == F.length(c)
    return F.when(ascii_only, over_bytes(F.when(ascii_only, c), f, arrow_type, kind)).otherwise(other)


def normalized(text: bytes) -> bytes:
    """``functions.text.normalize`` of one text."""
    if _KELVIN in text or _DOTTED_I in text:
        text = text.replace(_KELVIN, b"k").replace(_DOTTED_I, b"i ")
    kept = _SPACES.sub(b" ", text.translate(_KEPT))
    parts = [part.strip(b" \n") for part in _SIGNS.split(kept)]
    return b" ".join([part for part in parts if part])


def _starts(held: np.ndarray) -> np.ndarray:
    """True where a run starts; the array starts with False."""
    return held[1:] & ~held[:-1]


def grade_counts(text: bytes) -> tuple[int, int, int]:
    """Words, sentences and syllables of a text of ASCII characters, as ``functions.readability`` has them."""
    sounds = np.frombuffer(b" " + text.translate(_SOUNDS), np.uint8)
    vowels = sounds == ord("a")
    starts = np.flatnonzero(_starts(sounds != ord(" "))) + 1
    silent = len(starts) - np.count_nonzero(np.logical_or.reduceat(vowels, starts)) if len(starts) else 0
    ends = np.frombuffer(b"x" + text.translate(_ENDS), np.uint8) == ord(".")
    sentences, groups = np.count_nonzero(_starts(ends)), np.count_nonzero(_starts(vowels))
    return len(starts), max(int(sentences), 1), int(groups + silent)


def swapper(mapping: Mapping[str, str], new: Callable[[str, str], str]) -> Callable[[bytes], bytes]:
    """A function that replaces the mapped words of a text of ASCII characters, ``new`` giving what stands for (word, hit)."""
    hits = {k.encode(): v for k, v in mapping.items() if v and re.fullmatch(r"\w+", k, re.ASCII)}
    if not hits:
        return bytes
    firsts = "".join(sorted({c for k in hits for c in (chr(k[0]), chr(k[0]).upper())}))
    # the search skips to the set in front; most of its characters are inside words, where the look behind fails at once
    tails = "|".join(f"(?<={chr(k[0])}){k[1:].decode()}" for k in hits)
    pattern = re.compile(rf"[{firsts}](?<!\w\w)(?:{tails})(?!\w)".encode(), re.IGNORECASE)

    def swap(m: re.Match) -> bytes:
        return new(m[0].decode(), hits[m[0].lower()]).encode()

    return lambda text: pattern.sub(swap, text)
