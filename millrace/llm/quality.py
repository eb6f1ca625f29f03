"""Quality rules: repetition counts and how a public tokenizer's vocabulary fits the text."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from dataclasses import dataclass
from itertools import count, islice

import numpy as np
import public_tokenizers
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import ascii_bytes, drop_names, struct_udf

DEFAULT_MODEL = "piece_bpe_32k.model"
_SYMBOLS = b"#*$%&|<>"
_REMEMBERED, _LONG = 300_000, 48
#: Bits of a word's number in a packed 3-word window.
_NUMBER = 21
_LETTER = re.compile(r"[^\W\d_]")
METRICS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_letterless long, n_tokens long, chars_per_token double, byte_share double, entropy double, script string"
NAMES = tuple(f.split()[0] for f in METRICS.split(", "))


@dataclass(frozen=True)
class Band:
    """What a language or script may have: characters per token, share of byte-fallback tokens, the tokens'
    entropy as a share of the most that as many tokens can have, and fertility, tokens per word, at most."""

    chars: tuple[float, float]
    byte_share: float
    entropy: tuple[float, float]
    per_word: float = math.inf


class WordTokens:
    """Each word's ids by a sentencepiece vocabulary, encoded once a worker."""

    def __init__(self, model_path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        size = self.model.get_piece_size()
        self.is_byte = np.array([self.model.is_byte(i) or self.model.is_unknown(i) for i in range(size)])
        self.memo: dict[bytes, bytes] = {}
        self.letterless: set[bytes] = set()

    def learn(self, words: set[bytes]) -> list[bytes]:
        """Remember ids of the words that are new, and which have no letter; returns those too long to keep."""
        if len(self.memo) > _REMEMBERED:
            # the first half came early, so it is the commoner
            self.memo = dict(islice(self.memo.items(), _REMEMBERED // 2))
            self.letterless.intersection_update(self.memo)
        new = list(words.difference(self.memo))
        plain = [w.decode("utf-8", "replace") for w in new]
        self.memo.update((w, np.array(i, np.int32).tobytes()) for w, i in zip(new, self.model.encode(plain, num_threads=1)))
        self.letterless.update(w for w, t in zip(new, plain) if not _LETTER.search(t))
        return [w for w in new if len(w) > _LONG]

    def forget(self, words: list[bytes]) -> None:
        for w in words:
            del self.memo[w]
            self.letterless.discard(w)


_models: dict[str, WordTokens] = {}


def _script(text: str) -> str:
    """The commonest script of a text by code-point ranges of its letters."""
    if text.isascii():
        return "latin" if _LETTER.search(text) else "none"
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    counts = {
        "latin": np.count_nonzero(((codes | 32) >= 97) & ((codes | 32) <= 122) | (codes >= 0xC0) & (codes < 0x250)),
        "greek": np.count_nonzero((codes >= 0x370) & (codes < 0x400)), "cyrillic": np.count_nonzero((codes >= 0x400) & (codes < 0x530)),
        "hebrew": np.count_nonzero((codes >= 0x590) & (codes < 0x600)), "arabic": np.count_nonzero((codes >= 0x600) & (codes < 0x780)),
        "indic": np.count_nonzero((codes >= 0x900) & (codes < 0xE00)), "thai": np.count_nonzero((codes >= 0xE00) & (codes < 0xE80)),
        "cjk": np.count_nonzero((codes >= 0x3040) & (codes < 0xA000) | (codes >= 0xAC00) & (codes < 0xD7B0)),
    }
    best = max(counts, key=counts.get)
    return best if counts[best] else "none"


def count_repeats(words: list[bytes], most: int = 1 << _NUMBER) -> int:
    """Words that lie in a 3-word window found twice or more. Up to ``most`` different words, windows are packed integers."""
    if len(words) < 4:
        return 0
    number: defaultdict[bytes, int] = defaultdict(count().__next__)
    codes = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    if len(number) > most:  # too many words at once to pack
        counts = Counter(zip(words, words[1:], words[2:]))
        again = np.fromiter((counts[g] > 1 for g in zip(words, words[1:], words[2:])), bool, len(words) - 2)
    else:
        grams = codes[:-2] << 2 * _NUMBER | codes[1:-1] << _NUMBER | codes[2:]
        ordered = np.sort(grams)
        twice = ordered[1:][ordered[1:] == ordered[:-1]]
        if not len(twice):
            return 0
        at = np.searchsorted(twice, grams)
        again = twice[np.minimum(at, len(twice) - 1)] == grams
    hit = np.zeros(len(words), bool)
    for k in range(3):
        hit[k : k + len(again)] |= again
    return int(hit.sum())


def measure(texts: list[bytes], model_path: str) -> list[list]:
    """METRICS of each text."""
    if model_path not in _models:
        _models[model_path] = WordTokens(model_path)
    model = _models[model_path]
    rows = []
    for k in range(0, len(texts), 64):
        group = [(data, data.split()) for data in texts[k : k + 64]]
        long = model.learn(set().union(*[words for _, words in group]))
        rows += [_measured(data, words, model) for data, words in group]
        model.forget(long)
    return [list(c) for c in zip(*rows)] if rows else [[] for _ in NAMES]


def _measured(data: bytes, words: list[bytes], model: WordTokens) -> tuple:
    n, size = len(words), sum(map(len, words))
    text = data.decode("utf-8", "replace")
    spaces = len(data) - size
    lines = [x for x in data.split(b"\n") if x.strip()]
    symbols = len(data) - len(data.translate(None, _SYMBOLS))
    ids = np.frombuffer(b"".join(map(model.memo.__getitem__, words)), np.int32)
    tokens = len(ids)
    if tokens:
        counts = np.unique(ids, return_counts=True)[1]
        entropy = float(math.log2(tokens) - (counts * np.log2(counts)).sum() / tokens)
        ratio, share = (len(text) - spaces) / tokens, float(model.is_byte[ids].mean())
    else:
        entropy = ratio = share = None
    return n, len(text) - spaces, symbols, len(lines) - len(set(lines)), count_repeats(words), sum(map(model.letterless.__contains__, words)), tokens, ratio, share, entropy, _script(text)


#: Wide bands: what they reject is text that a vocabulary of many languages plainly doesn't fit. English, French,
#: German and Spanish prose takes one to three tokens a word; 3.5 is reached where signs or codes are strewn over
#: the words. Languages that the vocabulary knows less or that build long words take more: clean Finnish and Zulu
#: 3.9 and over (tests/llm/multilingual.py); Vietnamese has 1.2 characters a token.
SCRIPT_BANDS = {
    "latin": Band((1.0, 8.0), 0.10, (0.35, 1.0), 5.0),
    "greek": Band((0.7, 4.0), 0.10, (0.25, 1.0)),
    "cyrillic": Band((1.0, 6.0), 0.10, (0.3, 1.0), 5.0),
    "hebrew": Band((0.6, 4.0), 0.20, (0.2, 1.0)),
    "arabic": Band((0.6, 4.0), 0.20, (0.2, 1.0)),
    "indic": Band((0.3, 4.0), 0.90, (0.15, 1.0)),
    "thai": Band((0.3, 4.0), 0.90, (0.15, 1.0)),
    "cjk": Band((0.25, 3.0), 0.75, (0.2, 1.0)),
    "none": Band((0.25, 12.0), 0.90, (0.2, 1.0)),
}
#: Of long words; only et, fi, hu, tr and zu are measured, the others have the band of their kin.
_LONG_WORDS = ("ay", "az", "et", "eu", "fi", "hu", "kl", "lg", "nr", "ny", "qu", "rn", "rw", "se", "sn", "ss", "sw", "tk", "tr", "uz", "xh", "zu")
LANGUAGE_BANDS = {
    "en": Band((1.4, 8.0), 0.05, (0.35, 1.0), 3.5), "vi": Band((0.8, 8.0), 0.10, (0.35, 1.0), 5.0),
    **dict.fromkeys(("fr", "de", "es"), Band((1.2, 8.0), 0.10, (0.35, 1.0), 3.5)), **dict.fromkeys(_LONG_WORDS, Band((1.0, 8.0), 0.10, (0.35, 1.0), 6.0)),
}


def within_bands(lang: Column | None, languages: dict[str, Band], scripts: dict[str, Band]) -> Column:
    """Do a row's metrics lie in its language's band, or, without one, in its script's?"""
    share = F.col("entropy") / F.log2(F.greatest(F.col("n_tokens"), F.lit(2)))

    def inside(b: Band) -> Column:
        fits = F.col("chars_per_token").between(*b.chars) & (F.col("byte_share") <= b.byte_share) & share.between(*b.entropy)
        return fits & (F.col("n_tokens") <= F.col("n_words") * b.per_word) if math.isfinite(b.per_word) else fits

    by_script = F.coalesce(*[F.when(F.col("script") == k, inside(b)) for k, b in scripts.items()], F.lit(True))
    if lang is None or not languages:
        return by_script
    # a language's band holds for its own script only
    of_band = {b: [k for k, x in languages.items() if x == b] for b in languages.values()}
    known = [F.when(F.lower(lang).isin(names) & (F.col("script") == "latin"), inside(b)) for b, names in of_band.items()]
    return F.coalesce(*known, by_script)


def quality_rules(
    df: DataFrame, text_col: str = "text", lang_col: str | None = "lang", min_words: int = 50, max_repeat_percent: int = 50, min_letter_percent: int = 80,
    languages: dict[str, Band] = LANGUAGE_BANDS, scripts: dict[str, Band] = SCRIPT_BANDS, model_path: str | None = None,
) -> DataFrame:
    """``df`` with METRICS, ``base_failed`` and ``kept``, replacing columns of those names.

    base_failed: fewer than ``min_words`` words, or over ``max_repeat_percent`` of them in repeated
    3-word windows. kept: not base_failed, and characters per token, byte-fallback share, token
    entropy and tokens per word within the band of the row's language or, if it has none (or null), of its script,
    and at least ``min_letter_percent`` of its words with a letter (80 as in the published Gopher rules). Words
    are encoded on their own, so fertility is a sum over words. A null or empty text has no words: it
    fails. Texts of any length are measured whole, repeated rows alike, other columns (null or not) are
    carried through, an empty table stays empty. No shuffle: every row is measured where it is read.
    """
    path = model_path or public_tokenizers.path(DEFAULT_MODEL)
    metric = struct_udf(lambda texts: measure(texts, path), METRICS, ascii_bytes(F.col(text_col)))
    lang = F.col(f"`{lang_col}`").alias("__mr_lang") if lang_col and lang_col in df.columns else F.lit(None).cast("string").alias("__mr_lang")
    rows = drop_names(df.withColumns({"__mr_metric": metric, "__mr_lang": lang}), (*NAMES, "base_failed", "kept"))
    own = [c for c in rows.columns if c not in ("__mr_metric", "__mr_lang")]
    rows = rows.select(*[F.col(f"`{c}`") for c in own], "__mr_metric.*", "__mr_lang")
    failed = (F.col("n_words") < min_words) | (F.col("n_repeat_words") * 100 > F.col("n_words") * max_repeat_percent)
    rows = rows.withColumn("base_failed", failed)
    fits = within_bands(F.col("__mr_lang"), languages, scripts)
    lettered = F.col("n_letterless") * 100 <= F.col("n_words") * (100 - min_letter_percent)
    return rows.withColumn("kept", ~F.col("base_failed") & lettered & F.coalesce(fits, F.lit(False))).drop("__mr_lang")
