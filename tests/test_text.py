"""Scalar goldens, and every Column function against its scalar counterpart."""

import time

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace import scalar
from millrace.functions import text as t
from millrace.functions.readability import is_middle_school_level, reading_grade

NORMALIZED = {
    "Hello,   WORLD!!": "hello , world !", "Wait...what?!": "wait . what !", "Don’t stop—now": "don t stop now", "café": "caf", "a\nb": "a\nb", "a.\nb": "a . b",
    "\n x \n": "x", "tab\there": "tab here", 'She said "hi"-ok': "she said hi ok", "3.14": "3 . 14", "! !": "! !", "###": "", "": "",
}
LEMMAS = {
    "studies": "study", "boxes": "box", "houses": "hous", "running": "run", "stopped": "stop", "quickly": "quick", "this": "thi", "ties": "ti", "bed": "bed",
    "bring": "bring", "needed": "need", "seeing": "se", "class": "clas", "was": "was", "cat": "cat", "": "", "es": "es",
}
CASES = {"DIFFICULT": "EASY", "Difficult": "Easy", "difficult": "easy", "I": "EASY", "U2": "EASY", "iPhone": "easy", "McDonald": "easy", "123": "easy"}
SAMPLES = [*NORMALIZED, *LEMMAS, *CASES, "Can't stop, she's late! My sister's gone.", "naïve_3", " a  b\nc ", "¿Qué? (x) [y] {z}", "x . y , z", "No. Yes! Maybe? 12 a1", None]


def column(spark, values, f):
    rows = spark.createDataFrame(list(enumerate(values)), "i int, s string").select("i", f(F.col("s")).alias("r")).collect()
    return [r["r"] for r in sorted(rows)]


def test_normalize_goldens(spark):
    assert [scalar.normalize_text(s) for s in NORMALIZED] == list(NORMALIZED.values())
    assert column(spark, list(NORMALIZED), t.normalize) == list(NORMALIZED.values())
    assert scalar.normalize_text(None) == "" and column(spark, [None], t.normalize) == [None]


def test_lemma_goldens(spark):
    assert [scalar.simple_lemma_like(w) for w in LEMMAS] == list(LEMMAS.values())
    assert column(spark, list(LEMMAS), t.lemma) == list(LEMMAS.values())


def test_preserve_case_goldens(spark):
    assert [scalar.preserve_case_like(w, "easy") for w in CASES] == list(CASES.values())
    assert column(spark, list(CASES), lambda c: t.preserve_case(c, F.lit("easy"))) == list(CASES.values())
    assert scalar.preserve_case_like("Commence", "set out") == "Set Out"
    assert column(spark, ["Commence"], lambda c: t.preserve_case(c, F.lit("set  oUt"))) == ["Set OUt"]


def test_tokenize_and_detokenize(spark):
    assert scalar.tokenize_basic("Can't stop, she's late! My sister's gone.") == ["Can't", "stop", ",", "she's", "late", "!", "My", "sister's", "gone", "."]
    assert scalar.tokenize_basic("naïve_3") == ["na", "ve", "3"]
    texts = [s for s in SAMPLES if s is not None]
    assert column(spark, texts, t.tokenize) == [scalar.tokenize_basic(s) for s in texts]
    for tokens, joined in ((["Can't", "stop", ",", "she's", "late", "!"], "Can't stop, she's late!"), (["(", "a", ")"], "(a)"), (["x", "'s", "y"], "x's y")):
        assert scalar.detokenize_basic(tokens) == joined
    assert column(spark, texts, lambda c: t.detokenize(t.tokenize(c))) == [scalar.detokenize_basic(scalar.tokenize_basic(s)) for s in texts]


def test_counts_and_truncation(spark):
    assert column(spark, ["a  b\nc", "", " ", None], t.number_of_words) == [3, 0, 0, None]
    assert column(spark, ["a  b\nc"], t.number_of_characters) == [6]
    assert column(spark, ["abc", "abcd"], lambda c: t.truncate(c, 3)) == ["abc", "abc..."]
    assert column(spark, ["  X\n", "ab"], t.normalize_token) == ["x", "ab"]
    assert column(spark, ["ab", "a1", "", "a.m.", "ab\n"], t.is_alpha) == [True, False, False, False, False]
    assert column(spark, [None, "", " \t ", "x"], t.is_blank) == [True, True, True, False]


def test_grade_by_hand(spark):
    # 6 words, 1 sentence, 6 syllables: 0.39 * 6 + 11.8 - 15.59
    assert column(spark, ["The cat sat on the mat."], reading_grade) == [pytest.approx(-1.45)]
    texts = ["The cat sat on the mat.", "Photosynthesis requires extraordinary electromagnetic radiation.", "", "  ", "...", None, "One. Two! Three?"]
    assert column(spark, texts, reading_grade) == [scalar.calculate_readability_grade(s) for s in texts]
    assert column(spark, texts, is_middle_school_level) == [scalar.is_middle_school_level(s) for s in texts] == [True, False, False, False, False, False, True]


@given(st.text(alphabet="aB1 ,.!?\n-'é", max_size=40))
def test_normalize_twice_is_once(s):
    once = scalar.normalize_text(s)
    assert scalar.normalize_text(once) == once


def test_normalize_column_equals_scalar(spark):
    import random

    rnd = random.Random(3)
    texts = ["".join(rnd.choice("aBz1 ,.!?\n\t-'é”_") for _ in range(rnd.randrange(30))) for _ in range(500)]
    assert column(spark, texts, t.normalize) == [scalar.normalize_text(s) for s in texts]


def test_normalize_time(spark):
    """Twice as fast as one pass of its class by ranges alone; long runs of newlines cost their length."""

    def seconds(value, f, n):
        best = float("inf")
        for _ in range(2):
            began = time.time()
            rows = spark.range(n).select(F.concat(F.lit(value), F.col("id").cast("string")).alias("s"))
            rows.select(F.sum(F.length(f(F.col("s"))))).collect()
            best = min(best, time.time() - began)
        return best

    prose = "plain words and some more of them, " * 2000
    ranges = seconds(prose, lambda c: F.regexp_replace(F.lower(c), r"[^a-z0-9 ,.!?\n]+", " "), 200)
    assert seconds(prose, t.normalize, 200) < ranges / 2
    assert seconds("\n" * 60_000 + "a", t.normalize, 1) < 5
