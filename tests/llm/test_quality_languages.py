"""Clean prose of many languages passes the bands; the four that a limit of 3.5 tokens a word was set for keep it."""

from millrace.llm.quality import quality_rules

from .multilingual import CLEAN


def test_clean_prose_is_kept(spark):
    rows = [(text, lang) for name, text in CLEAN.items() for lang in (name, name.upper(), None, "xx")]
    found = quality_rules(spark.createDataFrame(rows, "text string, lang string")).collect()
    assert len(found) == len(rows)
    assert [(r["lang"], r["text"][:20], r["n_tokens"] / r["n_words"]) for r in found if not r["kept"]] == []


def test_limits_of_four_languages_stay(spark):
    codes = " ".join(f"zq{i:x}xj{i * 7919:x}kw{i * 104729:x}" for i in range(80))
    rows = [(CLEAN["fi"], lang) for lang in ("en", "fr", "de", "es", "ES")] + [(codes, lang) for lang in (None, "fi", "vi", "zu", "de")]
    assert not any(r["kept"] for r in quality_rules(spark.createDataFrame(rows, "text string, lang string")).collect())
