"""Words counted in the tasks that read them, held against the definition in columns."""

import json

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators import words
from millrace.plans.vocabulary import ClassThesaurus, Vocabulary, best_synonyms
from millrace.sources.mappings import CEFRIndex

TEXTS = [
    "The the THE, don't Don't x'y'z 'tis rock'n'roll dogs' ''a'' a''b it's1s", "caf\u00e9x na\u00efve \u212a \u0130the \u017fet \u24d0b the\u0301m \U0001f600et a\u2019s",
    "", None, " \n\t", "1a2b_c_ d-e f\x00g h\x1ci", "a'b'c'd'e' f'" * 3, "'", "w" * 300,
]


def test_words_as_in_columns(spark, monkeypatch):
    df = spark.createDataFrame([(t,) for t in TEXTS * 3], "text string").repartition(3)
    expected = sorted(map(tuple, words.word_counts_native(df).collect()))
    assert sorted(map(tuple, words.word_counts(df).collect())) == expected and ("the", 15) in expected
    assert words.word_counts(df.where("false")).collect() == []
    tables = [r.to_pylist() for r in words._count(df.select("text").toArrow().to_batches())]
    monkeypatch.setattr(words, "HELD_WORDS", 2)
    parts = list(words._count(df.select("text").toArrow().to_batches()))
    assert len(parts) > 3 and sorted(r["w"] for t in tables for r in t) == sorted({r["w"] for p in parts for r in p.to_pylist()})


def test_filters_on_words_see_no_token(spark):
    df = spark.createDataFrame([("a b a b a b c",)], "text string")
    late = words.word_counts(df).where(F.regexp_replace("w", "b", "") != "")
    plan = late._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and plan.index("regexp_replace") < plan.index("MapInArrow")
    assert sorted(map(tuple, late.collect())) == [("a", 3), ("c", 1)]


def _classes(spark):
    """Words that are among the best of their class, in two classes, upper-cased; synonyms twice, tied, not easy, of two words, without a count."""
    members = [("Big", 1), ("huge", 1), ("huge", 2), ("vast", 2), ("great", 2), ("none", 3), ("big", 4), ("stranger", 1)]
    synonyms = [(1, "big", 5), (1, "BIG", 9), (1, "large", 9), (1, "vast", 1), (1, "very_big", 99), (2, "great", None), (2, "fine", 0), (2, "large", 3), (3, "hard", 1), (4, "big", 1), (4, "none", 2)]
    return ClassThesaurus(spark.createDataFrame(members, "word string, class int"), spark.createDataFrame(synonyms, "class int, synonym string, freq long"))


def test_classes_say_what_their_pairs_say(spark):
    easy = spark.createDataFrame([("big", 0), ("large", 0), ("great", 1), ("fine", 0), ("vast", 1), ("very big", 0)], "headword string, rank int")
    targets = spark.createDataFrame([(w,) for w in ("big", "huge", "vast", "great", "none")], "headword string")
    thesaurus = _classes(spark)
    for multiword in (False, True):
        found, expected = (sorted(map(tuple, best_synonyms(targets, easy, t, multiword).collect())) for t in (thesaurus, thesaurus.pairs()))
        assert found == expected and len(found) == 4
    assert dict(found)["big"] == "very big"


def test_classes_are_not_multiplied_out(spark):
    """A class of n words and n synonyms hands on at most two rows a word."""
    rows = spark.range(3000)
    one = F.expr("id DIV 3000").alias("class")
    thesaurus = ClassThesaurus(rows.select(F.concat(F.lit("w"), "id").alias("word"), one), rows.select(one, F.concat(F.lit("s"), "id").alias("synonym"), F.lit(0).alias("freq")))
    easy = rows.select(F.concat(F.lit("s"), "id").alias("headword"), F.lit(0).alias("rank"))
    best = best_synonyms(rows.select(F.concat(F.lit("w"), "id").alias("headword")), easy, thesaurus)
    assert best.count() == best.where("dst = 's0'").count() == 3000
    plan = best._jdf.queryExecution().optimizedPlan().toString()
    assert "WindowGroupLimit" in plan


@pytest.mark.parametrize("rows", [[], [("b\"\u00e9", "x, y", "manual", "B2", None), ("a", "z", "wordnet", None, "A1")]])
def test_files_are_written_without_collecting(spark, tmp_path, monkeypatch, rows):
    mapping = spark.createDataFrame(rows, "from string, to string, source string, from_cefr string, to_cefr string")
    words = spark.createDataFrame([("q",), ("a",), ("c",)], "headword string")
    monkeypatch.setattr(DataFrame, "collect", lambda self: pytest.fail("collected"))
    monkeypatch.setattr(type(mapping), "collect", lambda self: pytest.fail("collected"))
    assert Vocabulary(mapping, words.where("headword <> 'a'"), words, {}).write(str(tmp_path)) == {"targets": 3, "mapped": len(rows), "unmapped": 2}
    pairs = {r[0]: r[1] for r in sorted(rows)}
    assert (tmp_path / "synonyms.json").read_text() == json.dumps(pairs, ensure_ascii=False, indent=2)
    expected = [b"from,to,source,from_cefr,to_cefr", *([b"a,z,wordnet,,A1", '"b""\u00e9","x, y",manual,B2,'.encode()] if rows else [])]
    assert (tmp_path / "synonyms.csv").read_bytes() == b"".join(x + b"\r\n" for x in expected)
    assert (tmp_path / "unmapped.txt").read_text() == "c\nq\n"


def test_flags_need_no_join(spark):
    ranks = spark.createDataFrame([(w, r) for r, w in enumerate("abcdef")], "headword string, rank int")
    index = CEFRIndex(ranks)
    flags = index.flagged(("A1", "B1"), ("B1", "C2"))
    easy, hard = ({r["headword"] for r in df.collect()} for df in (index.easy(("A1", "B1")), index.difficult(("B1", "C2"))))
    assert {r["headword"]: (r["is_easy"], r["is_difficult"]) for r in flags.collect()} == {w: (w in easy, w in hard) for w in "abcdef"}
    assert "Join" not in flags._jdf.queryExecution().optimizedPlan().toString()
