"""Filters, dedup, synonyms, statistics and annotators."""

import json

import pytest
from pyspark.sql import functions as F

import millrace
from millrace.operators import dedup, filters, stats
from millrace.operators.annotate import PART_ROWS, BaseAnnotator, CustomFunctionAnnotator, ExpressionAnnotator, LLMAnnotator, parse_response, text_features
from millrace.operators.synonyms import SynonymMapper, rewrite_by_join

MAP = {"vessel": "ship", "ascend": "climb", "employ": "use", "initiate": "begin", "roughly": "about", "perhaps": "", "Multi Word": "never"}
LINES = {
    "A vessel can ascend the river.": "A ship can climb the river.", "They EMPLOY ropes.": "They USE ropes.", "Initiate it now.": "Begin it now.",
    "Roughly nine, perhaps.": "About nine, perhaps.", "vessels multi word": "vessels multi word", "": "",
}


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "i long, text string")


def texts_of(df):
    return [r["text"] for r in df.orderBy("i").collect()]


def test_keywords(spark):
    df = frame(spark, ["dna here", "DNAs", "excellent", "cxt", None, "none"])
    assert texts_of(filters.filter_by_keywords(df, ["DNA", "cell"])) == ["dna here", "DNAs", "excellent"]
    assert texts_of(filters.filter_by_keywords(df, ["c.t"])) == ["cxt"]
    assert texts_of(filters.filter_by_keywords(df, ["c.t"], literal=True)) == []
    assert filters.filter_by_keywords(df, []) is df
    with pytest.raises(Exception):
        filters.filter_by_keywords(df, ["(broken"])


def test_readability(spark):
    df = frame(spark, ["The cat sat.", "Electromagnetic radiation characterization.", None, "  ", "..."])
    assert texts_of(filters.filter_by_readability(df)) == ["The cat sat."]
    assert texts_of(filters.filter_by_readability(df, 0, grade=lambda c: F.lit(0.0))) == texts_of(df)


def test_dedup_keeps_the_first(spark):
    df = spark.createDataFrame([(3, "a"), (1, "a"), (2, "b"), (9, None), (4, None)], "i long, text string").repartition(3)
    assert [tuple(r) for r in dedup.dedup_keep_first(df, order=F.col("i")).orderBy("i").collect()] == [(1, "a"), (2, "b"), (4, None)]
    assert dedup.dedup_keep_first(df.limit(0)).count() == 0


def test_sets_and_samples(spark):
    a, b = frame(spark, ["x", "y"]), frame(spark, ["x"])
    assert dedup.union_all(a, b, b).count() == 4
    assert texts_of(dedup.difference(a, b, "i")) == ["y"]
    many = spark.range(100)
    one, two = ({r[0] for r in dedup.sample_rows(many.repartition(k), 10, "id", "s").collect()} for k in (1, 5))
    assert one == two and len(one) == 10


@pytest.mark.parametrize("way", ["native", "arrow", "join", "scalar"])
def test_synonyms(spark, way):
    m, df = SynonymMapper(MAP), frame(spark, [*LINES, None])
    if way == "join":
        got = texts_of(rewrite_by_join(df, m.to_frame(spark), "i"))
    elif way == "scalar":
        got = [*m.simplify_iter(LINES), None]
    else:
        got = texts_of(df.withColumn("text", (m.native_column if way == "native" else m.arrow_column)(F.col("text"))))
    assert got == [*LINES.values(), None]


def test_mapper_is_lower_cased_and_empty_map_changes_nothing(spark, tmp_path):
    (tmp_path / "m.json").write_text(json.dumps({"UTILIZE": "Use"}))
    m = SynonymMapper.from_json(str(tmp_path / "m.json"), preserve_case=False)
    assert m.simplify_line("Utilize") == "use" and m.with_entry("B", "C").simplify_line("b") == "c" and m.simplify_line("b") == "b"
    c = F.col("text")
    assert SynonymMapper({}).column(c) is c
    assert SynonymMapper({f"w{i}": "x" for i in range(40)}).column(c)._jc.toString().startswith("rewrite")


def test_stats(spark):
    df = spark.createDataFrame(
        [("ab", "x", 1, 1, 1.5, 2.5, True), ("", "x", 2, None, float("nan"), 1.0, None), (None, None, 4, 3, 2.0, 3.0, False), ("abcd", "y", 9, 4, 0.5, 4.0, True)],
        "text string, s string, l long, i int, d double, f float, b boolean",
    )
    found = stats.generate_stats(df)
    assert (found["total_rows"], found["total_columns"]) == (4, 7)
    assert found["text_stats"] == {"min_length": 0, "max_length": 4, "mean_length": 2.0, "median_length": 2.0, "total_characters": 6, "empty_or_null_count": 2}
    cs = found["column_stats"]
    assert cs["s"] == {"dtype": "String", "null_count": 1, "unique_values": 3, "top_values": [{"s": "x", "counts": 2}, {"s": None, "counts": 1}, {"s": "y", "counts": 1}]}
    assert cs["l"] == {"dtype": "Int64", "null_count": 0, "min": 1, "max": 9, "mean": 4.0, "median": 3.0}
    assert (cs["d"]["min"], cs["d"]["max"], cs["i"]["null_count"], cs["b"]) == (0.5, 2.0, 1, {"dtype": "Boolean", "null_count": 1})
    empty = stats.generate_stats(df.limit(0))
    assert (empty["total_rows"], empty["text_stats"]["total_characters"], empty["text_stats"]["min_length"]) == (0, 0, None)


def test_annotators_agree(spark):
    texts = ["One two. Three?", "no signs 1", "", "  "]

    def features(s):
        words = (s or "").split()
        mean = round(sum(map(len, words)) / len(words), 1) if words else 0.0
        return {"has_question": "?" in s, "has_numbers": any(c.isdigit() for c in s), "avg_word_length": mean, "sentence_count": max(1, sum(map(s.count, ".!?"))), "char_count": len(s), "word_count": len(words)}

    schema = "word_count long, char_count long, sentence_count long, avg_word_length double, has_numbers boolean, has_question boolean"
    df = frame(spark, texts)
    native = ExpressionAnnotator(text_features).annotate_dataframe(df)
    python = CustomFunctionAnnotator(features, schema).annotate_dataframe(df)
    assert native.orderBy("i").collect() == python.orderBy("i").collect()
    inferred = CustomFunctionAnnotator(features).annotate_dataframe(df)
    assert [tuple(r) for r in inferred.select(*python.columns).orderBy("i").collect()] == [tuple(r) for r in python.orderBy("i").collect()]


def test_annotator_gets_null_and_raises_on_a_clash(spark):
    df = frame(spark, [None, "x"])
    got = CustomFunctionAnnotator(lambda s: {"missing": s is None}, "missing boolean").annotate_dataframe(df)
    assert [r["missing"] for r in got.orderBy("i").collect()] == [True, False]
    for a in (CustomFunctionAnnotator(lambda s: {"I": 1}, "I int"), ExpressionAnnotator(lambda c: {"I": c})):
        with pytest.raises(ValueError):
            a.annotate_dataframe(df)
    with pytest.raises(ValueError):
        CustomFunctionAnnotator(lambda s: {"k": 1}).annotate_dataframe(df.limit(0))


def test_annotator_holds_the_annotations_of_a_part(spark):
    """4,000 rows in a batch, whose annotations take 200 MB."""

    class Memory(BaseAnnotator):
        output_schema = "mb double, long string"

        def resident(self):
            with open("/proc/self/statm") as f:
                return int(f.read().split()[1]) * 4096 / 1e6

        def open(self):
            self.start = self.resident()

        def annotate(self, text):
            return {"mb": self.resident() - self.start, "long": text * 12_500}

    df = spark.range(1000, 5000).repartition(1).select(F.col("id").cast("string").alias("text"))
    most, characters = Memory().annotate_dataframe(df).agg(F.max("mb"), F.sum(F.length("long"))).first()
    assert characters == 200_000_000 and most < 120


def test_annotations_become_columns_as_in_pandas_udfs(spark):
    values = [{"l": 1.0, "d": 1, "s": "x", "b": True, "y": b"1"}, {"l": 2.9, "d": float("nan"), "s": None}, {}, {"l": 4, "d": 2.5, "other": 1}]
    schema = "l long, d double, s string, b boolean, y binary"

    def features(text):
        return values[int(text)]

    df = frame(spark, [str(i % 4) for i in range(2 * PART_ROWS + 7)]).repartition(1)
    got = [tuple(r) for r in CustomFunctionAnnotator(features, schema).annotate_dataframe(df).select("l", "d", "s", "b", "y", "text").collect()]
    plain = CustomFunctionAnnotator(lambda text: {**features(text), "a": [text]}, f"{schema}, a array<string>").annotate_dataframe(df)
    assert got == [tuple(r) for r in plain.select("l", "d", "s", "b", "y", "text").where("a[0] = text").collect()] and len(got) == 2 * PART_ROWS + 7
    assert got[:4] == [(1, 1.0, "x", True, b"1", "0"), (2, None, None, None, None, "1"), (None, None, None, None, None, "2"), (4, 2.5, None, None, None, "3")]


REPLIES = {
    "good": '```json\n{"topic": "Mathematics", "education": "high school"}\n```', "odd": '{"topic": "Alchemy", "education": "nursery"}',
    "broken": "{not json", "list": "[1]", "value": ValueError("v"), "other": RuntimeError("o"),
}


def stand_in(replies):
    """A factory of clients that travels with the task."""

    def factory():
        def client(prompt):
            reply = next(v for k, v in replies.items() if f'"{k}' in prompt)
            if isinstance(reply, Exception):
                raise reply
            return reply

        return client

    return factory


def test_llm_annotator(spark):
    df = frame(spark, [*REPLIES, None, " ", "good" + "x" * 100])
    a = LLMAnnotator(stand_in(REPLIES), max_text_length=20)
    got = [(r["topic"], r["education"]) for r in a.annotate_dataframe(df).orderBy("i").collect()]
    errors = [(e, e) for e in ("Error: JSON Decode", "Error: API Call", "Error: API Value", "Error: API Call")]
    assert got == [("Mathematics", "high school"), (None, None), *errors, (None, None), (None, None), ("Mathematics", "high school")]
    assert '"' + "y" * 20 + '..."' in a.prompt("y" * 21)
    assert parse_response('{"topic": "Food & Culinary"}') == {"topic": "Food & Culinary", "education": None}
    a.open()
    assert a._client and a.__getstate__()["_client"] is None


def test_gemini_needs_its_package():
    with pytest.raises((ImportError, ValueError)):
        millrace.GeminiAnnotator()


def test_public_names():
    for name in millrace.__all__:
        assert getattr(millrace, name) is not None
    with pytest.raises(AttributeError):
        millrace.nothing
