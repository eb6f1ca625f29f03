"""Sources, plans, vocabulary, streams and the command line, in temporary folders."""

import csv
import json

import pytest
from pyspark.sql import functions as F

from millrace import cli
from millrace.operators.annotate import CustomFunctionAnnotator, ExpressionAnnotator
from millrace.operators.synonyms import canonical_by_synset
from millrace.plans.pipeline import DataPipeline, Plan, process_corpus
from millrace.plans.vocabulary import SEED, build_vocabulary
from millrace.sources import io, staging
from millrace.sources.mappings import CEFRIndex, load_mapping
from millrace.streaming.text import prepare_stream, write_stream

TEXTS = ["The cat sat!", "the cat  sat !", "Dogs utilize DNA.", "Dogs use DNA.", "###", None, "Extraordinarily electromagnetic characterization."]


@pytest.fixture
def corpus(spark, tmp_path):
    path = str(tmp_path / "in.parquet")
    spark.createDataFrame(list(enumerate(TEXTS)), "n long, text string").coalesce(1).write.parquet(path)
    return path


def test_read_parquet_contract(spark, tmp_path, corpus):
    assert io.read_parquet(corpus, spark=spark).count() == 7
    with pytest.raises(FileNotFoundError):
        io.read_parquet(str(tmp_path / "nothing"), spark=spark)
    with pytest.raises(ValueError, match="n"):
        io.read_parquet(corpus, "body", spark)
    assert io.ORDER in io.read_parquet(corpus, spark=spark, order=True).columns


def test_process_corpus(spark, tmp_path, corpus):
    out = str(tmp_path / "out.parquet")
    found = process_corpus(corpus, out, max_grade=45.0, synonyms_map={"utilize": "use"}, spark=spark)
    rows = {r["n"]: r["text"] for r in spark.read.parquet(out).collect()}
    assert rows == {0: "the cat sat !", 2: "dogs use dna ."}
    assert found["total_rows"] == 2 and json.loads((tmp_path / "out.json").read_text())["total_rows"] == 2
    assert process_corpus(corpus, out, keywords=["dna"], max_grade=None, normalize=False, dedup=False, generate_stats=False, spark=spark) == {}
    assert spark.read.parquet(out).count() == 2


def test_early_dedup_gives_the_same_rows(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS * 5)], "n long, text string").repartition(3)
    plans = [Plan(early_dedup=e).with_keywords(["the", "dogs"]).with_readability(45).with_synonyms({"utilize": "use"}) for e in (False, True)]
    a, b = (sorted(map(tuple, p.apply(df, order=F.col("n")).collect())) for p in plans)
    assert a == b == [(0, "the cat sat !"), (2, "dogs use dna .")]


def test_pipeline_counts_its_stages(spark, corpus):
    p = DataPipeline().add_keyword_filter(["cat", "dogs"]).add_keyword_filter([]).add_readability_filter(50).add_synonym_mapper({"utilize": "use"})
    p.add_annotator(ExpressionAnnotator(lambda c: {"n_chars": F.length(c)})).add_annotator(CustomFunctionAnnotator(lambda s: {"q": "?" in s}, "q boolean"))
    out = p.process(io.read_parquet(corpus, spark=spark))
    assert out.columns == ["n", "text", "n_chars", "q"] and len(out.collect()) == 2
    assert p.stage_counts() == {"input": 7, "normalized": 5, "filter 1: keywords": 4, "filter 2: readability": 4, "deduplicated": 2}
    with pytest.raises(ValueError):
        p.process(spark.range(1))


def test_wiki_and_shards(spark, tmp_path):
    deep = tmp_path / "wiki" / "AA"
    deep.mkdir(parents=True)
    (deep / "wiki_00").write_text('{"title": "A", "text": "a  b\\nc", "id": 1}\n\n{broken\n{"title": "B"}\n{"text": null, "title": "C"}\n', encoding="utf-8")
    (deep / "other").write_text('{"title": "no"}\n')
    rows = sorted(map(tuple, io.read_wiki_jsonl(str(tmp_path / "wiki"), spark).collect()))
    assert rows == [("wiki_00", "A", "a  b\nc", 6, 3, "N-A", 0), ("wiki_00", "B", "", 0, 0, "N-A", 0), ("wiki_00", "C", "", 0, 0, "N-A", 0)]
    paths = io.shard_paths(str(tmp_path), 0, 2)
    for p, texts in zip(paths, (["x"], ["x", "y"])):
        io.from_texts(texts, spark).write.parquet(p)
    assert io.combine_shards(paths[:1], "unused", spark) == paths[0]
    assert spark.read.parquet(io.combine_shards(paths, str(tmp_path / "all.parquet"), spark)).count() == 3
    spark.range(1).withColumn("text", F.lit("z")).write.parquet(str(tmp_path / "odd.parquet"))
    with pytest.raises(ValueError):
        io.combine_shards([*paths, str(tmp_path / "odd.parquet")], str(tmp_path / "no.parquet"), spark)


def test_lines_and_ndjson(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one\ntwo\n")
    (tmp_path / "a.json").write_text('{"text": "one"}\n{"text": "two"}\n')
    assert {r["text"] for r in io.read_lines(str(tmp_path / "a.txt"), spark).collect()} == {r["text"] for r in io.read_ndjson(str(tmp_path / "a.json"), spark=spark).collect()} == {"one", "two"}
    with pytest.raises(ValueError):
        io.read_ndjson(str(tmp_path / "a.json"), "body", spark)


def test_spread_exchanges_only_small_scans(spark, tmp_path):
    one, many = str(tmp_path / "one x"), str(tmp_path / "many")
    spark.range(100).coalesce(1).write.parquet(one)
    spark.range(100).repartition(9).write.parquet(many)

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    spread = io.spread(spark.read.parquet(one))
    assert "RoundRobin" in plan(spread) and spread.count() == 100 and "PushedFilters: [IsNotNull(id), LessThan(id,5)]" in plan(spread.where("id < 5"))
    assert "RoundRobin" not in plan(io.spread(spark.read.parquet(many))) and "RoundRobin" not in plan(io.spread(spark.range(5)))


def test_scratch_tables_go(spark):
    kept = staging.stage(spark.range(3), "kept")
    with staging.scratch():
        inside = staging.stage(spark.range(4), "inside")
        assert inside.count() == 4
        path = staging.filesystem(inside.inputFiles()[0])[1]
    fs = staging.filesystem(staging.work_dir(spark))[0]
    assert fs.get_file_info(path).type.name == "NotFound" and kept.count() == 3


def test_load_mapping(tmp_path):
    def at(name, text):
        (tmp_path / name).write_text(text)
        return str(tmp_path / name)

    assert load_mapping(at("m.json", '{" Big ": "LARGE", "same": "same", "none": ""}')) == {"big": "large", "same": "same", "none": ""}
    assert load_mapping(at("m.csv", "source,TO,From\nx,easy,Hard\ny,easier,hard\nz,same,same\nshort\nq,,w\n")) == {"hard": "easier"}
    assert load_mapping(at("n.csv", "a,b\nc,d\n")) == {"c": "d"}
    with pytest.raises(ValueError):
        load_mapping(at("bad.txt", ""))


CEFR = [("a", "B2"), ("cat", "A1"), ("Cat ", "B1"), ("use", "A2"), ("utilize", "C1"), ("boxes", "B2"), ("box", "A1"), ("a.m.", "C1"), ("huge", "c2"), ("big", "A1"), ("odd", "Z9"), ("", "A1"), ("large", "A2"), ("mid", "B1")]


@pytest.fixture
def cefr_csv(tmp_path):
    path = tmp_path / "cefr.csv"
    with path.open("w", newline="") as f:
        csv.writer(f).writerows([("Headword", "cefr"), *CEFR])
    return str(path)


def test_cefr_index(spark, cefr_csv):
    index = CEFRIndex.from_csv(cefr_csv, spark)
    assert index.rank("CAT") == 0 and index.rank("odd") is None and index.rank("huge") == 5
    assert index.is_easy("use") and not index.is_easy("mid") and not index.is_easy("nope")
    assert index.is_difficult("huge") and index.is_difficult("mid", ["B1", "C2"]) and not index.is_difficult("cat")


def test_vocabulary(spark, cefr_csv, tmp_path):
    index = CEFRIndex.from_csv(cefr_csv, spark)
    thesaurus = spark.createDataFrame([("huge", "big", 5), ("huge", "large", 9), ("huge", "very_big", 99), ("huge", "huge", 1), ("utilize", "cat", 1)], "word string, synonym string, freq long")
    built = build_vocabulary(index, thesaurus)
    rows = {r["from"]: tuple(r)[1:] for r in built.mapping.collect()}
    assert rows == {"utilize": ("use", "manual", "C1", "A2"), "huge": ("big", "wordnet", "C2", "A1"), "boxes": ("box", "lemma_fallback", "B2", "A1")}
    assert [r["headword"] for r in built.unmapped.collect()] == ["a.m."]
    assert build_vocabulary(index, thesaurus, min_alpha_only=True).unmapped.count() == 0
    assert build_vocabulary(index, include_b1=True).report() == {"targets": 5, "mapped": 2, "unmapped": 3}
    found = built.write(str(tmp_path / "voc"))
    assert found == {"targets": 4, "mapped": 3, "unmapped": 1}
    assert json.loads((tmp_path / "voc/synonyms.json").read_text()) == {"boxes": "box", "huge": "big", "utilize": "use"}
    assert (tmp_path / "voc/synonyms.csv").read_text().splitlines()[:2] == ["from,to,source,from_cefr,to_cefr", "boxes,box,lemma_fallback,B2,A1"]
    assert (tmp_path / "voc/unmapped.txt").read_text() == "a.m.\n" and "Mapped: 3 (75.00%)" in (tmp_path / "voc/build_stats.txt").read_text()
    assert sum(len(v.split()) for v in SEED.values()) == 40


def test_synsets(spark):
    rows = spark.createDataFrame([(1, 1, "big"), (1, 2, "Large"), (2, 1, "grand"), (2, 2, "large"), (2, 3, "very_big")], "synset_order int, lemma_order int, lemma string")
    assert {r["word"]: r["canonical"] for r in canonical_by_synset(rows).collect()} == {"large": "big", "very big": "grand"}


def test_stream(spark, tmp_path, corpus):
    df = spark.readStream.schema("n long, text string").parquet(corpus)
    plan = Plan().with_keywords(["cat", "dogs"]).with_synonyms({"utilize": "use"})
    write_stream(prepare_stream(df, plan), str(tmp_path / "s"), str(tmp_path / "c")).awaitTermination(60)
    assert {r["text"] for r in spark.read.parquet(str(tmp_path / "s")).collect()} == {"the cat sat !", "dogs use dna ."}
    with pytest.raises(ValueError):
        plan.stream(df)


def test_cli(spark, tmp_path, corpus, cefr_csv):
    out = str(tmp_path / "cli.parquet")
    assert cli.main(["corpus", "--input", corpus, "--output", out, "--keywords", " cat ,,", "--no-stats"], spark) == 0
    assert spark.read.parquet(out).count() == 1 and not (tmp_path / "cli.json").exists()
    assert cli.main(["corpus", "--input", str(tmp_path / "gone"), "--output", out], spark) == 1
    assert cli.main(["vocabulary", "--cefr_csv", cefr_csv, "--out_dir", str(tmp_path / "v")], spark) == 0
    (tmp_path / "wiki_1").write_text('{"title": "A", "text": "x"}\n')
    assert cli.main(["ingest", "--source", "wikipedia", "--input-dir", str(tmp_path), "--output-dir", str(tmp_path / "raw")], spark) == 0
    assert cli.main(["ingest", "--source", "other", "--input-dir", str(tmp_path)], spark) == 1
    assert cli.split_keywords(None) == []
