import os
import re
from collections import Counter
from fractions import Fraction

import duckdb
import pytest
from pyspark.sql import functions as F

from millrace.llm.mixing import mix, take, targets, word_count
from millrace.llm.queries_mixing import OP8_SQL, op8_systematic_mix

WEIGHTS = (5, 2, 1)


def plain_targets(sizes):
    """Reshare what is above, again and again, in exact fractions."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: WEIGHTS[i % 3] for i, s in enumerate(order)}
    total, full, out = sum(sizes.values()), set(), {}
    while True:
        left = Fraction(total - sum(3 * sizes[s] for s in full))
        share = sum(weight[s] for s in sizes if s not in full)
        out = {s: Fraction(3 * sizes[s]) if s in full else left * weight[s] / share for s in sizes}
        above = {s for s in sizes if s not in full and out[s] > 3 * sizes[s]}
        if not above:
            return out
        full |= above


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def mixed(df):
    return mix(df, word_count(F.col("text")), WEIGHTS, tie=F.xxhash64("text"))


def check(rows, docs):
    """rows: (id, source, size, source_size, target, copies, taken)."""
    assert Counter((r[0], r[1], r[2]) for r in rows) == Counter((d[0], d[3], words(d[1])) for d in docs)
    sizes = {}
    for d in docs:
        sizes[d[3]] = sizes.get(d[3], 0) + words(d[1])
    aims = plain_targets(sizes)
    for source, size in sizes.items():
        own = [r for r in rows if r[1] == source]
        assert {r[3] for r in own} == {size} and all(r[4] == pytest.approx(float(aims[source])) for r in own)
        assert all(r[5] <= 3 and r[6] == r[5] * r[2] for r in own)
        if size:
            rate = aims[source] / size
            assert {r[5] for r in own} <= {int(rate), -(-rate.numerator // rate.denominator)}
            assert abs(sum(r[6] for r in own) - aims[source]) <= max(r[2] for r in own) + 1e-6


def rows_of(df):
    return [tuple(r) for r in df.select("doc_id", "source", "size", "source_size", "target", "copies", "taken").collect()]


def test_edges(edge, edge_rows, empty):
    check(rows_of(mixed(edge)), edge_rows)
    assert mixed(empty).count() == 0
    wordless = edge.where("text IS NULL OR trim(text) = ''")
    assert {r[6] for r in rows_of(mixed(wordless))} == {0}


def test_clashing_columns_and_reruns(spark, edge):
    clash = edge.withColumn("taken", F.lit("old")).withColumn("SIZE", F.lit("old")).withColumn("pid", F.lit(1)).withColumn("rate", F.lit(2)).withColumn("src", F.lit("s"))
    got = mix(clash, word_count(F.col("text")), WEIGHTS, tie=F.xxhash64("text"))
    assert got.columns == [*edge.columns, "pid", "rate", "src", "size", "source_size", "target", "copies", "taken"]
    assert Counter(rows_of(got)) == Counter(rows_of(mixed(edge.repartition(7))))


def test_a_hot_source_over_many_tasks(spark):
    docs = [(i, "w " * (i * 37 % 50 + 1), "en", "hot" if i % 3 else f"s{i % 7}", 0) for i in range(4000)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").repartition(8)
    check(rows_of(mixed(df)), docs)


def test_take_repeats_rows(spark):
    df = spark.createDataFrame([(1, 0), (2, 3), (3, 1)], "i long, copies long")
    assert sorted(r["i"] for r in take(df, ["i"]).collect()) == [2, 2, 2, 3]


@pytest.mark.parametrize("sizes", [{"a": 1, "b": 1, "c": 1000}, {"a": 10, "b": 0, None: 500, "é": 3, "Z": 7}, {"x": 0}, {f"s{i:03d}": i * i % 97 for i in range(60)}])
def test_targets_equal_resharing(spark, sizes):
    df = spark.createDataFrame([(k, 1, v) for k, v in sizes.items()], "source string, n_docs long, source_size long")
    got = {r["source"]: r["target"] for r in targets(df, WEIGHTS, 3).collect()}
    assert got == {k: pytest.approx(float(v)) for k, v in plain_targets(sizes).items()}


def test_word_count(spark):
    texts = ["", None, " a ", "a\tb\x0bc\x0cd\re\nf  g", "a\xa0b", "\x1ca b"]
    df = spark.createDataFrame([(t,) for t in texts], "text string").select("text", word_count(F.col("text")).alias("n"))
    assert all(r["n"] == words(r["text"]) for r in df.collect())


@pytest.mark.parametrize("name", ["edge", "sf0.001"])
def test_query_equals_sql(spark, edge, tmp_path, name):
    if name == "edge":
        folder = str(tmp_path)
        # SQL orders rows of one id arbitrarily, so ids are made unique here
        edge.coalesce(1).where("text IS NOT NULL").withColumn("doc_id", F.monotonically_increasing_id()).write.parquet(f"{folder}/documents.parquet")
        files = f"{folder}/documents.parquet/*.parquet"
    else:
        folder, files = "/root/testdata/sf0.001", "/root/testdata/sf0.001/documents.parquet"
        if not os.path.exists(files):
            pytest.skip("no test tables")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{files}'")
    columns = ["doc_id", "size", "source_size", "target", "taken"]
    got = sorted(map(tuple, op8_systematic_mix(spark, folder).select(columns).collect()))
    assert got == sorted(con.execute(f"SELECT {', '.join(columns)} FROM ({OP8_SQL})").fetchall())
