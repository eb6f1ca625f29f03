import random
import zlib
from itertools import accumulate

import pytest
from pyspark.sql import functions as F

from millrace.llm.histogram import find_splitters, keyed
from millrace.llm.queries_sharding import op1_histogram_shards
from millrace.llm.sharding import histogram_shards


def shards(df, n, **more):
    size = F.coalesce(F.octet_length("text"), F.lit(0)) + 8
    return histogram_shards(df, "doc_id", size, F.xxhash64("text"), n, **more)


def check(rows, n, rows_in):
    assert len(rows) == rows_in
    for s in range(n):
        own = sorted(r["slot"] for r in rows if r["shard"] == s)
        assert own == list(range(len(own)))


def test_edges(spark, edge, edge_rows, empty):
    clash = edge.withColumn("shard", F.lit("mine")).withColumn("SLOT", F.lit(1)).withColumn("size", F.lit(1)).withColumn("tie", F.lit(1))
    got = shards(clash, 4)
    assert got.columns == [*edge.columns, "size", "tie", "shard", "slot"]
    check(got.collect(), 4, len(edge_rows))
    assert shards(empty, 4).count() == 0
    assert {r["shard"] for r in shards(edge, 1).collect()} == {0}


@pytest.mark.parametrize("task_rows", [1 << 30, 30])
def test_a_hot_key_and_repeated_rows_are_divided(spark, task_rows):
    df = spark.range(9000).selectExpr("CASE WHEN id % 3 = 0 THEN 7 WHEN id % 3 = 1 THEN 9 ELSE id END AS doc_id", "CASE WHEN id % 3 = 0 THEN 'same' ELSE cast(id + 10000 as string) END AS text")
    rows = shards(df, 24, task_rows=task_rows).collect()
    check(rows, 24, 9000)
    sizes = [sum(len(r["text"]) + 8 for r in rows if r["shard"] == s) for s in range(24)]
    assert max(sizes) - min(sizes) <= 2 * 13
    order = [r["doc_id"] for r in sorted(rows, key=lambda r: (r["shard"], r["slot"]))]
    assert order == sorted(order)


def test_splitters_count_exactly(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("k"), (F.col("id") % 13 + 1).alias("w"))
    table = keyed(df, "k", F.col("w"), F.lit(0))
    cuts = find_splitters(table, 10, 0.001)
    rows = [(r["k"], r["w"]) for r in df.collect()]
    for (key, *_), weight, count in zip(cuts.keys, cuts.weights[1:], cuts.rows[1:]):
        assert weight == sum(w for k, w in rows if k < key) and count == sum(k < key for k, _ in rows)
    assert cuts.total_weight == sum(w for _, w in rows)
    assert max(abs(w - i * cuts.total_weight / 10) for i, w in enumerate(cuts.weights)) <= 13


def test_shards_equal_brute_force(spark):
    """Cuts at the row's edge nearest each even share, keys in order."""
    rnd = random.Random(4)
    rows = [(k, "x" * rnd.choice((0, 3, 40, 900))) for k in rnd.sample(range(-500, 5000), 700)]
    got = {r["doc_id"]: (r["shard"], r["slot"]) for r in shards(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), 7).collect()}
    rows.sort()
    upto = [0, *accumulate(len(t) + 8 for _, t in rows)]
    cuts = [min(range(len(upto)), key=lambda i: abs(upto[i] - j * upto[-1] / 7)) for j in range(1, 7)]
    for i, (k, _) in enumerate(rows):
        shard = sum(c <= i for c in cuts)
        assert got[k] == (shard, i - (0, *cuts)[shard])


def test_the_plan_does_not_grow_with_the_parts(spark):
    df = spark.range(3000).selectExpr("id AS doc_id", "'x' AS text")
    sizes = [len(shards(df, 2, task_rows=n)._jdf.queryExecution().optimizedPlan().toString()) for n in (10_000, 3)]
    assert sizes[1] < sizes[0] + 200


def test_query(spark, tmp_path, edge, edge_rows):
    edge.write.parquet(str(tmp_path / "documents.parquet"))
    rows = op1_histogram_shards(spark, str(tmp_path)).collect()
    want = sorted((r[0] is not None, r[0] or 0, len((r[1] or "").encode()) + 8, zlib.crc32((r[1] or "").encode())) for r in edge_rows)
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["size"], r["text_crc32"]) for r in rows) == want
    assert {(r["law"], r["grown_shard"]) for r in rows} == {("bytes", None)}
