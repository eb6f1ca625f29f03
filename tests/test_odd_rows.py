"""Queries give their SQL's rows on texts that the test tables lack."""

import time

import duckdb
import pytest

import __spark_entry__ as entry
from tests.test_oracle import rows_of

TEXTS = ["The und FÜR que", "", None, " ", "\n\t", "\x1c\x1f", "et", "x" * 15_001, "?"]


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("odd"))
    rows = [(i, t, "en", "src0", len(t or "")) for i, t in enumerate(TEXTS)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1).write.parquet(f"{path}/documents.parquet")
    return path


@pytest.mark.parametrize("name", ["annotate_llm", "synonym_native", "synonym_arrow", "synonym_join"])
def test_query_equals_sql_on_odd_texts(spark, odd, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{odd}/documents.parquet/*.parquet'")
    assert rows_of(entry.queries()[name](spark, odd).toPandas()) == rows_of(con.execute(entry.oracle_sql()[name]).df())


@pytest.mark.parametrize("name", ["prepared_corpus", "prepared_and_annotated"])
def test_plan_equals_sql_on_long_white_space_in_time(spark, tmp_path, name):
    gap = "\n" * 100_000
    texts = [f"The end{gap}que. Und so", f"the{gap}end", gap, f"the {gap} . , !", "The  end\t.\n\n?que", f"{gap} THE end !!"]
    rows = [(i, t, "en", "src0", len(t)) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    began = time.time()
    got = entry.queries()[name](spark, str(tmp_path)).toPandas()
    assert time.time() - began < 30
    assert len(got) > 2 and rows_of(got) == rows_of(con.execute(entry.oracle_sql()[name]).df())
