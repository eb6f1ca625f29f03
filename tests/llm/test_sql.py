"""SQL for what it can say of the operators' queries, on the smallest tables."""

import os

import duckdb
import pytest

from millrace.llm import registry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PHRASES = {"gpl": "gnu general public license", "apache": "apache license", "cc-by": "cc by", "mit": "mit license"}
STARTS = {k: " AND ".join(f"w[i + {n}] = '{x}'" for n, x in enumerate(p.split())) for k, p in PHRASES.items()}
SPLIT = r"[^\x20\x09-\x0D]+"

SQL = {
    "op1_histogram_shards": registry.oracle_sql()["op1_histogram_shards"],
    "op2_license_automaton": rf"""
      WITH words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
      placed AS (SELECT doc_id, w, {", ".join(f'list_filter(range(1, len(w) + 1), lambda i: {c}) AS "{k}"' for k, c in STARTS.items())} FROM words),
      found AS (SELECT *, list_concat(gpl, apache, "cc-by", mit) AS places FROM placed)
      SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(places) AS BIGINT) AS n_base, list_min(places) - 1 AS first_word, list_max(places) - 1 AS last_word,
             concat_ws(',', {", ".join(f"CASE WHEN len({chr(34)}{k}{chr(34)}) > 0 THEN '{k}' END" for k in sorted(PHRASES))}) AS base_labels FROM found""",
    "op5_tokenizer_fertility": rf"""
      WITH words AS (SELECT doc_id, text, regexp_extract_all(coalesce(text, ''), '{SPLIT}') AS w, list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{SPLIT}')) AS l FROM documents),
      windows AS (SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, w FROM words),
      grams AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS n FROM windows),
      again AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM grams WHERE n > 1) GROUP BY doc_id)
      SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars, CAST(len(regexp_extract_all(coalesce(text, ''), '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
             CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, len(w) < 50 OR 100 * coalesce(n_repeat_words, 0) > 50 * len(w) AS base_failed
      FROM words LEFT JOIN again USING (doc_id)""",
    "op9_assignment_lexer": r"""
      SELECT doc_id, CAST(len(list_filter(regexp_extract_all(coalesce(text, ''), '(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 1), lambda x: length(x) >= 12)) AS BIGINT) AS n_assign,
             CAST(len(list_filter(regexp_extract_all(coalesce(text, ''), 'AKIA[A-Z0-9]+'), lambda x: length(x) >= 18)) AS BIGINT) AS n_access,
             CAST(len(list_filter(regexp_extract_all(coalesce(text, ''), '[0-9a-f]+'), lambda x: length(x) >= 16)) AS BIGINT) AS n_hex FROM documents""",
}


@pytest.mark.parametrize("name", SQL)
def test_base_columns_equal_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = con.execute(SQL[name])
    columns = [c[0] for c in want.description]
    assert sorted(map(repr, map(tuple, registry.queries()[name](spark, SF).select(*columns).collect()))) == sorted(map(repr, want.fetchall()))
