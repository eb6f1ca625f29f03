"""The corpus pipeline against a plain version of every stage, and each stage on odd tables."""

import random
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from millrace.llm.bpe import default_vocab
from millrace.llm.queries_mixing import SEED
from millrace.llm.secrets import redact_text
from tests.llm.test_mixing import plain_targets, words
from tests.llm.test_packing import check, pieces_of
from tests.llm.test_scans import PLAIN, plain_quality
from tests.llm.test_simhash import brute_groups

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WHOLE = Tokenizer.from_file(default_vocab())


def corpus():
    """Prose, near and exact copies, junk, short texts and secrets, half of it from one source."""
    rnd = random.Random(11)
    bank = (PLAIN + "Children played near the bridge, and on market days a small crowd gathered to hear stories, to buy bread and to watch boats pass under the willow trees. ").split()
    rows = []
    for i in range(90):
        text = " ".join(rnd.choice(bank) for _ in range(rnd.randrange(20, 400)))
        if i % 9 == 0 and rows:
            text = rows[-3][1]
        if i % 10 == 1:
            text += f' token = "{rnd.getrandbits(160):040x}"'
        if i % 11 == 2:
            text = "the same words " * 60
        rows.append((i * 3, text, "en", "big" if i % 2 else f"s{i % 5}", len(text)))
    rows.append((500, rows[4][1] + " again", None, None, None))
    return rows + [(600, None, None, None, None), (None, " ".join(bank * 2), "en", "big", 1)]


def kept_by_quality(rows):
    return [r for r in rows if not plain_quality(r[1])[5]]


def one_of_each_group(rows):
    """The rows that the near-dedup keeps: of a group the least id, null only where all are."""
    best = {}
    for r, group in zip(rows, brute_groups([r[1] for r in rows], corpus_pipeline.COPY_VIEWS, corpus_pipeline.COPY_RADIUS)):
        if group not in best or (r[0] is None, r[0] or 0) < (best[group][0] is None, best[group][0] or 0):
            best[group] = r
    return list(best.values())


def plain_mix(rows):
    import hashlib

    sizes = {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + words(r[1])
    aims, out = plain_targets(sizes), []
    for source, aim in aims.items():
        own = sorted((r for r in rows if r[3] == source), key=lambda r: (words(r[1]), r[0] is not None, r[0] or 0))
        u = Fraction(int(hashlib.md5((SEED + (source or "")).encode()).hexdigest()[:8], 16), 1 << 32)
        rate = aim / sizes[source] if sizes[source] else 0
        for k, r in enumerate(own):
            out += [r] * int((rate * (k + 1) + u) // 1 - (rate * k + u) // 1)
    return out


def test_run_equals_the_plain_version(spark, tmp_path):
    rows = corpus()
    spark.createDataFrame(rows, SCHEMA).repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    kept = one_of_each_group(kept_by_quality(rows))
    assert 20 < len(kept) < len(rows)
    clean = [(r[0], redact_text(r[1]), *r[2:]) for r in kept]
    want = Counter(p for r in plain_mix(clean) for p in pieces_of(r[0], r[1]))
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    tokens = sum(r["length"] for r in got)
    assert -(-tokens // 1024) <= check(got, 1024) <= 1.1 * tokens / 1024 + 1


@pytest.mark.parametrize("k", range(5))
def test_stages_keep_foreign_columns_and_take_odd_tables(spark, edge, empty, k):
    name, stage = corpus_pipeline.STAGES[k]
    clash = {"size": 1, "script": 2, "copies": 3, "id": 4, "fp": 5, "component_id": 6, "spans": 7, "row": 8, "kept": 9, "offset": 10, "taken": 11}
    odd = edge.withColumns({c: F.lit(v) for c, v in clash.items()})
    out = stage(spark, odd, "")
    if k < 4:
        assert out.columns == odd.columns
        assert all(tuple(r[c] for c in clash) == tuple(clash.values()) for r in out.collect())
        assert stage(spark, empty, "").columns == empty.columns
    else:
        assert out.count() >= edge.count()
    assert stage(spark, empty, "").count() == 0


def test_secrets_are_gone_and_lengths_follow(spark, edge):
    rows = spark.createDataFrame([(1, 'x token = "f91f2b873bc89b9c5b8b3a486adf32c8523be758" y', "en", "a", 55), (2, None, None, None, None)], SCHEMA)
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in corpus_pipeline.secrets(spark, rows, "").collect()}
    assert got == {1: ('x token = "[assign]" y', 22), 2: (None, None)}


def test_stages_are_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_dedup", "secret_scan", "source_mix", "best_fit_packing"]
    assert re and np and WHOLE
