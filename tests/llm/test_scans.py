"""Licence scans, secret scans and quality rules against plain versions."""

import hashlib
import random
import re

import numpy as np
from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace.llm.licenses import PHRASES, TEMPLATES, Scanner, SuffixAutomaton, scan_licenses, words_of
from millrace.llm.quality import Band, count_repeats, quality_rules
from millrace.llm.queries_licenses import op2_license_automaton
from millrace.llm.queries_quality import op5_tokenizer_fertility
from millrace.llm.queries_secrets import op9_assignment_lexer
from millrace.llm.secrets import literal_spans, redact_text, redacted, scan_secrets, scan_text

ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# -- licences


def plain_licenses(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(ASCII_LOWER))
    places = [(k, label) for p, label in PHRASES.items() for k in range(len(words)) if words[k : k + len(p.split())] == p.split()]
    starts = [k for k, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


TEXTS = [
    "Released under the MIT License. GNU General Public LICENSE; apache-license cc by cc by", "MITlicense mit", "", None, "cc-by é CC BY", "ünï mit license é license",
    *[t for _, t in TEMPLATES], "Licensed under CC BY-NC 4.0.", " ".join(t for _, t in TEMPLATES) + " word" * 50,
]


def test_licenses_base(spark, edge, edge_rows, empty):
    df = spark.createDataFrame([(t,) for t in TEXTS], "text string").withColumn("labels", F.lit("old")).withColumn("SCORE", F.lit("old"))
    for r in scan_licenses(df).collect():
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == plain_licenses(r["text"])
        assert 0 <= r["score"] <= 1 and set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
    assert scan_licenses(empty).count() == 0
    got = {(r["doc_id"], r["text"]): r["n_words"] for r in scan_licenses(edge).collect()}
    assert got == {(r[0], r[1]): plain_licenses(r[1])[0] for r in edge_rows}


def test_every_template_is_found_whole_and_damaged():
    s = Scanner()
    for label, text in TEMPLATES:
        row = s.scan(f"Some words before. {text} And after it.".encode())
        assert row[6] == 1.0 and label in row[5].split(",")
        words = text.split()
        if len(words) > 30:
            words[10] = "changed"
            del words[20]
            row = s.scan(" ".join(words).encode())
            assert label in row[5].split(",") and 0.8 < row[6] < 1
    assert s.scan(b"The software is hereby granted to any person, and the license of the copyright holder.")[5] == ""


def test_copies_of_a_template_are_spans_of_their_own():
    notice = b"Licensed under the Boost Software. Distributed under the Boost Software License, Version 1.0"
    spans = [x for x in Scanner().scan(b" filler words in between them all ".join([notice] * 3))[7] if x[0] == "boost"]
    assert len(spans) == 3 and all(e - s == 9 for _, s, e, _ in spans)


def test_matching_statistics_equal_brute_force():
    rnd = random.Random(4)
    templates = [[rnd.randrange(4) for _ in range(rnd.randrange(1, 12))] for _ in range(6)]
    sam = SuffixAutomaton()
    for t, words in enumerate(templates):
        sam.add(words, t)
    sam.close()
    for _ in range(200):
        text = [rnd.randrange(5) for _ in range(20)]
        held = {tuple(w[i:j]) for w in templates for i in range(len(w)) for j in range(i + 1, len(w) + 1)}
        for k, (state, n) in enumerate(sam.statistics(text)):
            assert n == max((m for m in range(1, k + 2) if tuple(text[k + 1 - m : k + 1]) in held), default=0)
            want = {(t, j) for t, w in enumerate(templates) for j in range(n, len(w) + 1) if n and w[j - n : j] == text[k + 1 - n : k + 1]}
            assert not n or {x for x in sam.ends[state]} == want


def test_runs_of_template_words_give_what_the_whole_text_gives():
    s = Scanner()
    text = words_of(" ".join(t for _, t in TEMPLATES[:5]).encode()) + [b"zzz", b"the", b"software", b"zzz"] * 5
    ids = np.array([s.ids.get(w, -1) for w in text])
    stats = list(s.automaton.statistics(ids.tolist()))
    whole = {(t, end - n, k + 1 - n, n) for k, (q, n) in enumerate(stats) if n >= 3 and (k + 1 == len(stats) or stats[k + 1][1] <= n) for t, end in s.automaton.ends[q]}
    assert set(s.matches(ids)) == whole


# -- secrets


def plain_secrets(text):
    found = []
    for m in re.finditer(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 12:
            found.append((m.start(), "assign", m.end()))
    for kind, pattern, least in (("access", "AKIA[A-Z0-9]+", 18), ("hex", "[0-9a-f]+", 16)):
        found += [(m.start(), kind, m.end()) for m in re.finditer(pattern, text) if len(m[0]) >= least]
    found.sort(key=lambda x: (x[0], ("assign", "access", "hex").index(x[1])))
    joined = ",".join(f"{k}:{s}:{e}" for s, k, e in found)
    return *(sum(k == n for _, k, _ in found) for n in ("assign", "access", "hex")), hashlib.sha256(joined.encode()).hexdigest()


def test_secrets_base_on_random_text():
    rnd = random.Random(6)
    parts = ["password", "Token", "api_key", "APIKEY", "secret", "=", ": ", " = ", '"', "'", " ", "\n", "AKIA", "ABCDEFGH12345678", "abcdef0123456789", "x1y2z3", "é😀", ".", "deadbeef", "="]
    for _ in range(3000):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randrange(14)))
        row = scan_text(text)
        assert row[:4] == plain_secrets(text)
        spans = [s.split(":") for s in row[4].split(",") if s]
        assert all(0 <= int(a) < int(b) <= len(text) for _, a, b in spans)
        assert sum(k != "literal" for k, *_ in spans) == sum(row[:3])


CODE = {
    'db_pass = "hunter2!x9"\n': ["hunter2!x9"], "PRIVATE_KEY: aB3dE5fG7hI9\n": ["aB3dE5fG7hI9"], 'config["client_secret"] = "q8W2e4R6t9!z"': ["q8W2e4R6t9!z"],
    'a = "s3cr3t-va"\nb = a + "lue-77"\nauth_pass = b\n': ["s3cr3t-va", "lue-77"], 'part = "Zx9!kQ2@"\nsecret_key = f"{part}tail7Q"': ["Zx9!kQ2@", "{part}tail7Q"],
    "url = 'postgres://admin:Sup3rS3cret@db/x'": ["Sup3rS3cret"], "<connectionString>Xy12-Zw34-Qq56</connectionString>": ["Xy12-Zw34-Qq56"],
    'passphrase := `mul7i word phr4se! 9X`': [], 'password = "changeme"': [], "password_hint: ask 2 friends": [], "The token: a word in prose.": [], 'name = "John Smith 42 Street"': [],
    'token_count = 12345678901': [], "Note: secret = nothing more": [], 'api_key = "${API_KEY}"': [], 'unclosed_secret = "abc\n': [], "x == password": [], "": [],
}


@pytest.mark.parametrize("text", CODE)
def test_literals(text):
    assert [text[a:b] for a, b in literal_spans(text)] == CODE[text]


def test_literals_inside_base_spans_are_not_repeated():
    text = 'token = "f91f2b873bc89b9c5b8b3a486adf32c8523be758"'
    assert scan_text(text)[4] == "assign:0:49,hex:9:49"
    assert redact_text(text) == 'token = "[assign]"'
    assert redact_text("no secrets: none at all") == "no secrets: none at all"
    assert redact_text('db_pass = "hunter2!x9" # é') == 'db_pass = "[literal]" # é'


def test_many_secrets_stay_linear():
    text = 'secret = "aB3dE5fG7hI9"\nauth_pass = "q8W2e4R6t9!z"\n' * 20_000
    row = scan_text(text)
    assert row[0] == 20_000 and row[4].count("literal") == 20_000


def test_secrets_edges(spark, edge, edge_rows, empty):
    got = scan_secrets(edge.withColumn("spans", F.lit(1)).withColumn("n_HEX", F.lit(1)))
    assert got.columns == [*edge.columns, "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
    assert sorted((repr(r["doc_id"]), r["base_sha256"]) for r in got.collect()) == sorted((repr(r[0]), plain_secrets(r[1] or "")[3]) for r in edge_rows)
    assert scan_secrets(empty).count() == 0
    df = spark.createDataFrame([(None,), ("",), ('api_key = "abcdef0123456789abcd"',)], "text string")
    assert [r[0] for r in df.select(redacted(F.col("text"))).collect()] == [None, "", 'api_key = "[assign]"']


# -- quality


def plain_quality(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    again = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(again) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(again), failed


def test_quality_base(spark, edge, edge_rows, empty):
    rnd = random.Random(8)
    rows = [("".join(rnd.choice(["a", "bb", "é|", "#x", "語", " ", "\n", "\t", "\x0b", "\xa0", "\x1c", "same line\n"]) for _ in range(rnd.randrange(250))),) for _ in range(200)]
    df = spark.createDataFrame([*rows, (None,), ("",)], "text string").withColumn("KEPT", F.lit("old")).withColumn("entropy", F.lit("old"))
    for r in quality_rules(df).collect():
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == plain_quality(r["text"])
        assert not (r["base_failed"] and r["kept"])
    assert quality_rules(empty).count() == 0
    short = [r for r in edge_rows if len(r[1] or "") < 5000]
    got = sorted((repr(r["doc_id"]), r["n_words"], r["base_failed"]) for r in quality_rules(edge).where("n_words < 5000").collect())
    assert got == sorted((repr(r[0]), plain_quality(r[1])[0], plain_quality(r[1])[5]) for r in short)


PLAIN = "The old mill by the river was built of grey stone and had a wheel that turned slowly through every season of the year. Farmers from the valley brought their grain in heavy carts, waited under the trees and talked about prices, weather and the news from town while their flour was ground. "


def test_quality_verdicts(spark):
    cases = {PLAIN: True, " ".join(f"zq{i:x}xj{i * 7919:x}kw{i * 104729:x}" for i in range(80)): False, " ".join(chr(0x13000 + i) + chr(0x13100 + i) for i in range(60)): False}
    df = spark.createDataFrame([(t, lang) for t in cases for lang in ("en", None, "xx")], "text string, lang string")
    for r in quality_rules(df).collect():
        assert r["kept"] == cases[r["text"]], (r["chars_per_token"], r["byte_share"], r["entropy"])
    strict = quality_rules(df.limit(1), languages={"en": Band((9.0, 10.0), 0.0, (0.0, 1.0))}, scripts={})
    assert [r["kept"] for r in strict.collect()] == [False]
    assert quality_rules(df.drop("lang").limit(3)).where("kept").count() == 3


def plain_repeats(words):
    grams = list(zip(words, words[1:], words[2:]))
    return len({k + d for k, g in enumerate(grams) if grams.count(g) > 1 for d in range(3)})


@pytest.mark.parametrize("most", [2, 1 << 21])
def test_count_repeats(most):
    """Windows packed in an integer, and as tuples where a text has too many words to pack."""
    rnd = random.Random(1)
    for n in (0, 1, 2, 3, 4, 7, 60, 200):
        words = [b"%d" % rnd.randrange(6) for _ in range(n)]
        assert count_repeats(words, most) == plain_repeats(words)


def test_metrics_equal_plain_ones(spark, monkeypatch):
    """Fertility by whole definitions, while the memo is cut down again and again."""
    import math

    import public_tokenizers
    import sentencepiece

    from millrace.llm import quality

    monkeypatch.setattr(quality, "_REMEMBERED", 20)
    monkeypatch.setattr(quality, "_models", {})
    path = public_tokenizers.path(quality.DEFAULT_MODEL)
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    rnd = random.Random(2)
    bank = "river | mill 12 Größe *** naïve 日本 été bridge x1 __ вода !!".split() + ["z" * 60]
    texts = [" ".join(rnd.choice(bank) for _ in range(rnd.randrange(0, 90))) for _ in range(150)]
    got = dict(zip(quality.NAMES, quality.measure([t.encode() for t in texts], path)))
    for k, text in enumerate(texts):
        words = text.split()
        ids = [i for w in words for i in model.encode(w)]
        counts = Counter(ids)
        assert got["n_tokens"][k] == len(ids) and got["n_repeat_words"][k] == plain_repeats(words)
        assert got["n_letterless"][k] == sum(not any(c.isalpha() for c in w) for w in words)
        if ids:
            assert got["chars_per_token"][k] == pytest.approx(sum(map(len, words)) / len(ids))
            assert got["byte_share"][k] == pytest.approx(sum(model.is_byte(i) or model.is_unknown(i) for i in ids) / len(ids))
            assert got["entropy"][k] == pytest.approx(-sum(c / len(ids) * math.log2(c / len(ids)) for c in counts.values()), abs=1e-9)


def test_texts_of_signs_are_rejected(spark):
    prose = PLAIN.split()[:60]
    rows = [(1, " ".join(prose), "en"), (2, " | ".join(prose), "en"), (3, " ".join(w + " - " * (k % 5 == 0) for k, w in enumerate(prose)), "en")]
    got = {r["doc_id"]: r["kept"] for r in quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert got == {1: True, 2: False, 3: True}


def test_queries(spark, edge, edge_rows, tmp_path):
    edge.write.parquet(str(tmp_path / "documents.parquet"))
    want = {
        op2_license_automaton: ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
        op5_tokenizer_fertility: ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
        op9_assignment_lexer: ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    }
    for q, columns in want.items():
        df = q(spark, str(tmp_path))
        assert df.columns[: len(columns)] == columns and df.count() == len(edge_rows)
