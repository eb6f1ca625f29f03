import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from millrace.llm import bpe, planes
from millrace.llm.planes import PlaneReader, PlaneWriter, from_planes, read_tokens, to_planes, write_tokens
from millrace.llm.queries_tokens import op3_token_planes

VOCAB = bpe.default_vocab()
WHOLE = Tokenizer.from_file(VOCAB)


def ids_of(text):
    return WHOLE.encode(text or "", add_special_tokens=False).ids


def test_chunks_equal_whole_texts(monkeypatch):
    rnd = random.Random(1)
    parts = [*"ab 1'.,\n\t\r\x0b\x1c\x85\xa0 　é世😀_-", "  ", "'s", "'ll", "<|endoftext|>", "The", " the", "\x00", "​", "᠎", "ß.", "Ÿ", "x" * 60]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randrange(40))) for _ in range(3000)]
    monkeypatch.setattr(bpe, "_REMEMBERED", 500)
    enc = bpe.ChunkEncoder(VOCAB)
    for k in range(0, len(texts), 300):
        got = enc.encode(texts[k : k + 300])
        assert [np.frombuffer(g, "<u2").tolist() for g in got] == [ids_of(t) for t in texts[k : k + 300]]
    assert enc.encode([]) == [] and enc.encode([""]) == [b""]


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    assert np.frombuffer(bpe.encoder(VOCAB).encode([text])[0], "<u2").tolist() == ids_of(text)


@pytest.mark.parametrize("kind", ["byte", "bit"])
@pytest.mark.parametrize("width", [2, 4])
def test_planes_round_trip(kind, width):
    for n in (1, 7, 8, 1000):
        ids = np.random.default_rng(n).integers(0, 1 << (8 * width), n, dtype=np.uint64).astype(f"<u{width}")
        assert (from_planes(to_planes(ids, kind), n, width, kind) == ids).all()


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_file_round_trip_and_random_reads(tmp_path, kind):
    rng = np.random.default_rng(0)
    docs = [(None if k == 3 else k - 5, rng.integers(0, 50257, n).astype("<u2")) for k, n in enumerate([3, 0, 100, 1, 999, 16, 0])]
    w = PlaneWriter(f"file://{tmp_path}/a/x.planes", 2, 64, kind)
    for doc_id, ids in docs:
        w.add(doc_id, ids.tobytes())
    w.close()
    r = PlaneReader(f"{tmp_path}/a/x.planes")
    got = list(r.documents())
    assert [(i, ids.tolist()) for i, _, ids in got] == [(i, ids.tolist()) for i, ids in docs]
    whole = np.concatenate([ids for _, ids in docs])
    for start, n in ((0, 5), (60, 10), (500, 300), (len(whole) - 1, 1), (7, 0)):
        assert r.read(start, n).tolist() == whole[start : start + n].tolist()
    assert r.footer["ids"] == len(whole)
    (tmp_path / "bad").write_bytes(b"no such file at all")
    with pytest.raises(ValueError):
        PlaneReader(str(tmp_path / "bad"))


def expected(rows):
    """(id, n_tokens, crc) by id; starts are checked apart, for equal ids may come in any order."""
    out = []
    for doc_id, text in rows:
        ids = np.array([*ids_of(text), 2], "<u4")
        out.append((doc_id is not None, doc_id or 0, len(ids), zlib.crc32(ids.tobytes())))
    return sorted(out)


def check(rows, docs):
    assert sorted((r[0] is not None, r[0] or 0, r[2], r[3]) for r in rows) == expected(docs)
    at = 0
    for doc_id, start, n, _ in sorted(rows, key=lambda r: r[1]):
        assert start == at
        at += n
    order = [(r[0] is not None, r[0] or 0) for r in sorted(rows, key=lambda r: r[1])]
    assert order == sorted(order)


@pytest.mark.parametrize("file_bytes", [1 << 20, 2000])
def test_edges(edge, edge_rows, empty, tmp_path, file_bytes):
    files = write_tokens(edge, f"file://{tmp_path}/t", VOCAB, 2, file_bytes=file_bytes, block=128, kind="bit")
    check([tuple(r) for r in read_tokens(files).collect()], [r[:2] for r in edge_rows])
    assert files.count() > 1 or file_bytes > 2000
    assert read_tokens(write_tokens(empty, f"file://{tmp_path}/e", VOCAB, 2)).count() == 0


def test_a_retried_write_leaves_one_file(tmp_path):
    for _ in range(2):
        w = PlaneWriter(f"{tmp_path}/f.planes")
        w.add(1, b"\1\0")
        w.close()
    assert [p.name for p in tmp_path.iterdir()] == ["f.planes"]


def test_query(spark, edge, edge_rows, tmp_path):
    edge.write.parquet(str(tmp_path / "documents.parquet"))
    df = op3_token_planes(spark, str(tmp_path))
    assert df.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    check([tuple(r) for r in df.collect()], [r[:2] for r in edge_rows])
    assert planes.MAGIC
