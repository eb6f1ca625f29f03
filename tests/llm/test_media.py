import hashlib
import random
import wave
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import media
from millrace.llm.media import chunk_index, compact, cut_points, gear_hashes, payload_of, read_media, settle, store_media, stored_places, wav_header
from millrace.llm.queries_media import op6_chunked_media


def plain(text):
    b = (text or "").encode()
    p = b + bytes(-len(b) % 64)
    p = p or bytes(64)
    return len(b), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:]), 44 + len(p), hashlib.sha256(wav_header(len(p)) + p).hexdigest()


FIELDS = ("n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256")


def test_edges(edge, edge_rows, empty, tmp_path):
    df = edge.withColumn("row", F.lit("clash")).withColumn("data", F.lit(1)).withColumn("id", F.lit(2))
    got = read_media(store_media(df, f"file://{tmp_path}/p"), f"file://{tmp_path}/p").collect()
    assert sorted((repr(r["id"]), *(r[f] for f in FIELDS)) for r in got) == sorted((repr(r[0]), *plain(r[1])) for r in edge_rows)
    assert read_media(store_media(empty, f"file://{tmp_path}/e"), f"file://{tmp_path}/e").count() == 0


def test_gear_hash_equals_the_rolling_definition():
    data = np.random.default_rng(3).integers(0, 256, 500, dtype=np.uint8)
    h, want = 0, []
    for b in data.tolist():
        h = (2 * h + int(media._GEAR[b])) % (1 << 32)
        want.append(h)
    assert gear_hashes(data).tolist() == want


def test_cuts_depend_on_content_alone():
    rnd = random.Random(2)
    shared = bytes(rnd.randrange(256) for _ in range(60_000))
    ends = {}
    for head in (b"", b"x" * 999):
        p = payload_of(head + shared)
        cuts = cut_points(gear_hashes(np.frombuffer(p, np.uint8)))
        sizes = np.diff([0, *cuts])
        assert cuts[-1] == len(p) and sizes.max() <= media.MAX_CHUNK and sizes[:-1].min() >= media.MIN_CHUNK
        ends[head] = {p[a:b] for a, b in zip([0, *cuts], cuts)}
    assert len(ends[b""] & ends[b"x" * 999]) >= 0.8 * len(ends[b""])
    assert cut_points(gear_hashes(np.zeros(64, np.uint8))) == [64]


def test_neighbours_in_a_batch_change_nothing():
    a, b = payload_of(b"left " * 999), payload_of(b"right " * 999)
    both = gear_hashes(np.frombuffer(a + b, np.uint8))
    assert cut_points(both[len(a) :]) == cut_points(gear_hashes(np.frombuffer(b, np.uint8)))


def test_each_digest_is_read_from_one_place(spark, tmp_path, monkeypatch):
    rnd = random.Random(9)
    passage = "".join(rnd.choice("abcdefghij klmnop") for _ in range(30_000))
    df = spark.createDataFrame([(i, f"{i} " * 300 + passage) for i in range(12)], "doc_id long, text string").repartition(4)
    manifests = store_media(df, f"{tmp_path}/p")
    index = chunk_index(manifests)
    refs, places = manifests.select(F.explode("chunks")).count(), index.count()
    assert places < refs / 4 and index.select("digest").distinct().count() == places and index.agg(F.sum("uses")).first()[0] == refs
    assert read_media(manifests, f"{tmp_path}/p").count() == 12


def test_worn_packs_are_rewritten(spark, tmp_path):
    rnd = random.Random(4)
    passage = "".join(rnd.choice("abcdefghij klmnop") for _ in range(40_000))
    rows = [(i, passage if i % 3 else f"{passage} and {rnd.getrandbits(64)} " * 2) for i in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    folder = f"{tmp_path}/p"
    manifests = store_media(df, folder)
    index, stored = chunk_index(manifests), stored_places(manifests)
    new = compact(index, stored, folder, 0.1)
    live = {r["pack"] for r in new.select("at.pack").distinct().collect()}
    assert new.count() == index.count() and live != {r["pack"] for r in index.select("at.pack").distinct().collect()}
    for path in (tmp_path / "p").iterdir():
        if path.stem not in live:
            path.unlink()
    want = sorted((repr(i), *plain(t)) for i, t in rows)
    assert sorted((repr(r["id"]), *(r[f] for f in FIELDS)) for r in read_media(manifests, folder, new).collect()) == want
    assert compact(index.limit(0), stored.limit(0), folder).count() == 0


def test_damage_is_noticed(spark, tmp_path):
    manifests = store_media(spark.createDataFrame([(1, "words " * 500)], "doc_id long, text string"), f"{tmp_path}/p")
    broken = manifests.withColumn("sha256", F.lit("0" * 64))
    with pytest.raises(Exception, match="SHA-256"):
        read_media(broken, f"{tmp_path}/p").collect()


def test_the_media_form_is_a_wav_file(tmp_path):
    p = payload_of(b"sound")
    (tmp_path / "x.wav").write_bytes(wav_header(len(p)) + p)
    with wave.open(str(tmp_path / "x.wav")) as w:
        assert (w.getsampwidth(), w.getnchannels(), w.readframes(1 << 20)) == (1, 1, p)


def test_the_store_holds_each_wav_file_once(spark, tmp_path, monkeypatch):
    """Packs read without the library's code: chunks concatenate to the WAV files, and no chunk is stored twice."""
    import struct

    import zstandard

    monkeypatch.setattr(media, "PACK_ROWS", 3)
    rnd = random.Random(6)
    passage = "".join(rnd.choice("abcdefghij klmnop") for _ in range(20_000))
    rows = [(i, f"{i} " * 400 + passage if i % 4 else None) for i in range(16)]
    df, folder = spark.createDataFrame(rows, "doc_id long, text string").repartition(4), tmp_path / "p"
    manifests = store_media(df, str(folder))
    before = sum(p.stat().st_size for p in folder.iterdir())
    index = settle(manifests, str(folder))
    assert sum(p.stat().st_size for p in folder.iterdir()) < before / 2
    packs, stored = {}, 0
    for p in folder.iterdir():
        data = p.read_bytes()
        n = struct.unpack("<Q", data[-8:])[0]
        table = struct.unpack(f"<{2 * n}Q", data[-8 - 16 * n : -8])
        packs[p.stem] = [zstandard.ZstdDecompressor().decompress(data[at : at + size]) for at, size in zip(table[::2], table[1::2])]
        stored += sum(map(len, packs[p.stem]))
    places = {bytes(r["digest"]): r["at"] for r in index.collect()}
    assert stored == index.agg(F.sum("length")).first()[0] and {a["pack"] for a in places.values()} == set(packs)
    for r in manifests.collect():
        wav = b"".join(packs[(a := places[bytes(c["digest"])])["pack"]][a["segment"]][a["offset"] : a["offset"] + c["length"]] for c in r["chunks"])
        assert hashlib.sha256(wav).hexdigest() == r["sha256"] and wav[:4] == b"RIFF"
        (tmp_path / "x.wav").write_bytes(wav)
        with wave.open(str(tmp_path / "x.wav")) as w:
            assert w.readframes(1 << 20) == payload_of((dict(rows)[r["id"]] or "").encode())
    want = sorted((repr(i), *plain(t)) for i, t in rows)
    assert sorted((repr(r["id"]), *(r[f] for f in FIELDS)) for r in read_media(manifests, str(folder), index).collect()) == want
    none = store_media(df.limit(0), f"{tmp_path}/e")
    assert settle(none, f"{tmp_path}/e").count() == 0


def test_query(spark, edge, edge_rows, tmp_path):
    edge.write.parquet(str(tmp_path / "documents.parquet"))
    rows = op6_chunked_media(spark, str(tmp_path)).collect()
    assert len(rows) == len(edge_rows)
    by_text = {}
    for r in rows:
        by_text.setdefault(r["payload_sha256"], set()).add((r["media_sha256"], r["feature"]))
    assert all(len(x) == 1 for x in by_text.values())
