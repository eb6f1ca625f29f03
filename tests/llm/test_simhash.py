import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from millrace.llm import simhash
from millrace.llm.components import connected_components
from millrace.llm.queries_simhash import op10_simhash_bktree
from millrace.llm.simhash import BKTree, fingerprint, fingerprint_hex, keep_one, link_fingerprints, near_duplicates, word_fingerprints


def brute_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode()
    words = [w for w in words.translate(bytes.maketrans(b"\t\n\x0b\x0c\r", b"     ")).split(b" ") if w]
    grams = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def brute(rows):
    """(fingerprint, n_near, component) of each (id, text)."""
    fps = np.array([brute_fingerprint(t) for _, t in rows], np.uint64)
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 2
    out, seen = [], {}
    for i in range(len(rows)):
        if i not in seen:
            group, todo = {i}, [i]
            while todo:
                for j in np.flatnonzero(near[todo.pop()]).tolist():
                    if j not in group:
                        group.add(j)
                        todo.append(j)
            known = [rows[j][0] for j in group if rows[j][0] is not None]
            seen |= dict.fromkeys(group, min(known, default=None))
        out.append((format(int(fps[i]), "016x"), int(near[i].sum()) - 1, seen[i]))
    return out


def ask(df):
    rows = near_duplicates(df).select("doc_id", fingerprint_hex(F.col("fp")), "n_near", "component_id").collect()
    return Counter(map(tuple, rows))


def test_edges(edge, edge_rows, empty):
    rows = [(r[0], r[1]) for r in edge_rows]
    assert ask(edge) == Counter((i, *x) for (i, _), x in zip(rows, brute(rows)))
    assert near_duplicates(empty).count() == 0 and keep_one(empty).count() == 0


def test_near_copies_and_chains(spark):
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    base = [rnd.choice(words) for _ in range(400)]
    rows = []
    for i in range(60):
        text = list(base)
        for _ in range(i % 6):
            text[rnd.randrange(len(text))] = rnd.choice(words)
        rows.append((1000 - i, " ".join(text)))
    rows += [(i, " ".join(rnd.choice(words) for _ in range(50))) for i in range(40)] + [(2000, rows[0][1])] * 5
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert ask(df) == Counter((i, *x) for (i, _), x in zip(rows, brute(rows)))


def plain_links(n, radius):
    return {f: s for f in n if (s := sum(n[g] for g in n if g != f and ((f ^ g) & (1 << 64) - 1).bit_count() <= radius))}


@pytest.mark.parametrize(("most", "radius"), [(2048, 2), (3, 2), (2048, 3), (12, 3)])
def test_links_equal_brute_force_with_whole_and_divided_shards(spark, monkeypatch, most, radius):
    monkeypatch.setattr(simhash, "MAX_TREE", most)
    rnd = random.Random(2)
    fps = set()
    for _ in range(12):
        seed = rnd.getrandbits(64)
        for _ in range(25):
            fps.add(seed ^ sum(1 << b for b in rnd.sample(range(64), rnd.randrange(6))))
    fps = sorted(f - (1 << 64) if f >> 63 else f for f in fps | {0, 1, (1 << 64) - 1})
    n = {f: k % 4 + 1 for k, f in enumerate(fps)}
    got = link_fingerprints(spark.createDataFrame(list(n.items()), "fp long, n long"), radius).groupBy("fp").agg(F.sum("near").alias("s")).collect()
    assert {r["fp"]: r["s"] for r in got if r["s"]} == plain_links(n, radius)


def test_crowded_shards_are_divided_until_they_are_small(spark, monkeypatch):
    monkeypatch.setattr(simhash, "MAX_TREE", 16)
    monkeypatch.setattr(simhash, "FREE_BITS", 4)
    rnd, sizes = random.Random(3), []
    n = {0x1234_5678_0000_0000 | rnd.getrandbits(12): 1 for _ in range(900)}
    for code in range(1, 4):  # paths of each depth fix more bits
        path = (0,) * code
        sizes.append(64 - simhash.shard_of_path(path, 2)[0].bit_count())
    assert sizes == sorted(sizes, reverse=True)
    got = link_fingerprints(spark.createDataFrame(list(n.items()), "fp long, n long")).groupBy("fp").agg(F.sum("near").alias("s")).collect()
    assert {r["fp"]: r["s"] for r in got if r["s"]} == plain_links(n, 2)


def test_paths_have_codes_of_their_own():
    codes = {}
    for c in range(len(simhash.pairs_of_blocks(2))):
        paths = [((c,), c)]
        for _ in range(3):
            paths = [((*p, k), simhash._child(code, k, 2)) for p, code in paths for k in range(3)]
            codes.update({code: p for p, code in paths})
            assert all(simhash._path(code, 2) == p for p, code in paths)
    assert len(codes) == 6 * (3 + 9 + 27)


def brute_groups(texts, views, radius):
    """Component of each text by links in any view."""
    fps = np.array([word_fingerprints((t or "").encode(), views) for t in texts], np.int64).view(np.uint64)
    near = np.bitwise_count(fps[:, None] ^ fps[None]).min(axis=2) <= radius
    group = np.arange(len(texts))
    while True:
        new = np.array([group[row].min() for row in near])
        if (new == group).all():
            return group.tolist()
        group = new


def test_word_fingerprints_by_definition():
    for text in ("a b b c c c c", "One word", "", "same " * 1000 + "other", "x y z " * 7):
        counts = Counter(text.lower().encode().split())
        for k, got in enumerate(word_fingerprints(text.encode(), 3)):
            bits = [0] * 64
            for w, c in counts.items():
                h = (xxh64_intdigest(w, 42) ^ simhash._VIEWS[k]) * 0xFF51AFD7ED558CCD % (1 << 64)
                h = (h ^ h >> 32) * 0xC4CEB9FE1A85EC53 % (1 << 64)
                h ^= h >> 29
                for b in range(64):
                    bits[b] += (h >> b & 1) * c.bit_length()
            total = sum(c.bit_length() for c in counts.values())
            assert got & (1 << 64) - 1 == sum(1 << b for b in range(64) if 2 * bits[b] > total)


def test_views_equal_brute_force_and_find_near_copies(spark):
    rnd = random.Random(8)
    bank = [f"word{i}" for i in range(3000)]
    rows, planted = [], {}
    for i in range(40):
        base = rnd.choices(bank, [1 / (k + 1) for k in range(3000)], k=rnd.randrange(80, 300))
        rows.append((len(rows), " ".join(base)))
        for _ in range(i % 4):
            copy = list(base)
            for at in rnd.sample(range(len(copy)), len(copy) // 25):
                copy[at] = rnd.choice(bank)
            planted[len(rows)] = i
            rows.append((len(rows), " ".join(copy)))
    rows += [(len(rows), None), (len(rows) + 1, ""), (len(rows) + 2, rows[0][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(r["doc_id"] for r in keep_one(df, radius=3, views=8).collect())
    assert got == sorted(set(brute_groups([t for _, t in rows], 8, 3)))
    assert sum(i not in got for i in planted) >= 0.9 * len(planted) and len(got) >= 41
    assert keep_one(df.limit(0), radius=3, views=8).count() == 0
    with pytest.raises(ValueError, match="views"):
        keep_one(df, views=9)


def test_query(spark, edge, edge_rows, tmp_path):
    edge.write.parquet(str(tmp_path / "documents.parquet"))
    got = op10_simhash_bktree(spark, str(tmp_path))
    assert got.columns == ["doc_id", "fingerprint", "n_near", "component_id"]
    rows = [(r[0], r[1]) for r in edge_rows]
    assert Counter(map(tuple, got.collect())) == Counter((i, *x) for (i, _), x in zip(rows, brute(rows)))


def test_bk_tree():
    rnd = random.Random(1)
    values = [rnd.getrandbits(12) for _ in range(300)]
    tree = BKTree(values)
    for v in values[:50]:
        assert sorted(tree.within(v, 2)) == [i for i, x in enumerate(values) if (x ^ v).bit_count() <= 2]
    assert BKTree([]).within(1, 2) == []


def test_long_texts_are_sliced():
    text = " ".join(f"w{i % 97}{i % 13}" for i in range(5000)).encode()
    assert fingerprint(text, slice_rows=7) == fingerprint(text)


def test_keep_one_keeps_columns_and_breaks_ties(spark):
    rows = [(2, "same text here", "x", 1), (2, "same text here", "y", 2), (5, "same text here", "z", 3), (7, "quite another one", None, 4), (None, "same text here", "n", 5), (None, "alone and nameless", "q", 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id string, fp long")
    got = keep_one(df)
    assert got.columns == df.columns
    kept = sorted(map(tuple, got.collect()), key=repr)
    assert len(kept) == 3 and rows[3] in kept and rows[5] in kept and any(r[0] == 2 for r in kept)


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (200, 100)]
    got = connected_components(spark.createDataFrame(edges, "a long, b long"))
    assert {tuple(r) for r in got.collect()} == {(i, 0) for i in range(1, 41)} | {(101, 100), (200, 100)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
