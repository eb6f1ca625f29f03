"""Token ids in files: fixed-size blocks transposed into byte or bit planes, each plane compressed.

A file is ``MAGIC``, the blocks, a compressed table of documents, a JSON footer, the footer's length
(8 bytes, little-endian) and ``MAGIC``. The footer has the ids' width, the block size, the plane kind and
the chunk index: each block's place and its planes' lengths, so any range of ids is read from its own
blocks alone.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .bpe import encoder
from .histogram import KEYS, LOW, Splitters, find_splitters, keyed, place
from .shared import filesystem, stage

MAGIC = b"MRPLANE1"
BLOCK = 1 << 16
#: Bytes of text that one file takes at least, but for the last; more, up to the second figure, where there would be over MANY_FILES.
FILE_BYTES, LARGE_FILE, MANY_FILES = 56 << 20, 2 << 30, 4096


def to_planes(ids: np.ndarray, kind: str) -> list[bytes]:
    """Ids (unsigned little-endian) as byte planes, or as bit planes of eight ids a byte."""
    width = ids.dtype.itemsize
    rows = ids.view(np.uint8).reshape(-1, width)
    if kind == "bit":
        rows = np.unpackbits(rows, axis=1, bitorder="little")
        return [np.packbits(p, bitorder="little").tobytes() for p in np.ascontiguousarray(rows.T)]
    return [p.tobytes() for p in np.ascontiguousarray(rows.T)]


def from_planes(planes: list[bytes], n: int, width: int, kind: str) -> np.ndarray:
    rows = [np.frombuffer(p, np.uint8) for p in planes]
    if kind == "bit":
        bits = np.stack([np.unpackbits(r, count=n, bitorder="little") for r in rows], axis=1)
        return np.packbits(bits, axis=1, bitorder="little").reshape(-1).view(f"<u{width}")
    return np.ascontiguousarray(np.stack(rows, axis=1)).reshape(-1).view(f"<u{width}")


class PlaneWriter:
    """Writes one file; nothing is at its place before ``close``, so a retried task may write it again."""

    def __init__(self, uri: str, width: int = 2, block: int = BLOCK, kind: str = "byte") -> None:
        self.fs, self.path = filesystem(uri)
        self.fs.create_dir(self.path.rpartition("/")[0], recursive=True)
        self.temporary = f"{self.path}.{uuid.uuid4().hex}.tmp"
        self.out = self.fs.open_output_stream(self.temporary)
        self.out.write(MAGIC)
        self.at, self.width, self.block, self.kind = len(MAGIC), width, block, kind
        self.zstd = zstandard.ZstdCompressor(level=3)
        self.held: list[bytes] = []
        self.n_held = self.n = 0
        self.index: list[list] = []
        self.doc_ids: list[int | None] = []
        self.doc_tokens: list[int] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        n = len(ids) // self.width
        self.doc_ids.append(doc_id)
        self.doc_tokens.append(n)
        self.held.append(ids)
        self.n_held += n
        self.n += n
        if self.n_held >= self.block:
            data = b"".join(self.held)
            size = self.block * self.width
            whole = len(data) // size * size
            for k in range(0, whole, size):
                self._block(data[k : k + size])
            self.held, self.n_held = [data[whole:]], (len(data) - whole) // self.width

    def _block(self, data: bytes) -> None:
        planes = [self.zstd.compress(p) for p in to_planes(np.frombuffer(data, f"<u{self.width}"), self.kind)]
        self.index.append([self.at, len(data) // self.width, [len(p) for p in planes]])
        for p in planes:
            self.out.write(p)
            self.at += len(p)

    def close(self) -> None:
        if self.n_held:
            self._block(b"".join(self.held))
        known = np.array([d is not None for d in self.doc_ids], np.uint8)
        docs = np.array([d or 0 for d in self.doc_ids], "<i8").tobytes() + np.array(self.doc_tokens, "<i8").tobytes() + known.tobytes()
        docs = self.zstd.compress(docs)
        self.out.write(docs)
        footer = json.dumps({
            "width": self.width, "block": self.block, "kind": self.kind, "ids": self.n,
            "docs": [self.at, len(docs), len(self.doc_ids)], "index": self.index,
        }).encode()
        self.out.write(footer + len(footer).to_bytes(8, "little") + MAGIC)
        self.out.close()
        self.fs.move(self.temporary, self.path)


class PlaneReader:
    def __init__(self, uri: str) -> None:
        fs, path = filesystem(uri)
        self.file = fs.open_input_file(path)
        end = self.file.size()
        tail = self.file.read_at(16, end - 16)
        if tail[8:] != MAGIC or self.file.read_at(8, 0) != MAGIC:
            raise ValueError(f"not a token file: {uri}")
        n = int.from_bytes(tail[:8], "little")
        self.footer = json.loads(self.file.read_at(n, end - 16 - n))
        self.zstd = zstandard.ZstdDecompressor()
        self.dtype = f"<u{self.footer['width']}"

    def block(self, k: int) -> np.ndarray:
        at, n, lengths = self.footer["index"][k]
        data, planes = self.file.read_at(sum(lengths), at), []
        for length in lengths:
            planes.append(self.zstd.decompress(data[:length]))
            data = data[length:]
        return from_planes(planes, n, self.footer["width"], self.footer["kind"])

    def read(self, start: int, n: int) -> np.ndarray:
        """``n`` ids from place ``start`` of the file."""
        size = self.footer["block"]
        parts = [self.block(k) for k in range(start // size, -(-(start + n) // size))] if n else []
        return np.concatenate(parts)[start % size : start % size + n] if parts else np.empty(0, self.dtype)

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """Every document in order: id, place of its first id in the file, ids."""
        at, size, count = self.footer["docs"]
        data = self.zstd.decompress(self.file.read_at(size, at))
        ids, tokens = np.frombuffer(data, "<i8", count), np.frombuffer(data, "<i8", count, 8 * count)
        known = np.frombuffer(data, np.uint8, count, 16 * count)
        start, k, held, held_at = 0, 0, np.empty(0, self.dtype), 0
        for doc_id, n, has in zip(ids.tolist(), tokens.tolist(), known.tolist()):
            if start + n > held_at + len(held):
                parts = [held[start - held_at :]]
                have = len(parts[0])
                while have < n:
                    parts.append(self.block(k))
                    have, k = have + len(parts[-1]), k + 1
                held, held_at = np.concatenate(parts), start
            yield (doc_id if has else None), start, held[start - held_at : start - held_at + n]
            start += n


def squeeze(ids: bytes, width: int) -> bytes:
    """A document's ids for the way to its file: byte planes, compressed fast."""
    return zstandard.ZstdCompressor(level=1).compress(b"".join(to_planes(np.frombuffer(ids, f"<u{width}"), "byte")))


def unsqueeze(data: bytes, width: int) -> bytes:
    rows = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(width, -1)
    return np.ascontiguousarray(rows.T).tobytes()


def token_column(text: Column, vocab_path: str, end_id: int | None, cuts: Splitters) -> Column:
    """Struct (part, n, ids) of a row with KEYS: its part, and count and squeezed ids of its text (null: empty) and ``end_id``.

    One UDF for both, for each UDF of a stage has Python workers of its own, and every worker that
    encodes keeps a memo.
    """
    keys = cuts.keys

    def run(texts: pa.Array, a: pa.Array, b: pa.Array, c: pa.Array) -> pa.Array:
        enc = encoder(vocab_path)
        end = b"" if end_id is None else enc.pack([end_id])
        parts = place(keys, *[x.to_numpy(zero_copy_only=False) for x in (a, b, c)])
        lengths, out = [], []
        for k in range(0, len(texts), 256):
            ids = [x + end for x in enc.encode([t or "" for t in texts.slice(k, 256).to_pylist()])]
            lengths += [len(x) // enc.width for x in ids]
            out += [squeeze(x, enc.width) for x in ids]
        return pa.StructArray.from_arrays([pa.array(parts, pa.int32()), pa.array(lengths, pa.int64()), pa.array(out, pa.binary())], names=["part", "n", "ids"])

    run.__annotations__ = dict.fromkeys(("texts", "a", "b", "c", "return"), pa.Array)
    return F.arrow_udf(run, "part int, n long, ids binary").asNondeterministic()(text, *KEYS)


def write_tokens(
    df: DataFrame, directory: str, vocab_path: str, end_id: int | None, id_col: str = "doc_id", text_col: str = "text",
    file_bytes: int = FILE_BYTES, block: int = BLOCK, kind: str = "byte",
) -> DataFrame:
    """Encode every text and write the ids to files in ascending id order; returns one row a file.

    Exact counts of text bytes, on a narrow staged table, cut the order of (id, content, arrival) into
    files of near ``file_bytes`` of text (more for a table that would have over MANY_FILES), whatever the ids' skew. Texts are then encoded where they are
    read, and one exchange moves the compact ids to their files. Ids are null-first; repeated rows
    follow each other, and where a boundary falls among wholly equal rows it matters not which go where;
    a null text is empty; an empty table gives no file. Rows: file (from 0), path, n_docs, n_tokens,
    start (ids of all files before it).
    """
    width = encoder(vocab_path).width
    own_id, text = F.col(id_col), F.col(text_col)
    keys = keyed(df.select(own_id.alias("id"), (F.octet_length(F.coalesce(text, F.lit(""))) + 1).alias("w"), F.xxhash64(text).alias("tie")), "id", F.col("w"), F.col("tie"))
    total = keys.agg(F.coalesce(F.sum("w"), F.lit(0))).first()[0]
    parts = max(1, -(-total // max(file_bytes, min(LARGE_FILE, total // MANY_FILES))))
    cuts = find_splitters(keys, parts, 0.05)
    rows = df.select(
        own_id.alias("id"), text.alias("text"), F.coalesce(own_id.cast("long"), F.lit(LOW)).alias(KEYS[0]), F.xxhash64(text).alias(KEYS[1]), F.monotonically_increasing_id().alias(KEYS[2]),
    )
    rows = rows.select("id", *KEYS, token_column(F.col("text"), vocab_path, end_id, cuts).alias("t")).select("id", *KEYS, "t.part", "t.n", "t.ids")

    def write(batches):
        writer, number = None, None
        for batch in batches:
            for part, doc_id, n, ids in zip(*[batch.column(c).to_pylist() for c in ("part", "id", "n", "ids")]):
                if part != number:
                    if writer:
                        yield finish(writer, number)
                    number = part
                    writer = PlaneWriter(f"{directory}/part-{part:06d}.planes", width, block, kind)
                writer.add(doc_id, unsqueeze(ids, width) if n else b"")
        if writer:
            yield finish(writer, number)

    def finish(writer, number):
        writer.close()
        row = [[number], [f"{directory}/part-{number:06d}.planes"], [len(writer.doc_ids)], [writer.n]]
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, (pa.int32(), pa.string(), pa.int64(), pa.int64()))], names=["file", "path", "n_docs", "n_tokens"])

    moved = rows.repartitionById(parts, F.col("part")).sortWithinPartitions("part", *KEYS)
    files = stage(moved.select("part", "id", "n", "ids").mapInArrow(write, "file int, path string, n_docs long, n_tokens long"), "files")
    # a row a file: few enough for one task
    before = F.sum("n_tokens").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1))
    return files.withColumn("start", F.coalesce(before, F.lit(0)))


def read_tokens(files: DataFrame) -> DataFrame:
    """The documents of ``write_tokens``' files: id, start (ids of all documents before it), n_tokens, ids_crc32.

    ids_crc32 is of the ids as little-endian unsigned 32-bit integers.
    """

    def read(batches):
        for batch in batches:
            for path, base in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist()):
                rows: list[tuple] = []
                for doc_id, start, ids in PlaneReader(path).documents():
                    rows.append((doc_id, base + start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    if len(rows) == 10_000:
                        yield batch_of(rows)
                        rows = []
                if rows:
                    yield batch_of(rows)

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=["id", "start", "n_tokens", "ids_crc32"])

    last = files.agg(F.coalesce(F.max("file"), F.lit(0))).first()[0]
    return files.select("file", "path", "start").repartitionById(last + 1, F.col("file")).mapInArrow(read, "id long, start long, n_tokens long, ids_crc32 long")
