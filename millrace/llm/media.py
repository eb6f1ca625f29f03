"""Media columns by content-defined chunking: gear-hash cuts, a chunk store without repeats, verified reads.

A payload's media form is a WAV file. Its header is a chunk; its samples are cut where a rolling hash of
the last 32 bytes says so, so equal passages give equal chunks wherever they stand. Chunks go to pack files
in compressed segments; each payload is a manifest, the ordered list of its chunks' digests, which
concatenate to the WAV file; an index gives each digest the one place it is stored at.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
import zlib
from bisect import bisect_left
from collections import OrderedDict

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import ascii_bytes, filesystem, stage

MIN_CHUNK, MEAN_BITS, MAX_CHUNK = 512, 11, 8192
SEGMENT, PACK = 64 << 10, 64 << 20
#: Payloads that start in one pack at most: copies add none of its bytes.
PACK_ROWS = 1 << 16
HEADER = 44
_GEAR = np.frombuffer(b"".join(hashlib.sha256(b"gear%d" % i).digest()[:4] for i in range(256)), "<u4")


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """The gear hash after each byte: sum of 32 bytes' table values, each shifted by its age."""
    h = _GEAR[data]
    for k in (1, 2, 4, 8, 16):
        h[k:] = h[k:] + (h[:-k] << np.uint32(k))
    return h


def cut_points(hashes: np.ndarray) -> list[int]:
    """Chunk ends of one payload by its bytes' hashes; each chunk has MIN_CHUNK to MAX_CHUNK bytes but the last."""
    n = len(hashes)
    marks = (np.flatnonzero(hashes >> np.uint32(32 - MEAN_BITS) == 0) + 1).tolist()
    ends, start = [], 0
    while n - start > MIN_CHUNK:
        k = bisect_left(marks, start + MIN_CHUNK)
        end = min(marks[k] if k < len(marks) else n, start + MAX_CHUNK, n)
        ends.append(end)
        start = end
    if start < n or not ends:
        ends.append(n)
    return ends


def payload_of(text: bytes) -> bytes:
    """A text's bytes, then zeros up to a positive multiple of 64."""
    return text + bytes(-len(text) % 64 or (0 if text else 64))


def wav_header(n: int) -> bytes:
    """The 44 bytes before ``n`` unsigned 8-bit samples, one channel, 8 kHz."""
    return struct.pack("<4sI4s4sIHHIIHH4sI", b"RIFF", 36 + n & 0xFFFFFFFF, b"WAVE", b"fmt ", 16, 1, 1, 8000, 8000, 1, 8, b"data", n & 0xFFFFFFFF)


class PackWriter:
    """Appends chunks to pack files. Each attempt's packs have names of their own, and only a finished
    task's manifests name them, so a retry can't mix with what a lost task left."""

    def __init__(self, directory: str) -> None:
        self.fs, self.root = filesystem(directory)
        self.fs.create_dir(self.root, recursive=True)
        self.zstd = zstandard.ZstdCompressor(level=3)
        self.out = None

    def _open(self) -> None:
        self.name = uuid.uuid4().hex
        self.out = self.fs.open_output_stream(f"{self.root}/{self.name}.pack")
        self.at, self.raw, self.segment, self.fill, self.pending, self.rows = 0, 0, [], 0, [], 0
        self.here: dict[bytes, tuple[str, int, int]] = {}

    def add(self, digest: bytes, chunk: bytes) -> tuple[str, int, int, bool]:
        """The pack, segment number and offset in it of a chunk, stored once a pack, and whether it is new there."""
        if self.out is None:
            self._open()
        new = digest not in self.here
        if new:
            if self.fill + len(chunk) > SEGMENT:
                self._flush()
            self.here[digest] = (self.name, len(self.pending), self.fill)
            self.segment.append(chunk)
            self.fill += len(chunk)
        return *self.here[digest], new

    def _flush(self) -> None:
        if self.segment:
            data = self.zstd.compress(b"".join(self.segment))
            self.out.write(data)
            self.pending.append((self.at, len(data)))
            self.at, self.raw, self.segment, self.fill = self.at + len(data), self.raw + self.fill, [], 0

    def roll(self, rows: int = 0) -> None:
        """Between payloads, of which ``rows`` were added since: end a full pack."""
        if self.out is not None:
            self.rows += rows
            if self.raw >= PACK or self.rows >= PACK_ROWS:
                self.close()

    def close(self) -> None:
        if self.out is not None:
            self._flush()
            table = np.array(self.pending, "<u8").tobytes()
            self.out.write(table + struct.pack("<Q", len(self.pending)))
            self.out.close()
            self.out = None


class PackReader:
    """Chunks of packs, with the last segments read kept."""

    def __init__(self, directory: str, keep: int = 256) -> None:
        self.fs, self.root = filesystem(directory)
        self.files: OrderedDict = OrderedDict()
        self.segments: OrderedDict[tuple[str, int], bytes] = OrderedDict()
        self.keep, self.zstd = keep, zstandard.ZstdDecompressor()

    def _file(self, pack: str):
        if pack not in self.files:
            f = self.fs.open_input_file(f"{self.root}/{pack}.pack")
            size = f.size()
            n = struct.unpack("<Q", f.read_at(8, size - 8))[0]
            self.files[pack] = f, np.frombuffer(f.read_at(16 * n, size - 8 - 16 * n), "<u8").reshape(-1, 2)
            if len(self.files) > 64:
                self.files.popitem(last=False)[1][0].close()
        self.files.move_to_end(pack)
        return self.files[pack]

    def chunk(self, pack: str, segment: int, offset: int, length: int) -> bytes:
        key = (pack, segment)
        if key not in self.segments:
            f, table = self._file(pack)
            at, size = map(int, table[segment])
            self.segments[key] = self.zstd.decompress(f.read_at(size, at))
            if len(self.segments) > self.keep:
                self.segments.popitem(last=False)
        self.segments.move_to_end(key)
        return self.segments[key][offset : offset + length]


PLACE = "pack:string,segment:int,offset:int"
MANIFEST = f"row long, id {{id}}, n_bytes long, sha256 string, home string, chunks array<struct<digest:binary,length:int,{PLACE},new:boolean>>"
_ITEM = pa.struct([("digest", pa.binary()), ("length", pa.int32()), ("pack", pa.string()), ("segment", pa.int32()), ("offset", pa.int32()), ("new", pa.bool_())])


def store_media(df: DataFrame, directory: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Cut every payload's WAV form and write its chunks to packs; returns the staged manifests.

    Each task writes a chunk once a pack. One manifest a row: its number, id, unpadded bytes, the WAV
    file's SHA-256, the pack of its first chunk, and its chunks in order. Null and empty texts
    are 64 zeros; repeated rows, equal and null ids have a manifest each; an empty table gives none. Payloads don't travel: cutting, hashing and packing happen where a text is read.
    """
    kind = df.schema[id_col].dataType

    def write(batches):
        packs = PackWriter(directory)
        try:
            for batch in batches:
                for k in range(0, batch.num_rows, 512):
                    group = batch.slice(k, min(512, batch.num_rows - k))
                    yield part(group, packs)
                    packs.roll(group.num_rows)
        finally:
            packs.close()

    def part(batch, packs):
        payloads = [payload_of(t) for t in batch.column("data").to_pylist()]
        shas, homes, chunks = [], [], []
        hashes, at = gear_hashes(np.frombuffer(b"".join(payloads), np.uint8)), 0
        for p in payloads:
            header = wav_header(len(p))
            ends = cut_points(hashes[at : at + len(p)])
            own = []
            for piece in (header, *(p[i:j] for i, j in zip([0, *ends], ends))):
                digest = hashlib.sha256(piece).digest()[:20]
                own.append((digest, len(piece), *packs.add(digest, piece)))
            at += len(p)
            shas.append(hashlib.sha256(header + p).hexdigest())
            homes.append(own[0][2])
            chunks.append([dict(zip(_ITEM.names, c)) for c in own])
        columns = [batch.column("row"), batch.column("id"), batch.column("n_bytes"), pa.array(shas), pa.array(homes), pa.array(chunks, pa.list_(_ITEM))]
        return pa.RecordBatch.from_arrays(columns, names=["row", "id", "n_bytes", "sha256", "home", "chunks"])

    data = ascii_bytes(F.col(text_col))
    rows = df.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.octet_length(data).cast("long").alias("n_bytes"), data.alias("data"))
    return stage(rows.mapInArrow(write, MANIFEST.format(id=kind.simpleString())), "manifests")


def chunk_index(manifests: DataFrame) -> DataFrame:
    """The one place of each digest over all packs (the least), and how many manifests' chunks it serves.

    Minima are taken map-side, so a chunk that most payloads share is one row a task.
    """
    refs = manifests.select(F.explode("chunks").alias("c"))
    place = F.min(F.struct("c.pack", "c.segment", "c.offset")).alias("at")
    return refs.groupBy("c.digest").agg(place, F.count(F.lit(1)).alias("uses"), F.first("c.length").alias("length"))


def settle(manifests: DataFrame, directory: str) -> DataFrame:
    """Make the store hold each digest once: packs with a chunk that the index reads elsewhere are rewritten
    without it, and the old ones deleted once the new index is staged. Returns the index."""
    index, worn = _compacted(chunk_index(manifests), stored_places(manifests), directory, 0.0)

    def delete(batches):
        fs, root = filesystem(directory)
        for batch in batches:
            for name in batch.column("pack").to_pylist():
                path = f"{root}/{name}.pack"
                if fs.get_file_info(path).is_file:  # a retried task finds some gone
                    fs.delete_file(path)
            yield batch

    worn.mapInArrow(delete, "pack string").count()
    return index


def compact(index: DataFrame, stored: DataFrame, directory: str, most_dead: float = 0.25) -> DataFrame:
    """Rewrite packs of whose bytes more than ``most_dead`` are chunks that the index reads elsewhere.

    ``stored``: the places that packs hold (``stored_places``). Returns the index with the new places,
    staged; the old packs can be deleted once nothing reads them. A task rewrites a pack, whose size is
    bounded; new packs have names of their own, so a retry is harmless.
    """
    return _compacted(index, stored, directory, most_dead)[0]


def _compacted(index: DataFrame, stored: DataFrame, directory: str, most_dead: float) -> tuple[DataFrame, DataFrame]:
    """``compact``'s index, and the names of the packs that it no longer reads."""
    index = stage(index, "index")
    pack = F.col("at.pack").alias("pack")
    live = index.groupBy(pack).agg(F.sum("length").alias("live"))
    held = stored.groupBy("pack").agg(F.sum("length").alias("held"))
    worn = stage(held.join(live, "pack", "left").where(F.coalesce("live", F.lit(0)) < F.col("held") * (1 - most_dead)).select("pack"), "worn")
    flagged = index.select("*", pack).join(worn.withColumn("worn", F.lit(True)), "pack", "left")
    moving = flagged.where("worn").select("pack", "digest", "uses", "length", F.col("at.segment").alias("segment"), F.col("at.offset").alias("offset"))

    def rewrite(batches):
        reader, writer = PackReader(directory), PackWriter(directory)
        try:
            for batch in batches:
                places = []
                for name, digest, length, segment, offset in zip(*[batch.column(c).to_pylist() for c in ("pack", "digest", "length", "segment", "offset")]):
                    new = writer.add(digest, reader.chunk(name, segment, offset, length))
                    places.append(dict(zip(("pack", "segment", "offset"), new)))
                    writer.roll(1)
                at = pa.array(places, pa.struct([("pack", pa.string()), ("segment", pa.int32()), ("offset", pa.int32())]))
                yield pa.RecordBatch.from_arrays([batch.column("digest"), at, batch.column("uses"), batch.column("length")], names=["digest", "at", "uses", "length"])
        finally:
            writer.close()

    schema = "digest binary, at struct<pack:string,segment:int,offset:int>, uses long, length int"
    moved = moving.repartition("pack").sortWithinPartitions("pack", "segment", "offset").mapInArrow(rewrite, schema)
    return stage(flagged.where("worn IS NULL").select("digest", "at", "uses", "length").unionByName(moved), "index"), worn


def stored_places(manifests: DataFrame) -> DataFrame:
    """(pack, segment, offset, length) of every chunk that the packs hold."""
    return manifests.select(F.explode("chunks").alias("c")).where("c.new").select("c.pack", "c.segment", "c.offset", "c.length")


def read_media(manifests: DataFrame, directory: str, index: DataFrame | None = None) -> DataFrame:
    """Rebuild every WAV file from its chunk list and the index, verify it, and return what it holds.

    Rows: id, n_bytes, payload_bytes, payload_sha256, tail_crc32 (of the last 64 bytes), media_bytes and
    media_sha256 (of the stored WAV file), feature (of its samples). A home pack's payloads need each
    digest once: those small rows, distinct map-side, meet the index in a join, so a chunk that most
    payloads share costs a row a pack. Payloads are then read by home pack, which bounds a group
    (PACK bytes, PACK_ROWS payloads). ``index`` is the manifests' own if not given.
    """
    index = (chunk_index(manifests) if index is None else index).select("digest", "at")
    needed = manifests.select(F.col("home").alias("of"), F.explode("chunks.digest").alias("digest")).distinct()
    places = needed.join(index, "digest").select("of", "digest", "at.pack", "at.segment", "at.offset")
    kind = manifests.schema["id"].dataType.simpleString()
    rows = manifests.select("home", "id", "n_bytes", "sha256", F.transform("chunks", lambda c: F.struct(c["digest"].alias("digest"), c["length"].alias("length"))).alias("chunks"))
    schema = f"id {kind}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"

    def read(rows: pa.Table, places: pa.Table) -> pa.Table:
        reader = PackReader(directory)
        at = dict(zip(places["digest"].to_pylist(), zip(*[places[c].to_pylist() for c in ("pack", "segment", "offset")])))
        out = []
        for batch in rows.to_batches(1024):
            for want, chunks in zip(batch.column("sha256").to_pylist(), batch.column("chunks").to_pylist()):
                media = b"".join([reader.chunk(*at[c["digest"]], c["length"]) for c in chunks])
                sha = hashlib.sha256(media).hexdigest()
                if sha != want:
                    raise ValueError(f"a WAV file read back has SHA-256 {sha}, not {want}")
                payload = media[HEADER:]
                samples = np.frombuffer(payload, np.uint8)
                steps = np.count_nonzero(np.diff(samples >> 7))
                feature = f"chunks={len(chunks)};mean={int(samples.sum(dtype=np.int64)) / len(samples):.3f};max={int(samples.max())};crossings={steps}"
                out.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(media), sha, feature))
        a, b, c, d, e, f = zip(*out) if out else [()] * 6
        columns = [rows["id"], rows["n_bytes"], *[pa.array(x, t) for x, t in ((a, pa.int64()), (b, pa.string()), (c, pa.int64()), (d, pa.int64()), (e, pa.string()), (f, pa.string()))]]
        return pa.Table.from_arrays(columns, names=[x.split()[0] for x in schema.split(", ")])

    return rows.groupBy("home").cogroup(places.groupBy("of")).applyInArrow(read, schema)
