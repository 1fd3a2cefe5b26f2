"""Token-ID files: independent zstandard frames, a directory of documents and a trailing seek table.

File: zstandard frames of little-endian unsigned 32-bit ids (cut at a document's end after FRAME_IDS
ids, or inside a document of more than MOST_IDS); a skippable frame with the directory (Arrow IPC,
compressed: doc_id, start, n_tokens); a skippable frame with the seek table in the public seekable
layout (per frame compressed size, decompressed size, low 32 bits of the xxh64 of its content; then
the number of frames, a descriptor with the checksum bit, the magic number). Zstandard readers skip
both. A reader gets the tail, then only the frames of the documents asked for.

Documents are in ascending doc_id order across files: each file is one contiguous range of doc_id.
A file is written under a name of its own and renamed, so a repeated task leaves the same file.

Defined cases: null text is empty (its only id is the end id); null doc_ids come first; rows that
repeat a doc_id are ordered by text; an empty table gives no file; extra columns are not read.
"""

from __future__ import annotations

import io
import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrafold.llm.encode import encoder
from terrafold.llm.ordering import before, ranges
from terrafold.llm.store import bounded, scratch, written

FRAME_IDS, MOST_IDS = 1 << 16, 1 << 20
DIRECTORY_MAGIC, TABLE_MAGIC, SEEKABLE_MAGIC = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
ROWS_PER_FILE = 1000
SUB_BATCH = 256
LEVEL = 3


class Writer:
    """Writes one file to a binary stream; holds one frame and the directory in memory."""

    def __init__(self, out) -> None:
        self.out, self.pending, self.held = out, [], 0
        self.frames: list[tuple[int, int, int]] = []
        self.docs: list[tuple[int | None, int, int]] = []
        self.total = 0
        self.packer = zstandard.ZstdCompressor(level=LEVEL)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append((doc_id, self.total, len(ids)))
        self.total += len(ids)
        while self.held + len(ids) > MOST_IDS:
            room = MOST_IDS - self.held
            self.pending.append(ids[:room])
            self.held, ids = MOST_IDS, ids[room:]
            self._flush()
        self.pending.append(ids)
        self.held += len(ids)
        if self.held >= FRAME_IDS:
            self._flush()

    def _flush(self) -> None:
        if self.held:
            raw = np.concatenate(self.pending).astype("<u4").tobytes()
            packed = self.packer.compress(raw)
            self.out.write(packed)
            self.frames.append((len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
            self.pending, self.held = [], 0

    def close(self) -> None:
        self._flush()
        ids, starts, sizes = zip(*self.docs, strict=True) if self.docs else ((), (), ())
        table = pa.record_batch([pa.array(ids, pa.int64()), pa.array(starts, pa.int64()), pa.array(sizes, pa.int64())], ["doc_id", "start", "n_tokens"])
        sink = io.BytesIO()
        with pa.ipc.new_stream(sink, table.schema) as s:
            s.write_batch(table)
        directory = self.packer.compress(sink.getvalue())
        self.out.write(struct.pack("<II", DIRECTORY_MAGIC, len(directory)) + directory)
        body = b"".join(struct.pack("<III", *f) for f in self.frames) + struct.pack("<IBI", len(self.frames), 0x80, SEEKABLE_MAGIC)
        self.out.write(struct.pack("<II", TABLE_MAGIC, len(body)) + body)


class Reader:
    """Opens a file by its tail; decompresses only the frames that are asked for."""

    def __init__(self, source, size: int) -> None:
        self.source = source
        n, flags, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEKABLE_MAGIC or not flags & 0x80:
            raise ValueError("no seek table with checksums")
        table = size - 9 - 12 * n
        entries = np.frombuffer(self._at(table, 12 * n), "<u4").reshape(n, 3).astype(np.int64)
        self.packed = np.concatenate([[0], np.cumsum(entries[:, 0])])
        self.plain = np.concatenate([[0], np.cumsum(entries[:, 1])]) // 4
        self.sums = entries[:, 2]
        raw = self._at(int(self.packed[-1]), table - 8 - int(self.packed[-1]))
        if struct.unpack("<I", raw[:4])[0] != DIRECTORY_MAGIC:
            raise ValueError("no directory")
        self.directory = pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(raw[8:])).read_all()
        self.opened = 0

    def _at(self, offset: int, n: int) -> bytes:
        self.source.seek(offset)
        return self.source.read(n)

    def frame(self, k: int) -> np.ndarray:
        raw = zstandard.ZstdDecompressor().decompress(self._at(int(self.packed[k]), int(self.packed[k + 1] - self.packed[k])))
        if xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.sums[k]:
            raise ValueError(f"frame {k}: wrong checksum")
        self.opened += 1
        return np.frombuffer(raw, "<u4")

    def pieces(self, start: int, n: int, cache: dict):
        """The ids [start, start + n) in pieces of one frame each; cache holds the last frame."""
        end = start + n
        k = int(np.searchsorted(self.plain, start, "right")) - 1
        while start < end:
            if k not in cache:
                cache.clear()
                cache[k] = self.frame(k)
            low, high = int(self.plain[k]), int(self.plain[k + 1])
            yield cache[k][start - low : min(end, high) - low]
            start, k = min(end, high), k + 1

    def read(self, doc_ids) -> dict[int, np.ndarray]:
        """The ids of the documents asked for, in the directory's order; others are not decompressed."""
        wanted, cache, out = set(doc_ids), {}, {}
        for d in self.directory.to_pylist():
            if d["doc_id"] in wanted:
                out[d["doc_id"]] = np.concatenate([*self.pieces(d["start"], d["n_tokens"], cache), np.zeros(0, "<u4")]).astype("<u4")
        return out


_MANIFEST = "part long, path string, n_ids long, n_docs long"


def write(docs: DataFrame, root: str, path: str, end_id: int) -> DataFrame:
    """Write the files under root; one row per file: part, path, n_ids, n_docs (itself written)."""
    slim = bounded(docs).select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    slim = ranges(slim, "doc_id", ROWS_PER_FILE).place(slim, "doc_id").repartition("part").sortWithinPartitions("part", "doc_id", "text")

    def files(batches):
        where, at = fs.FileSystem.from_uri(root)
        where.create_dir(at, recursive=True)
        enc, part, out, w, name, made = encoder(path), None, None, None, "", []
        end = np.array([end_id], "<u4")

        def finish():
            w.close()
            out.close()
            made.append({"part": part, "path": f"{root}/{name}", "n_ids": w.total, "n_docs": len(w.docs)})

        for b in batches:
            for k in range(0, b.num_rows, SUB_BATCH):
                sub = b.slice(k, SUB_BATCH)
                coded = enc.encode(sub.column("text").to_pylist())
                for p, doc, ids in zip(sub.column("part").to_pylist(), sub.column("doc_id").to_pylist(), coded, strict=True):
                    if p != part:
                        if w is not None:
                            finish()
                        # Each attempt writes a file of its own; the committed manifest names the one that counts.
                        part, name = p, f"part-{p:010d}-{uuid.uuid4().hex}.zst"
                        out = where.open_output_stream(f"{at}/{name}", compression=None)
                        w = Writer(out)
                    w.add(doc, np.concatenate([ids, end]))
        if w is not None:
            finish()
        yield pa.RecordBatch.from_pylist(made, schema=pa.schema([("part", pa.int64()), ("path", pa.string()), ("n_ids", pa.int64()), ("n_docs", pa.int64())]))

    return written(slim.mapInArrow(files, _MANIFEST), "manifest")


_OUT = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def read_back(manifest: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32 of every document, from the files.

    The running sum is over files, block by block. Each file is dealt to one of as many partitions by
    number, which adaptive execution leaves alone however short the manifest is.
    """
    placed = before(manifest, "n_ids", "base")

    def rows(batches):
        for b in batches:
            for f in b.to_pylist():
                where, at = fs.FileSystem.from_uri(f["path"])
                with where.open_input_file(at) as source:
                    r, cache, out = Reader(source, source.size()), {}, []
                    for d in r.directory.to_pylist():
                        crc = 0
                        for piece in r.pieces(d["start"], d["n_tokens"], cache):
                            crc = zlib.crc32(np.ascontiguousarray(piece), crc)
                        out.append({"doc_id": d["doc_id"], "start": f["base"] + d["start"], "n_tokens": d["n_tokens"], "ids_crc32": crc})
                yield pa.RecordBatch.from_pylist(out, schema=_OUT)

    return placed.repartition(max(1, manifest.count()), "part").mapInArrow(rows, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    return read_back(write(docs, scratch(docs.sparkSession, "tokens"), path, end_id))
