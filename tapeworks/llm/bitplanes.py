"""Token ids in bit-plane files (operator 8).

A file holds a stream of unsigned 32-bit ids. Blocks of a fixed number of ids are transposed into planes
(all first bytes, all second bytes, ...; or all lowest bits, ...), each plane is compressed on its own with
zstandard, and the footer has the chunk index (place, number of ids and plane sizes of each block) and the
documents (id, number of ids). A plane that never changes shrinks to a few bytes, so ids of a vocabulary
under 65 536 cost about two bytes before compression, without a second format for small ids.

    magic | planes of chunk 0 | planes of chunk 1 | ... | footer (zstd) | footer size u64 | magic

Documents are written in ascending id order over all files, null ids first; rows that share an id follow
each other by text. Null and empty texts consist of the end id alone. Other columns are ignored. An empty
table gives no file and an empty result. A file counts only when the manifest names it, so the files of
lost or repeated attempts are never read.
"""

from __future__ import annotations

import json
import os
import struct
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tapeworks.llm.common import keep_between_tasks, map_batches, settle, table, texts
from tapeworks.llm.files import create, new_name, open_file
from tapeworks.llm.pieces import is_latin, pieces
from tapeworks.session import work_folder

VOCABULARY = "byte_bpe_50k.json"
END_ID = 0
MAGIC = b"TWPLANE1"
BLOCK_IDS = 65_536
FILE_IDS = 64 << 20
PIECES_KEPT = 400_000
LATIN_END = 0x250


def split_planes(ids: np.ndarray, kind: str) -> list[bytes]:
    """Byte planes (4) or bit planes (32), lowest first."""
    rows = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if kind == "bit":
        rows = np.unpackbits(rows, axis=1, bitorder="little")
        return [np.packbits(p, bitorder="little").tobytes() for p in rows.T]
    return [p.tobytes() for p in np.ascontiguousarray(rows.T)]


def join_planes(planes: list[bytes], count: int, kind: str) -> np.ndarray:
    if kind == "bit":
        bits = [np.unpackbits(np.frombuffer(p, np.uint8), count=count, bitorder="little") for p in planes]
        rows = np.packbits(np.stack(bits, axis=1), axis=1, bitorder="little")
    else:
        rows = np.stack([np.frombuffer(p, np.uint8) for p in planes], axis=1)
    return np.ascontiguousarray(rows).view("<u4").reshape(-1)


class PlaneWriter:
    """Writes ids as they come; holds one block and the index."""

    def __init__(self, stream, kind: str = "byte", block: int = BLOCK_IDS, level: int = 3):
        self.stream, self.kind, self.block = stream, kind, block
        self.pack = zstandard.ZstdCompressor(level=level)
        self.stream.write(MAGIC)
        self.place, self.waiting, self.held, self.n_ids = len(MAGIC), [], 0, 0
        self.chunks: list[tuple] = []
        self.names: list = []
        self.counts: list[int] = []

    def add(self, name, ids: np.ndarray) -> None:
        self.names.append(name)
        self.counts.append(len(ids))
        self.n_ids += len(ids)
        self.waiting.append(ids)
        self.held += len(ids)
        if self.held >= self.block:
            flat = np.concatenate(self.waiting)
            whole = len(flat) // self.block * self.block
            for at in range(0, whole, self.block):
                self._flush(flat[at:at + self.block])
            self.waiting, self.held = [flat[whole:]], len(flat) - whole

    def _flush(self, ids: np.ndarray) -> None:
        packed = [self.pack.compress(p) for p in split_planes(ids, self.kind)]
        self.chunks.append((self.place, len(ids), *map(len, packed)))
        for p in packed:
            self.stream.write(p)
            self.place += len(p)

    def close(self) -> None:
        if self.held:
            self._flush(np.concatenate(self.waiting))
        head = json.dumps({"kind": self.kind, "names": self.names, "counts": self.counts, "chunks": self.chunks})
        footer = self.pack.compress(head.encode())
        self.stream.write(footer)
        self.stream.write(struct.pack("<Q", len(footer)) + MAGIC)
        self.stream.close()


class PlaneReader:
    """Reads single chunks, single documents, or all of a file in order."""

    def __init__(self, file):
        self.file, self.unpack = file, zstandard.ZstdDecompressor()
        size = file.size()
        tail = file.read_at(16, size - 16)
        if tail[8:] != MAGIC:
            raise ValueError("not a plane file")
        length = struct.unpack("<Q", tail[:8])[0]
        footer = json.loads(self.unpack.decompress(file.read_at(length, size - 16 - length)))
        self.kind, self.names, self.counts, self.chunks = (footer[k] for k in ("kind", "names", "counts", "chunks"))

    def chunk(self, number: int) -> np.ndarray:
        place, count, *sizes = self.chunks[number]
        raw, planes = self.file.read_at(sum(sizes), place), []
        for size in sizes:
            planes.append(self.unpack.decompress(raw[:size]))
            raw = raw[size:]
        return join_planes(planes, count, self.kind)

    def ids(self, start: int, count: int) -> np.ndarray:
        """Ids [start, start + count) of the file, from the chunks that hold them."""
        ends = np.cumsum([c[1] for c in self.chunks])
        first, last = np.searchsorted(ends, [start, start + count - 1], side="right")
        flat = np.concatenate([self.chunk(i) for i in range(first, last + 1)])
        skip = start - (ends[first] - self.chunks[first][1])
        return flat[skip:skip + count]

    def documents(self) -> Iterator[tuple]:
        """(name, start, ids in parts) of each document; holds one chunk."""
        number, rest, start = 0, np.empty(0, "<u4"), 0
        for name, count in zip(self.names, self.counts):
            parts, missing = [], count
            while missing > 0:
                if not len(rest):
                    rest, number = self.chunk(number), number + 1
                parts.append(rest[:missing])
                missing -= len(parts[-1])
                rest = rest[len(parts[-1]):]
            yield name, start, parts
            start += count


class Encoder(dict):
    """Piece -> its ids, packed; by the library's model, and kept, as words return often.

    Texts within the Latin blocks are split here; others, and texts that spell an added token, go through the
    library whole.
    """

    def __init__(self, path: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.added = tuple(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        self.model = self.tokenizer.model
        spell = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.letters = {}  # byte -> the letter that the vocabulary writes it with
        for point in (*range(LATIN_END), *range(0x2010, 0x205F)):
            self.letters.update(zip(chr(point).encode(), spell(chr(point))[0][0]))

    def __missing__(self, piece: str) -> bytes:
        spelt = piece.encode().decode("latin-1").translate(self.letters)
        packed = array("I", [t.id for t in self.model.tokenize(spelt)]).tobytes()
        if len(piece) <= 64:
            if len(self) >= PIECES_KEPT:
                self.clear()
            self[piece] = packed
        return packed

    def encode(self, text: str) -> np.ndarray:
        if is_latin(text) and not any(token in text for token in self.added):
            return np.frombuffer(b"".join(map(self.__getitem__, pieces(text))), "<u4")
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        keep_between_tasks(__name__, _encoders.clear)
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _write(batches: Iterator[dict], path: str, folder: str, end_id: int, kind: str, block: int, most: int) -> Iterator[dict]:
    own, partition, number, writer, uri = encoder(path), TaskContext.get().partitionId(), 0, None, ""

    def done() -> dict:
        writer.close()
        return {
            "file": [uri], "first_id": [writer.names[0]], "partition": [partition], "number": [number],
            "n_docs": [len(writer.names)], "n_ids": [writer.n_ids],
        }

    end = np.array([end_id], "<u4")
    for batch in batches:
        for name, text in zip(batch["_id"].to_pylist(), texts(batch["_text"])):
            if writer is None:
                uri, stream = create(folder, new_name(partition, number, ".planes"))
                writer = PlaneWriter(stream, kind, block)
            writer.add(name, np.concatenate([own.encode(text), end]))
            if writer.n_ids >= most:
                yield done()
                writer, number = None, number + 1
    if writer is not None:
        yield done()


def write_planes(
    docs: DataFrame, folder: str, vocabulary: str, end_id: int = END_ID, kind: str = "byte", block: int = BLOCK_IDS,
    most: int = FILE_IDS,
) -> DataFrame:
    """Encode and write; returns the manifest, one row per file, with the number of ids in all files before.

    One shuffle by ranges of ids. Files close at ``most`` ids; a single text is never cut.
    """
    ranged = (
        docs.select(docs["doc_id"].cast("bigint").alias("_id"), docs["text"].alias("_text"))
        .repartitionByRange("_id").sortWithinPartitions("_id", "_text")
    )
    schema = "file string, first_id bigint, partition int, number int, n_docs bigint, n_ids bigint"
    files = settle(map_batches(
        ranged, _write, schema, path=vocabulary, folder=folder, end_id=end_id, kind=kind, block=block, most=most,
    ), "planes-manifest")
    before = W.orderBy(F.asc_nulls_first("first_id"), "partition", "number").rowsBetween(W.unboundedPreceding, -1)
    return files.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def _read(batches: Iterator[dict]) -> Iterator[dict]:
    for batch in batches:
        for uri, base in zip(batch["file"].to_pylist(), batch["base"].to_pylist()):
            rows = []
            with open_file(uri) as file:
                for name, start, parts in PlaneReader(file).documents():
                    crc = 0
                    for part in parts:
                        crc = zlib.crc32(part.tobytes(), crc)
                    rows.append((name, base + start, sum(map(len, parts)), crc))
            names, starts, counts, sums = zip(*rows)
            yield {"doc_id": names, "start": starts, "n_tokens": counts, "ids_crc32": sums}


def read_report(manifest: DataFrame) -> DataFrame:
    """Read every file back: place, length and checksum of each document's ids."""
    spark = manifest.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    return map_batches(manifest.select("file", "base").repartition(tasks, "file"), _read, schema)


def op8_bitplanes(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_folder(spark, "planes")
    return read_report(write_planes(table(spark, sf_dir, "documents"), folder, public_tokenizers.path(VOCABULARY)))
