"""WARC records in seekable Zstandard bundles (operator 1).

A bundle is a file of independent zstd frames, each with whole WARC records up to a size, followed by a
skippable frame with the record index (record id -> frame, offset within the frame, length) and, last, by a
skippable frame with the seek table of the public seekable format. One record is read with three range
reads: seek table, index, and its frame. Any zstd tool can unpack the file as a plain .warc.zst.

Of pages with equal payloads of at least ``least`` bytes, that with the largest id is written as a response,
the others as revisits that refer to it. A revisit has no payload; its header carries the full payload's
digest and length. Equality is decided on SHA-256; SHA-1 is what the headers show.

A null html is an empty payload, a null url leaves the target out. A null id is written as ``null`` and is
always a response; rows that repeat the largest id of a group are all responses. Other columns are ignored.
An empty table gives no bundle. Bundles count only when the manifest names them, so the files of lost or
repeated attempts are never read.
"""

from __future__ import annotations

import hashlib
import json
import struct
from collections.abc import Iterator
from urllib.parse import quote

import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeworks.llm.common import map_batches, settle, table
from tapeworks.llm.files import create, new_name, open_file
from tapeworks.session import work_folder

FRAME_BYTES = 256 << 10
BUNDLE_BYTES = 256 << 20
LEAST_BYTES = 1000
DATE = "2024-01-01T00:00:00Z"
URN = "urn:page:"
# Fixed values of the formats.
INDEX_MAGIC = 0x184D2A51
SEEK_MAGIC = 0x184D2A5E
SEEK_END = 0x8F92EAB1
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"


def record_bytes(page_id, url: str | None, payload: bytes, refers_to, date: str = DATE) -> tuple[str, bytes]:
    """(record id, WARC record); a revisit if ``refers_to`` is given."""
    name = f"{URN}{'null' if page_id is None else page_id}"
    block = HTTP_HEAD % len(payload) + (b"" if refers_to is not None else payload)
    head = {
        "WARC-Type": "response" if refers_to is None else "revisit", "WARC-Record-ID": f"<{name}>", "WARC-Date": date,
        "WARC-Payload-Digest": f"sha1:{hashlib.sha1(payload).hexdigest()}", "WARC-Payload-Length": str(len(payload)),
        "Content-Type": "application/http;msgtype=response", "Content-Length": str(len(block)),
    }
    if url is not None:
        head["WARC-Target-URI"] = quote(url, safe="!#$%&'()*+,/:;=?@[]~-._")
    if refers_to is not None:
        head |= {"WARC-Refers-To": f"<{URN}{refers_to}>", "WARC-Profile": PROFILE}
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    return name, f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


def parse_record(raw: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """(headers, block, place behind the record)."""
    end = raw.index(b"\r\n\r\n", at)
    first, *lines = raw[at:end].decode().split("\r\n")
    if first != "WARC/1.1":
        raise ValueError("not at the start of a record")
    head = dict(line.split(": ", 1) for line in lines)
    start, size = end + 4, int(head["Content-Length"])
    return head, raw[start:start + size], start + size + 4


class BundleWriter:
    """Holds the records of one frame, and the index of one bundle."""

    def __init__(self, stream, frame_bytes: int = FRAME_BYTES, level: int = 3):
        self.stream, self.frame_bytes, self.pack = stream, frame_bytes, zstandard.ZstdCompressor(level=level)
        self.open, self.held, self.place = [], 0, 0
        self.frames: list[tuple[int, int]] = []
        self.index: list[tuple[str, int, int, int]] = []

    def add(self, name: str, record: bytes) -> None:
        if self.held and self.held + len(record) > self.frame_bytes:
            self._flush()
        self.index.append((name, len(self.frames), self.held, len(record)))
        self.open.append(record)
        self.held += len(record)

    def _flush(self) -> None:
        packed = self.pack.compress(b"".join(self.open))
        self._put(packed, self.held)
        self.open, self.held = [], 0

    def _put(self, packed: bytes, unpacked: int) -> None:
        self.stream.write(packed)
        self.frames.append((len(packed), unpacked))
        self.place += len(packed)

    def close(self) -> None:
        if self.held:
            self._flush()
        names = self.pack.compress(json.dumps(self.index).encode())
        self._put(struct.pack("<II", INDEX_MAGIC, len(names)) + names, 0)
        entries = b"".join(struct.pack("<II", *f) for f in self.frames)
        foot = struct.pack("<IBI", len(self.frames), 0, SEEK_END)
        self.stream.write(struct.pack("<II", SEEK_MAGIC, len(entries) + len(foot)) + entries + foot)
        self.stream.close()


class BundleReader:
    """Range reads: frames by number, records by id."""

    def __init__(self, file):
        self.file, self.unpack = file, zstandard.ZstdDecompressor()
        size = file.size()
        count, _, magic = struct.unpack("<IBI", file.read_at(9, size - 9))
        if magic != SEEK_END:
            raise ValueError("no seek table")
        entries = struct.iter_unpack("<II", file.read_at(8 * count, size - 9 - 8 * count))
        self.frames, place = [], 0  # (place, packed size, unpacked size)
        for packed, unpacked in entries:
            self.frames.append((place, packed, unpacked))
            place += packed

    def frame(self, number: int) -> bytes:
        place, packed, unpacked = self.frames[number]
        return self.unpack.decompress(self.file.read_at(packed, place), max_output_size=unpacked)

    def index(self) -> list[list]:
        place, packed, _ = self.frames[-1]
        return json.loads(self.unpack.decompress(self.file.read_at(packed, place)[8:]))

    def record(self, name: str) -> list[tuple[dict[str, str], bytes]]:
        """All records of an id: usually one."""
        return [parse_record(self.frame(f)[at:at + size])[:2] for n, f, at, size in self.index() if n == name]


def _write(batches: Iterator[dict], folder: str, frame_bytes: int, bundle_bytes: int, date: str) -> Iterator[dict]:
    partition, number, writer, uri = TaskContext.get().partitionId(), 0, None, ""

    def done() -> dict:
        writer.close()
        return {"bundle": [uri], "n_frames": [len(writer.frames) - 1], "n_records": [len(writer.index)]}

    for batch in batches:
        rows = zip(*(batch[c].to_pylist() for c in ("page_id", "url", "payload", "refers_to")))
        for page_id, url, payload, refers_to in rows:
            if writer is None:
                uri, stream = create(folder, new_name(partition, number, ".warc.zst"))
                writer = BundleWriter(stream, frame_bytes)
            writer.add(*record_bytes(page_id, url, payload or b"", refers_to, date))
            if writer.place >= bundle_bytes:
                yield done()
                writer, number = None, number + 1
    if writer is not None:
        yield done()


def revisits(pages: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    """(_page, _key, refers_to) of the pages whose payload a page with a larger id has too."""
    long = pages.filter(F.octet_length("payload") >= least).select("page_id", F.unhex(F.sha2("payload", 256)).alias("_key"))
    keys = settle(long, "payload-keys")
    last = keys.groupBy("_key").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("_n")).filter("_n > 1")
    return (
        keys.join(last, "_key").filter(F.col("page_id") < F.col("refers_to"))
        .select(F.col("page_id").alias("_page"), "_key", "refers_to").distinct()
    )


def write_bundles(
    pages: DataFrame, folder: str, least: int = LEAST_BYTES, frame_bytes: int = FRAME_BYTES,
    bundle_bytes: int = BUNDLE_BYTES, date: str = DATE,
) -> DataFrame:
    """Write all pages(page_id, url, html); returns the manifest, one row per bundle.

    Which pages are revisits is found on (id, digest) rows. Payloads move once at most, by page id, so that a
    payload which very many pages share doesn't gather in one task.
    """
    plain = pages.select(
        pages["page_id"].cast("bigint").alias("page_id"), pages["url"].alias("url"),
        F.coalesce(pages["html"].cast("binary"), F.lit(b"")).alias("payload"),
    )
    earlier = revisits(plain, least).hint("shuffle_hash")
    keyed = plain.withColumn("_digest", F.unhex(F.sha2("payload", 256)))
    told = keyed.join(earlier, (F.col("page_id") == F.col("_page")) & (F.col("_digest") == F.col("_key")), "left")
    return settle(map_batches(
        told.select("page_id", "url", "payload", "refers_to"), _write, "bundle string, n_frames int, n_records bigint",
        folder=folder, frame_bytes=frame_bytes, bundle_bytes=bundle_bytes, date=date,
    ), "bundles-manifest")


def _page_of(urn: str) -> int | None:
    number = urn.strip("<>").removeprefix(URN)
    return None if number == "null" else int(number)


def _read(batches: Iterator[dict]) -> Iterator[dict]:
    for batch in batches:
        for bundle, frames in zip(batch["bundle"].to_pylist(), batch["frames"].to_pylist()):
            with open_file(bundle) as file:
                reader = BundleReader(file)
                for number in frames:
                    yield _frame_rows(reader.frame(number))


def _frame_rows(raw: bytes) -> dict:
    out: dict[str, list] = {c: [] for c in ("page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload")}
    at = 0
    while at < len(raw):
        head, block, at = parse_record(raw, at)
        size, digest = int(head["WARC-Payload-Length"]), head["WARC-Payload-Digest"].removeprefix("sha1:")
        payload = None
        if head["WARC-Type"] == "response":
            payload = block[block.index(b"\r\n\r\n") + 4:]
            if len(payload) != size or hashlib.sha1(payload).hexdigest() != digest:
                raise ValueError(f"damaged record {head['WARC-Record-ID']}")
        refers = head.get("WARC-Refers-To")
        row = (
            _page_of(head["WARC-Record-ID"]), head.get("WARC-Target-URI"), size, digest, head["WARC-Type"],
            None if refers is None else _page_of(refers), payload,
        )
        for column, value in zip(out.values(), row):
            column.append(value)
    return out


def read_bundles(manifest: DataFrame, frames_per_row: int = 32) -> DataFrame:
    """Every record of the bundles; the payloads of responses are checked against their digests.

    The work is dealt out by runs of frames, so a bundle may be read by many tasks.
    """
    spark = manifest.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    runs = manifest.filter("n_frames > 0").select(
        "bundle", "n_frames", F.explode(F.sequence(F.lit(0), F.col("n_frames") - 1, F.lit(frames_per_row))).alias("_from")
    )
    work = runs.select(
        "bundle", F.sequence(F.col("_from"), F.least(F.col("_from") + frames_per_row, "n_frames") - 1).alias("frames")
    )
    schema = (
        "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, "
        "refers_to bigint, payload binary"
    )
    return map_batches(work.repartition(tasks, "bundle", "frames"), _read, schema)


def op1_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = write_bundles(table(spark, sf_dir, "pages"), work_folder(spark, "bundles"))
    return read_bundles(manifest).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP1_SQL = """
SELECT page_id, strlen(p) AS payload_bytes, sha1(p) AS payload_digest,
       CASE WHEN strlen(p) >= 1000 AND page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN strlen(p) >= 1000 AND page_id < last THEN last END AS refers_to
FROM (SELECT page_id, coalesce(html, '') AS p, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS last FROM pages)
"""
