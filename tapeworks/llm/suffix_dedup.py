"""Removal of repeated byte strings by sharded suffix arrays (operator 5).

Every byte that lies in a string of ``length`` bytes which also starts anywhere else, in the same or another
document, is removed; all strings are judged on the input. Texts are UTF-8 bytes.

1. *Candidates.* Each window of ``length`` bytes is put to the anchor in it, the 128-byte string with the
   least hash. Equal windows have equal anchors at equal places, so only windows of anchors that occur twice
   can repeat. Consecutive windows of one anchor form a segment, at most 672 bytes long. Equal texts, then
   equal segments, are counted and go on once; only the others need comparing.
2. *Shards.* Segments meet by anchor and are packed into shards of about ``shard_bytes``; an anchor with more
   than that is spread over several. Each shard gets a suffix array (Larsson-Sadakane) and common prefixes
   (Kasai). Neighbours with ``length`` bytes in common are repeated windows.
3. *Merging.* For anchors in several shards, each shard sends its windows as sorted fingerprints (128 bits),
   cut by binary search into ranges; a task per range merges the shards' pieces, again by binary search, and
   reports the windows that more than one shard has.
4. Windows become spans, and each text that has any is cut.

No step gathers a group: texts of a group of copies are counted, hot anchors are spread, ranges of their
fingerprints are as many as their shards. Tables between the steps are in the shared folder.

Null texts are empty. Equal rows are copies of each other, whatever their ids (also repeated or null ones).
Texts shorter than ``length`` keep all. Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeworks.llm.common import map_batches, settle, table, utf8
from tapeworks.llm.suffix_arrays import Strings

LENGTH = 400
GRAM = 128
SHARD_BYTES = 1 << 20
BUFFER_BYTES = 1 << 20
_PLACE = np.uint64(31)  # bits of a packed place
_MASK = np.uint64((1 << 31) - 1)
_SEEDS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_PIECE = np.dtype([("low", "<u8"), ("high", "<u8"), ("segment", "<i8"), ("at", "<i4")])
RESOLVED = -1


def _join(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of two hashes, order included."""
    x = a * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    x += b
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(32)
    return x


def grams(data: np.ndarray, widths: tuple[int, ...], seed: int = _SEEDS[0]) -> dict[int, np.ndarray]:
    """Hashes of the strings of each width (powers of two) that start at each place, by doubling."""
    out, width = {}, 1
    hashed = (data.astype(np.uint64) + np.uint64(1)) * np.uint64(seed)
    hashed ^= hashed >> np.uint64(31)
    while width <= max(widths):
        if width in widths:
            out[width] = hashed
        if len(hashed) <= width:
            hashed = np.empty(0, np.uint64)
        else:
            hashed = _join(hashed[:len(hashed) - width], hashed[width:])
        width *= 2
    return out


def window_hash(data: np.ndarray, length: int, seed: int) -> np.ndarray:
    """Hash of the ``length`` bytes at each place, from the two longest grams that cover them."""
    width = 1 << (length.bit_length() - 1)
    gram = grams(data, (width,), seed)[width]
    n = len(data) - length + 1
    return _join(gram[:n], gram[length - width:length - width + n])


def least_places(values: np.ndarray, width: int) -> np.ndarray:
    """For each place, the place of the least of the next ``width`` values, the first of equal ones."""
    packed = values >> _PLACE << _PLACE | np.arange(len(values), dtype=np.uint64)
    span = 1
    while span * 2 <= width:
        packed = np.minimum(packed[:len(packed) - span], packed[span:])
        span *= 2
    n = len(values) - width + 1
    return (np.minimum(packed[:n], packed[width - span:width - span + n]) & _MASK).astype(np.int64)


def segments(data: np.ndarray, ends: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(text, anchor, digest, start, windows) of each segment of texts laid end to end; start is within all."""
    n = len(data) - length + 1
    if n <= 0:
        return tuple(np.empty(0, np.int64) for _ in range(5))
    wide = 1 << (length.bit_length() - 1)
    hashed = grams(data, (gram, wide))
    place = least_places(hashed[gram], length - gram + 1)
    text = np.searchsorted(ends, np.arange(n), side="right")
    whole = np.arange(n) + length <= ends[text]
    start = np.flatnonzero(whole)
    if not len(start):
        return tuple(np.empty(0, np.int64) for _ in range(5))
    place, text = place[start], text[start]
    opens = np.concatenate([[True], (place[1:] != place[:-1]) | (text[1:] != text[:-1]) | (start[1:] != start[:-1] + 1)])
    first = np.flatnonzero(opens)
    count = np.diff(np.append(first, len(start)))
    begin, last = start[first], start[first] + count + length - 1 - wide
    digest = _join(hashed[wide][begin], hashed[wide][(begin + last) // 2])  # three overlapping grams cover a segment
    digest = _join(_join(digest, hashed[wide][last]), count.astype(np.uint64))
    return text[first], hashed[gram][place[first]].view(np.int64), digest.view(np.int64), begin, count


def _segment_rows(batches: Iterator[dict], length: int, gram: int) -> Iterator[dict]:
    for batch in batches:
        raws = utf8(batch["_text"])
        found: list[list[np.ndarray]] = []
        buffer, rows, offsets, held = [], [], [], 0

        def flush() -> None:
            nonlocal buffer, rows, offsets, held
            if buffer:
                ends = np.cumsum([len(b) for b in buffer])
                text, anchor, digest, start, count = segments(np.frombuffer(b"".join(buffer), np.uint8), ends, length, gram)
                begins = ends - [len(b) for b in buffer]
                found.append([np.array(rows)[text], anchor, digest, start - begins[text] + np.array(offsets)[text], count])
            buffer, rows, offsets, held = [], [], [], 0

        for row, raw in enumerate(raws):
            # Long texts go in parts that overlap by a window less one byte; a cut segment is compared like any other.
            for at in range(0, max(len(raw) - length + 1, 0), BUFFER_BYTES):
                part = raw[at:at + BUFFER_BYTES + length - 1]
                buffer.append(part)
                rows.append(row)
                offsets.append(at)
                held += len(part)
                if held >= BUFFER_BYTES:
                    flush()
        flush()
        owner, anchor, digest, start, count = (np.concatenate(x) for x in zip(*found)) if found else (np.empty(0, np.int64),) * 5
        cuts = pa.array(np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(raws)))]).astype(np.int32))
        lists = {
            name: pa.ListArray.from_arrays(cuts, pa.array(values.astype(kind)))
            for name, values, kind in (("_as", anchor, np.int64), ("_hs", digest, np.int64), ("_ss", start, np.int32), ("_ws", count, np.int32))
        }
        yield {"_id": batch["_id"], "_sha": [hashlib.sha256(r).digest() for r in raws], "_size": [len(r) for r in raws], **lists}


def repeated_windows(strings: list[bytes], length: int) -> tuple[Strings, np.ndarray, np.ndarray]:
    """(strings, number of the class of each place, size of each class); places without a whole window have none (-1)."""
    laid = Strings(strings)
    order, rank = laid.suffix_array()
    common = laid.common_prefixes(order, rank)
    whole = laid.border[order] - order >= length
    windows = order[whole]
    opens = common[whole] < length  # between equal windows there are only windows equal to them
    number = np.cumsum(opens) - 1
    classes = np.full(laid.n, -1, np.int64)
    classes[windows] = number
    return laid, classes, np.bincount(number) if len(number) else np.empty(0, np.int64)


def _runs(marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    edge = np.diff(np.concatenate([[0], marks.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _no_rows() -> dict[str, list]:
    return {c: [] for c in ("_a", "_h", "_from", "_to", "_range", "_piece")}


def _shard(rows: list[tuple], length: int) -> dict[str, list]:
    """rows: (anchor, digest, copies, shards of the anchor, bytes)."""
    laid, classes, sizes = repeated_windows([r[4] for r in rows], length)
    out = _no_rows()
    marks = classes >= 0
    marks[marks] = sizes[classes[marks]] > 1
    spread = np.array([r[3] for r in rows])
    copies = np.array([r[2] for r in rows])
    for i in np.flatnonzero(copies == 1):
        begin = laid.starts[i]
        for low, high in zip(*_runs(marks[begin:laid.borders[i]])):
            for column, value in zip(("_a", "_h", "_from", "_to", "_range", "_piece"), (rows[i][0], rows[i][1], low, high, None, None)):
                out[column].append(value)
    if (spread > 1).any():
        _send(rows, laid, classes, marks, spread, copies, length, out)
    return out


def _send(rows, laid: Strings, classes, marks, spread, copies, length: int, out: dict[str, list]) -> None:
    """Sorted fingerprints of the distinct windows of anchors that lie in several shards, cut into ranges."""
    low, high = (window_hash(laid.data, length, seed) for seed in _SEEDS)
    anchors = np.array([r[0] for r in rows])
    digests = np.array([r[1] for r in rows])
    places = np.flatnonzero(classes[:len(low)] >= 0)
    places = places[spread[laid.owner[places]] > 1]
    _, one = np.unique(classes[places], return_index=True)
    places = places[one]
    owner = laid.owner[places]
    for anchor in np.unique(anchors[owner]):
        mine = places[anchors[owner] == anchor]
        own = laid.owner[mine]
        piece = np.empty(len(mine), _PIECE)
        piece["low"], piece["high"], piece["segment"] = low[mine], high[mine], digests[own]
        piece["at"] = np.where(marks[mine] | (copies[own] > 1), RESOLVED, mine - laid.starts[own])
        piece = piece[np.lexsort((piece["high"], piece["low"]))]
        ranges = int(spread[own[0]])
        borders = np.array([(i << 64) // ranges for i in range(1, ranges)], np.uint64)
        cuts = np.concatenate([[0], np.searchsorted(piece["low"], borders), [len(piece)]])
        for i in range(ranges):
            if cuts[i] < cuts[i + 1]:
                for column, value in zip(("_a", "_h", "_from", "_to", "_range", "_piece"), (anchor, None, None, None, i, piece[cuts[i]:cuts[i + 1]].tobytes())):
                    out[column].append(value)


def _by_key(batches: Iterator[dict], keys: list[str], columns: list[str]) -> Iterator[tuple[tuple, list[tuple]]]:
    """Runs of equal keys in sorted rows, over batch borders."""
    current, rows = None, []
    for batch in batches:
        lists = [batch[c].to_pylist() for c in (*keys, *columns)]
        for row in zip(*lists):
            key, rest = row[:len(keys)], row[len(keys):]
            if key != current:
                if rows:
                    yield current, rows
                current, rows = key, []
            rows.append(rest)
    if rows:
        yield current, rows


def _shards(batches: Iterator[dict], length: int, shard_bytes: int) -> Iterator[dict]:
    waiting, held = [], 0
    for (anchor, _), rows in _by_key(batches, ["_a", "_part"], ["_h", "_copies", "_parts", "_bytes"]):
        size = sum(len(r[3]) for r in rows)
        if waiting and held + size > shard_bytes:
            yield _shard(waiting, length)
            waiting, held = [], 0
        waiting += [(anchor, *r) for r in rows]
        held += size
    if waiting:
        yield _shard(waiting, length)


def _merge(left: np.ndarray, right: np.ndarray, hits: list[np.ndarray]) -> np.ndarray:
    """Two sorted pieces into one; windows that both have are reported, and stay as resolved."""
    at = np.searchsorted(left["low"], right["low"], side="left")
    until = np.searchsorted(left["low"], right["low"], side="right")
    same = np.full(len(right), -1, np.int64)
    for i in np.flatnonzero(until > at):
        found = at[i] + np.searchsorted(left["high"][at[i]:until[i]], right["high"][i])
        if found < until[i] and left["high"][found] == right["high"][i]:
            same[i] = found
    both = same >= 0
    for part in (left[same[both]], right[both]):
        hits.append(part[part["at"] != RESOLVED])
    left = left.copy()
    left["at"][same[both]] = RESOLVED
    rest = right[~both]
    return np.insert(left, np.searchsorted(left["low"], rest["low"], side="right"), rest) if not _tied(left, rest) else _sorted(left, rest)


def _tied(left: np.ndarray, rest: np.ndarray) -> bool:
    """Whether windows share the first half of their fingerprints."""
    return bool((np.searchsorted(left["low"], rest["low"], side="left") != np.searchsorted(left["low"], rest["low"], side="right")).any())


def _sorted(left: np.ndarray, rest: np.ndarray) -> np.ndarray:
    whole = np.concatenate([left, rest])
    return whole[np.lexsort((whole["high"], whole["low"]))]


def _merges(batches: Iterator[dict]) -> Iterator[dict]:
    for (anchor, _), rows in _by_key(batches, ["_a", "_range"], ["_piece"]):
        pieces, hits = [np.frombuffer(r[0], _PIECE) for r in rows], []
        while len(pieces) > 1:
            merged = [_merge(a, b, hits) for a, b in zip(pieces[::2], pieces[1::2])]
            pieces = merged + ([pieces[-1]] if len(pieces) % 2 else [])
        found = np.concatenate(hits) if hits else np.empty(0, _PIECE)
        if not len(found):
            continue
        found = found[np.lexsort((found["at"], found["segment"]))]
        opens = np.concatenate([[True], (found["segment"][1:] != found["segment"][:-1]) | (found["at"][1:] != found["at"][:-1] + 1)])
        first = np.flatnonzero(opens)
        last = np.append(first[1:], len(found)) - 1
        yield {
            "_a": np.full(len(first), anchor), "_h": found["segment"][first], "_from": found["at"][first], "_to": found["at"][last] + 1,
        }


def _cut_text(batches: Iterator[dict], wanted: str) -> Iterator[dict]:
    """The bytes of each wanted segment."""
    for batch in batches:
        out: dict[str, list] = {"_a": [], "_h": [], "_copies": [], "_parts": [], "_part": [], "_bytes": []}
        for raw, own in zip(utf8(batch["_text"]), batch[wanted].to_pylist()):
            for s in own:
                for c in ("_a", "_h", "_copies", "_parts", "_part"):
                    out[c].append(s[c])
                out["_bytes"].append(raw[s["_s"]:s["_s"] + s["_end"]])
        yield out


def _remove(batches: Iterator[dict], length: int, with_text: bool) -> Iterator[dict]:
    for batch in batches:
        out: dict[str, list] = {"_key": batch["_key"], "_removed": [], "_spans": [], "_kept_sha": [], "_kept": []}
        for raw, spans in zip(utf8(batch["_text"]), batch["_starts"].to_pylist()):
            cover = np.zeros(len(raw) + 1, np.int32)
            np.add.at(cover, [s["_from"] for s in spans], 1)
            np.subtract.at(cover, [s["_to"] + length - 1 for s in spans], 1)
            gone = np.cumsum(cover[:-1]) > 0
            left = np.frombuffer(raw, np.uint8)[~gone].tobytes()
            starts, ends = _runs(gone)
            out["_removed"].append(int(gone.sum()))
            out["_spans"].append([{"start": a, "end": b} for a, b in zip(starts.tolist(), ends.tolist())])
            out["_kept_sha"].append(hashlib.sha256(left).digest())
            out["_kept"].append(left if with_text else None)
        yield out


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, shard_bytes: int = SHARD_BYTES, id_col: str = "doc_id",
    text_col: str = "text", with_text: bool = False,
) -> DataFrame:
    """(_id, _size, _removed, _spans, _kept_sha, _kept) per row of ``docs``.

    ``_spans`` are the removed runs (start, end) in bytes. ``_kept``, the bytes that stay, comes only
    ``with_text`` and only for texts with both removed and kept bytes.
    """
    if gram & (gram - 1) or gram > length or 2 * length - gram > 3 << (length.bit_length() - 1):
        raise ValueError("gram must be a power of two, at most length, and large enough for three hashes to cover a segment")
    spark = docs.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    plain = docs.select(docs[id_col].cast("bigint").alias("_id"), F.coalesce(docs[text_col], F.lit("")).alias("_text"))
    base = settle(map_batches(
        plain, _segment_rows, "_id bigint, _sha binary, _size bigint, _as array<bigint>, _hs array<bigint>, _ss array<int>, _ws array<int>",
        length=length, gram=gram,
    ), "segments")
    lists = ("_as", "_hs", "_ss", "_ws")
    whole = settle(
        base.groupBy("_sha").agg(F.count("*").alias("_rows"), F.min("_id").alias("_pick"), F.min("_size").alias("_size"), *(F.first(c).alias(c) for c in lists)),
        "distinct-texts",
    )
    each = whole.select("_sha", "_rows", "_pick", F.explode(F.arrays_zip(*lists)).alias("z")).select(
        "_sha", "_rows", "_pick", F.col("z._as").alias("_a"), F.col("z._hs").alias("_h"), F.col("z._ss").alias("_s"), F.col("z._ws").alias("_w")
    )
    kinds = each.groupBy("_a", "_h").agg(F.sum("_rows").alias("_copies"), F.min(F.struct("_sha", "_s", "_w", "_pick")).alias("_rep"))
    kinds = settle(kinds, "segment-kinds")
    anchors = kinds.groupBy("_a").agg(
        F.count("*").alias("_kinds"), F.min("_copies").alias("_least"), F.sum("_copies").alias("_all"), F.sum(F.col("_rep._w") + length).alias("_load")
    ).filter("_all > 1")
    unequal = anchors.filter("_kinds > 1 AND _least = 1").select(
        "_a", F.ceil(F.col("_load") / shard_bytes).cast("int").alias("_parts")
    )
    compared = settle(kinds.join(unequal, "_a").select(
        "_a", "_h", "_copies", "_parts", F.pmod("_h", "_parts").cast("int").alias("_part"), F.col("_rep._sha").alias("_key"),
        F.col("_rep._pick").alias("_pick"), F.col("_rep._s").alias("_s"), (F.col("_rep._w") + length - 1).alias("_end"),
    ), "compared-segments")
    equal = kinds.filter("_copies > 1").select(F.col("_a").alias("_ea"), F.col("_h").alias("_eh"))
    single = each.filter("_rows = 1")
    settled = single.join(equal, (F.col("_a") == F.col("_ea")) & (F.col("_h") == F.col("_eh"))).select(
        F.col("_sha").alias("_key"), "_pick", F.col("_s").alias("_from"), (F.col("_s") + F.col("_w")).alias("_to")
    )
    settled = settle(settled.groupBy("_key", "_pick").agg(F.collect_list(F.struct("_from", "_to")).alias("_starts")), "equal-segments")
    needed = compared.select("_key", "_pick").unionByName(settled.select("_key", "_pick")).distinct()
    keyed = plain.withColumn("_sha", F.unhex(F.sha2(F.col("_text").cast("binary"), 256)))
    texts = settle(
        keyed.join(needed.hint("shuffle_hash"), (F.col("_sha") == F.col("_key")) & F.col("_id").eqNullSafe(F.col("_pick"))).select("_key", "_text"),
        "candidate-texts",
    )
    asked = compared.groupBy("_key").agg(F.collect_list(F.struct("_a", "_h", "_copies", "_parts", "_part", "_s", "_end")).alias("_asked"))
    rows = map_batches(
        texts.join(asked.hint("shuffle_hash"), "_key").select("_text", "_asked"), _cut_text,
        "_a bigint, _h bigint, _copies bigint, _parts int, _part int, _bytes binary", wanted="_asked",
    )
    dealt = rows.repartition(tasks, "_a", "_part").sortWithinPartitions("_a", "_part", "_h")
    found = settle(map_batches(
        dealt, _shards, "_a bigint, _h bigint, _from int, _to int, _range int, _piece binary", length=length, shard_bytes=shard_bytes,
    ), "shards")
    sent = found.filter("_piece IS NOT NULL").select("_a", "_range", "_piece").repartition(tasks, "_a", "_range").sortWithinPartitions("_a", "_range")
    merged = map_batches(sent, _merges, "_a bigint, _h bigint, _from int, _to int")
    windows = found.filter("_piece IS NULL").select("_a", "_h", "_from", "_to").unionByName(merged)
    where = compared.filter("_copies = 1").select(F.col("_a").alias("_ca"), F.col("_h").alias("_ch"), "_key", "_s")
    spans = windows.join(where, (F.col("_a") == F.col("_ca")) & (F.col("_h") == F.col("_ch"))).select(
        "_key", (F.col("_s") + F.col("_from")).alias("_from"), (F.col("_s") + F.col("_to")).alias("_to")
    ).groupBy("_key").agg(F.collect_list(F.struct("_from", "_to")).alias("_starts"))
    starts = spans.unionByName(settled.select("_key", "_starts")).groupBy("_key").agg(F.flatten(F.collect_list("_starts")).alias("_starts"))
    kind = "_key binary, _removed bigint, _spans array<struct<start:int, end:int>>, _kept_sha binary, _kept binary"
    cut = map_batches(texts.join(starts.hint("shuffle_hash"), "_key").select("_key", "_text", "_starts"), _remove, kind, length=length, with_text=with_text)
    cut = cut.dropDuplicates(["_key"])  # rows that repeat a null id
    all_gone = whole.filter((F.col("_rows") > 1) & (F.col("_size") >= length)).select(
        F.col("_sha").alias("_key"), F.col("_size").alias("_removed"),
        F.array(F.struct(F.lit(0).alias("start"), F.col("_size").cast("int").alias("end"))).alias("_spans"),
        F.unhex(F.sha2(F.lit(b""), 256)).alias("_kept_sha"), F.lit(None).cast("binary").alias("_kept"),
    )
    changed = cut.join(all_gone.select("_key"), "_key", "left_anti").unionByName(all_gone)
    return base.select("_id", "_sha", "_size").join(changed, F.col("_sha") == F.col("_key"), "left").select(
        "_id", "_size", F.coalesce("_removed", F.lit(0)).alias("_removed"),
        F.coalesce("_spans", F.array().cast("array<struct<start:int,end:int>>")).alias("_spans"),
        F.coalesce("_kept_sha", "_sha").alias("_kept_sha"), "_kept",
    )


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).select(
        F.col("_id").alias("doc_id"), F.col("_size").alias("n_bytes"), F.col("_removed").alias("n_removed"),
        F.size("_spans").cast("bigint").alias("n_spans"), F.lower(F.hex("_kept_sha")).alias("kept_sha256"),
    )
