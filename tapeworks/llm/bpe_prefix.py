"""Byte-level BPE by dynamic programming over prefixes (operator 7).

For every prefix of a piece there is exactly one last token with which the prefix's encoding ends. The
table of these tokens is the whole state: the encoding is read off backwards, appended bytes only extend
the table, and after an edit only the rows behind it are computed again.

Which token it is follows from pairs alone: a token may follow another if merging the two byte strings
together would leave exactly these two tokens.

Null and empty texts have no tokens. Repeated rows and repeated ids are encoded row by row. Other columns
of the input are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tapeworks.llm.common import keep_between_tasks, map_batches, table, texts
from tapeworks.llm.pieces import pieces

RANKS = "byte_bpe_multi_50k.tiktoken"
ALIVE = 1 << 60  # the rank at which a whole token is merged away: never
PAIRS_KEPT = 300_000
PIECES_KEPT = 400_000


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}


class Vocabulary:
    """Ranks, and how each token comes about: the two tokens of its last merge."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.longest = max(map(len, ranks), default=1)
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.parts: dict[int, tuple[int, int] | None] = {}
        self.usable: dict[bytes, int] = {}
        for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
            if len(token) == 1:
                self.parts[rank] = None
            else:
                halves = self._merged(token, rank)
                if len(halves) != 2:  # never comes out of merging
                    continue
                self.parts[rank] = halves
            self.usable[token] = rank
        self._pairs: dict[int, bool] = {}

    def _merged(self, token: bytes, below: int) -> tuple[int, ...]:
        """Plain merging with ranks under ``below``; only used on single tokens, to set up the tables."""
        parts = [token[i:i + 1] for i in range(len(token))]
        while len(parts) > 1:
            ranked = [(self.ranks.get(a + b, below), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))]
            rank, i = min(ranked)
            if rank >= below:
                break
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return tuple(self.ranks[p] for p in parts)

    def follows(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both tokens gives just these two.

        Walks back in time along the pieces that touched at the border. Two of them that existed together
        and form a token of a rank lower than the merges that used them would have been merged first; of
        equal ranks the left one goes first.
        """
        key = left << 20 | right
        known = self._pairs.get(key)
        if known is None:
            if len(self._pairs) >= PAIRS_KEPT:
                self._pairs.clear()
            known = self._pairs[key] = self._touch(left, right)
        return known

    def _touch(self, left: int, right: int) -> bool:
        name, rank, parts = self.bytes_of, self.ranks, self.parts
        left_until = right_until = ALIVE
        while True:
            joined = rank.get(name[left] + name[right])
            if joined is not None and joined < left_until and joined <= right_until:
                return False
            left_parts, right_parts = parts[left], parts[right]
            if left_parts is None and right_parts is None:
                return True
            if right_parts is None or (left_parts is not None and left > right):
                left_until, left = left, left_parts[1]
            else:
                right_until, right = right, right_parts[0]


class Prefixes:
    """The last token of every prefix of a growing piece."""

    def __init__(self, vocabulary: Vocabulary, piece: bytes = b""):
        self.vocabulary, self.piece, self.last = vocabulary, b"", [-1]
        self.append(piece)

    def append(self, more: bytes) -> None:
        start = len(self.piece)
        self.piece += more
        piece, last, v = self.piece, self.last, self.vocabulary
        usable, longest, pairs, follows = v.usable, v.longest, v._pairs, v.follows
        for end in range(start + 1, len(piece) + 1):
            for begin in range(end - 1, max(-1, end - longest - 1), -1):
                token = usable.get(piece[begin:end])
                if token is not None:
                    before = last[begin]
                    known = pairs.get(before << 20 | token) if begin else True
                    if known or known is None and follows(before, token):
                        last.append(token)
                        break
            else:
                raise ValueError("a byte of the text is missing in the vocabulary")

    def edit(self, begin: int, end: int, new: bytes) -> None:
        """Replace bytes [begin, end); prefixes up to ``begin`` keep their tokens."""
        tail = self.piece[end:]
        self.piece, self.last = self.piece[:begin], self.last[:begin + 1]
        self.append(new + tail)

    def tokens(self, end: int | None = None) -> list[int]:
        """The encoding of the first ``end`` bytes."""
        end = len(self.piece) if end is None else end
        out = []
        while end:
            out.append(self.last[end])
            end -= len(self.vocabulary.bytes_of[out[-1]])
        return out[::-1]


class Encoder(dict):
    """Piece -> its ids as little-endian 32-bit integers. Words return often, so pieces are kept, up to a bound."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, piece: str) -> bytes:
        raw = piece.encode()
        whole = self.vocabulary.ranks.get(raw)
        ids = [whole] if whole is not None else Prefixes(self.vocabulary, raw).tokens()
        packed = np.array(ids, "<u4").tobytes()
        if len(raw) <= 64:
            if len(self) >= PIECES_KEPT:
                self.clear()
            self[piece] = packed
        return packed

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, pieces(text)))

    def decode(self, packed: bytes) -> bytes:
        return b"".join(map(self.vocabulary.bytes_of.__getitem__, memoryview(packed).cast("I")))


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One per Python worker and vocabulary file."""
    if path not in _encoders:
        keep_between_tasks(__name__, _encoders.clear)
        _encoders[path] = Encoder(Vocabulary(read_ranks(path)))
    return _encoders[path]


def _encode(batches: Iterator[dict], path: str) -> Iterator[dict]:
    own = encoder(path)
    for batch in batches:
        yield {"_id": batch["_id"], "ids": [own.encode(x) for x in texts(batch["_text"])]}


def _decode(batches: Iterator[dict], path: str) -> Iterator[dict]:
    own = encoder(path)
    for batch in batches:
        yield {"_id": batch["_id"], "raw": [own.decode(x or b"") for x in batch["ids"].to_pylist()]}


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids): the ids of each whole text, packed as little-endian unsigned 32-bit integers. No shuffle."""
    narrow = docs.select(docs[id_col].alias("_id"), docs[text_col].alias("_text"))
    kind = docs.schema[id_col].dataType.simpleString()
    return map_batches(narrow, _encode, f"_id {kind}, ids binary", path=path).withColumnRenamed("_id", id_col)


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id") -> DataFrame:
    """(id, raw): the bytes behind packed ids."""
    narrow = encoded.select(encoded[id_col].alias("_id"), encoded["ids"])
    kind = encoded.schema[id_col].dataType.simpleString()
    return map_batches(narrow, _decode, f"_id {kind}, raw binary", path=path).withColumnRenamed("_id", id_col)


def _round_trip(batches: Iterator[dict], path: str) -> Iterator[dict]:
    own = encoder(path)
    for batch in batches:
        counts, ids_sha, raw_sha = [], [], []
        for text in texts(batch["_text"]):
            packed = own.encode(text)
            counts.append(len(packed) // 4)
            ids_sha.append(hashlib.sha256(packed).hexdigest())
            raw_sha.append(hashlib.sha256(own.decode(packed)).hexdigest())
        yield {"doc_id": batch["_id"], "n_tokens": counts, "ids_sha256": ids_sha, "decoded_sha256": raw_sha}


def encode_report(docs: DataFrame, path: str) -> DataFrame:
    """Per document: number of ids, digest of the ids, digest of the bytes they decode to.

    Encodes and decodes in one pass, so that ids need not travel.
    """
    narrow = docs.select(docs["doc_id"].alias("_id"), docs["text"].alias("_text"))
    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return map_batches(narrow, _round_trip, schema, path=path)


def op7_bpe_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_report(table(spark, sf_dir, "documents"), public_tokenizers.path(RANKS))
