"""Near-duplicate documents by circulant MinHash (operator 2).

Two permutations of the 32-bit integers make all coordinates of a signature: the first scatters the shingles,
the second, shifted circularly by k, ranks them for coordinate k. Signatures are cut into bands; documents
that agree in a band are candidates, and every link is decided on the full shingle sets.

1. One pass over the texts: size and digest of the shingle set, and the band keys. Equal sets collapse to one
   representative (smallest id), so groups of copies cost one row.
2. Documents that agree in a band are a list of candidates. ``linking`` finds the links that connect each group:
   small families at once, larger ones by leaders first, so that a group of near copies of any size ships each
   text a bounded number of times. No bucket, family or partner is capped.

Bands are chosen so that a pair at the threshold is missed with a probability under 1e-8.

Null and empty texts, and texts without words, have an empty set and are linked with nothing. Rows that
share an id count as one document. A null id never represents others; alone it has a null component. Other
columns are ignored (``drop_near`` passes them on). An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeworks.llm.common import map_batches, settle, table, utf8
from tapeworks.llm.linking import FOLD, linked, mix64, shingle_set

COORDINATES = 160
MISS = 1e-8


def rows_per_band(percent: int, coordinates: int = COORDINATES) -> int:
    """The longest bands that still find a pair at the threshold, but for one in 1e8."""
    chance = percent / 100
    fitting = [r for r in range(1, 17) if (1 - chance**r) ** (coordinates // r) <= MISS]
    return max(fitting, default=1)


def _permute(x: np.ndarray) -> np.ndarray:
    """A permutation of the 32-bit integers, in place."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(0x7FEB352D)
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x846CA68B)
    x ^= x >> np.uint32(16)
    return x


def signature(shingles: np.ndarray, coordinates: int = COORDINATES) -> np.ndarray:
    """Coordinate k is the least second-permutation value of the scattered shingles, shifted by k."""
    scattered = _permute((shingles ^ (shingles >> np.uint64(32))).astype(np.uint32))
    shift = np.arange(coordinates, dtype=np.uint32)[:, None]
    out = np.full(coordinates, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(scattered), 256):
        ranked = scattered[None, at:at + 256] - shift
        np.minimum(out, _permute(ranked + np.uint32(0x9E3779B9)).min(axis=1), out=out)
    return out


def band_keys(values: np.ndarray, rows: int) -> np.ndarray:
    bands = len(values) // rows
    cut = values[:bands * rows].reshape(bands, rows).astype(np.uint64)
    key = np.arange(bands, dtype=np.uint64) + np.uint64(1)
    for i in range(rows):
        key = mix64(key * FOLD[i] + cut[:, i])
    return key.view(np.int64)


def _sketch(batches: Iterator[dict], words: int, rows: int) -> Iterator[dict]:
    for batch in batches:
        sizes, digests, bands = [], [], []
        for raw in utf8(batch["_text"]):
            shingles = shingle_set(raw, words)
            sizes.append(len(shingles))
            digests.append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None)
            bands.append(band_keys(signature(shingles), rows) if len(shingles) else None)
        yield {"_id": batch["_id"], "_n": sizes, "_digest": digests, "_bands": bands}


def sketches(docs: DataFrame, words: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    narrow = docs.select(docs[id_col].cast("bigint").alias("_id"), docs[text_col].alias("_text"))
    return settle(map_batches(
        narrow, _sketch, "_id bigint, _n bigint, _digest binary, _bands array<bigint>", words=words, rows=rows_per_band(percent)
    ), "sketches")


def near_groups(
    docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(_id, _n, _component) per row of ``docs``: size of its shingle set, smallest id it is connected with."""
    sketched = sketches(docs, words, percent, id_col, text_col)
    classes = settle(
        sketched.filter("_n > 0").groupBy("_digest")
        .agg(F.min("_id").alias("_rep"), F.min("_n").alias("_n"), F.min_by("_bands", "_id").alias("_bands"), F.count("*").alias("_rows")),
        "classes",
    )
    reps = classes.filter("_rep IS NOT NULL")
    bands = reps.select("_rep", "_n", F.posexplode("_bands").alias("_band", "_value")).select(F.xxhash64("_band", "_value").alias("_key"), "_rep", "_n")
    texts = docs.select(docs[id_col].cast("bigint").alias("_id"), docs[text_col].alias("_text"))
    roots = linked(texts, bands, words, percent)
    changed = classes.join(roots, F.col("_rep") == F.col("_node"), "left").select(
        F.col("_digest").alias("_d"), F.coalesce("_root", "_rep").alias("_component"), "_rows", "_rep"
    ).filter("_rows > 1 OR _component != _rep").select("_d", "_component")
    return sketched.join(changed, F.col("_digest") == F.col("_d"), "left").select(
        "_id", "_n", F.coalesce("_component", "_id").alias("_component")
    )


def drop_near(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of their group, with all their columns."""
    groups = near_groups(docs, words, percent, id_col, text_col)
    stay = groups.filter(F.col("_id").eqNullSafe(F.col("_component"))).select("_id").distinct()
    return docs.join(stay.hint("shuffle_hash"), docs[id_col].cast("bigint").eqNullSafe(stay["_id"]), "left_semi")


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = near_groups(table(spark, sf_dir, "documents"), words=3, percent=85)
    return groups.select(
        F.col("_id").alias("doc_id"), F.col("_n").alias("n_shingles"), F.col("_component").alias("component_id"),
        F.col("_id").eqNullSafe(F.col("_component")).alias("kept"),
    )


OP2_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
  ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS g FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b USING (g) WHERE a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 85 * (a.n + b.n - c)),
e AS (SELECT x AS a, y AS b FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT doc_id AS id, doc_id AS c FROM documents UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.id),
m AS (SELECT id, min(c) AS component_id FROM r GROUP BY 1)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM documents LEFT JOIN n USING (doc_id) JOIN m ON m.id = doc_id
"""
