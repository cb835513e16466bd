"""Exact deduplication with a heavy-hitter split (operator 4).

Texts are equal when identical after lower-casing A-Z; null counts as empty. Their SHA-256 stands for them.

1. A Misra-Gries summary of each partition keeps ``counters`` digests with a lower bound of their counts.
   Of N rows, a digest with more than N / (counters + 1) is in at least one summary.
2. The summed bounds name at most ``counters`` candidates. Those are counted exactly, and the verified
   winners (digest, largest id, count) are broadcast: rows of frequent digests are settled where they lie.
3. All other digests have at most 2N / (counters + 1) rows and are grouped by an ordinary shuffle of
   (id, digest) rows; texts never move.

Rows that repeat both id and text are one document told twice: both carry ``kept``, and ``drop_copies``
returns one of them. Null ids lose against any other; where all ids of a group are null, ``keep_id`` is null
and all are kept as that one document. Other columns are ignored (``drop_copies`` passes them on). An empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeworks.llm.common import map_batches, settle, table, utf8

COUNTERS = 1024


def digest(raw: bytes) -> bytes:
    return hashlib.sha256(raw.lower()).digest()  # on bytes, lower() knows A-Z only


def _digests(batches: Iterator[dict]) -> Iterator[dict]:
    for batch in batches:
        yield {"_id": batch["_id"], "_digest": [digest(x) for x in utf8(batch["_text"])]}


def _digested_rows(batches, columns: list[str]) -> Iterator[dict]:
    for batch in batches:
        yield {**{c: batch[c] for c in columns}, "_digest": [digest(x) for x in utf8(batch["_text"])]}


def fold(summary: Counter, more: Counter, counters: int) -> Counter:
    """Misra-Gries summaries merged: add, then take the (counters + 1)-th largest count off all."""
    summary = summary + more
    if len(summary) > counters:
        off = sorted(summary.values(), reverse=True)[counters]
        summary = Counter({k: n - off for k, n in summary.items() if n > off})
    return summary


def _summaries(batches: Iterator[dict], counters: int) -> Iterator[dict]:
    summary: Counter = Counter()
    for batch in batches:
        summary = fold(summary, Counter(batch["_digest"].to_pylist()), counters)
    yield {"_digest": list(summary), "_least": list(summary.values())}


def heavy(digests: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """(_digest, _keep, _size) of the frequent digests, at most ``counters`` rows."""
    summaries = map_batches(digests.select("_digest"), _summaries, "_digest binary, _least bigint", counters=counters)
    bounds = summaries.groupBy("_digest").agg(F.sum("_least").alias("_least"))
    candidates = bounds.filter(F.col("_least") * (counters + 1) > F.lit(digests.count())).select("_digest")
    return (
        digests.join(F.broadcast(candidates), "_digest")  # the bounds add up to N at most: under counters + 1 rows
        .groupBy("_digest").agg(F.max("_id").alias("_keep"), F.count("*").alias("_size"))
    )


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = COUNTERS) -> DataFrame:
    """(_id, _digest, _keep, _size) per row of ``docs``: its digest, the id that stays, the size of its group."""
    narrow = docs.select(docs[id_col].cast("bigint").alias("_id"), docs[text_col].alias("_text"))
    digests = settle(map_batches(narrow, _digests, "_id bigint, _digest binary"), "digests")
    winners = settle(heavy(digests, counters), "winners")
    frequent = digests.join(F.broadcast(winners), "_digest")
    rest = digests.join(F.broadcast(winners.select("_digest")), "_digest", "left_anti")
    sizes = rest.groupBy("_digest").agg(F.max("_id").alias("_keep"), F.count("*").alias("_size"))
    return frequent.unionByName(rest.join(sizes, "_digest")).select("_id", "_digest", "_keep", "_size")


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = COUNTERS) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    groups = exact_groups(docs, id_col, text_col, counters)
    stay = groups.filter(F.col("_id").eqNullSafe(F.col("_keep"))).select("_id", "_digest").distinct()
    plain = docs.select(*(docs[c].alias(f"_c{i}") for i, c in enumerate(docs.columns)))
    names = plain.columns
    inner = plain.withColumn("_text", F.col(f"_c{docs.columns.index(text_col)}"))
    schema = ", ".join(f"{n} {f.dataType.simpleString()}" for n, f in zip(names, docs.schema)) + ", _digest binary"
    rows = map_batches(inner, _digested_rows, schema, columns=names)
    own = rows.withColumn("_own", F.col(f"_c{docs.columns.index(id_col)}").cast("bigint"))
    met = own.join(stay.withColumnRenamed("_digest", "_kept"), F.col("_own").eqNullSafe(F.col("_id")) & (F.col("_digest") == F.col("_kept")))
    one = met.dropDuplicates(["_own", "_digest"])  # after the join's shuffle on the same keys
    return one.select(*(F.col(n).alias(c) for n, c in zip(names, docs.columns)))


def op4_exact_heavy(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact_groups(table(spark, sf_dir, "documents"))
    return groups.select(
        F.col("_id").alias("doc_id"), F.col("_keep").alias("keep_id"), F.col("_size").alias("group_size"),
        F.col("_id").eqNullSafe(F.col("_keep")).alias("kept"), F.lower(F.hex("_digest")).alias("text_sha256"),
    )


OP4_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
      FROM documents)
WINDOW same AS (PARTITION BY t)
"""
