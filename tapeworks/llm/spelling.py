"""Spelling variants: words one edit apart, found by a trie over letter-group counts (operator 11).

A word's vector counts its letters by group. One inserted, deleted or replaced code point adds at most one to
one count (surplus) and takes at most one from one count (deficit). A trie arranges the words by their counts,
group after group; a depth-first search with a budget of one surplus and one deficit reaches every leaf that may
hold a near word, and the words of the leaf are verified letter by letter.

1. One pass over the texts counts words per task; only (word, count) rows are shuffled.
2. The top of the trie cuts the words into shards: a node with more than ``most`` words is split by its next
   count. Nodes number a few times (words / most); they are broadcast behind a check of their number.
3. Every word goes to its own shard and, where the budget leads, to shards beside it, by the same walk through
   the top. A task builds the trie of a shard, searches it with the words sent there, in blocks, and returns one
   row per word that found anything: how many, and the best form. Words of one full vector that are still too
   many for a shard are dealt over several; words are then sent to each of them. Nothing is capped.
4. Forms are followed to their ends by pointer doubling; a form is ten times as frequent as its word, so chains
   are short.

Null and empty texts have no words. A null id counts as the empty string in the hash. Repeated rows count
again each time. Words of any length are compared whole. An empty table gives an empty result. Other columns
are ignored. One text and the distinct words of a batch of texts are held in memory whole.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeworks.llm.common import map_batches, settle, table, texts
from tapeworks.operators.chunks import bounded

# The letters of a word, its least length, how many occurrences make a word, one in how many is
# altered, and how much more frequent a form is than its word.
RUN = re.compile("[A-Za-zÀ-ÿ]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SHORTEST, LEAST, ONE_IN, TIMES = 7, 2, 31, 10

GROUPS = ["e", "a", "i", "o", "u", "n", "t", "s", "r", "l", "d", "cm", "phg", "bfvwy", "jkqxz"]  # the last: all others
LEVELS = len(GROUPS) + 1
_GROUP_OF = np.full(256, LEVELS - 1, np.uint8)
for _i, _letters in enumerate(GROUPS):
    for _letter in _letters:
        _GROUP_OF[ord(_letter)] = _i
HIGHEST = 90  # greater counts are as good as this one: differences only shrink
ZERO = 33  # count c is written as chr(ZERO + c)
SHARD_WORDS = 50_000
HELD_WORDS = 200_000  # counted in a task before they are passed on
BLOCK = 8192  # words searched at once
WIDE = 64  # longer words are verified one by one


def altered(run: str, hashed: int) -> str:
    """The run, without one code point if its hash says so."""
    if hashed % ONE_IN:
        return run
    at = hashed % len(run)
    return run[:at] + run[at + 1:]


def _count(batches: Iterator[dict]) -> Iterator[dict]:
    held: Counter[str] = Counter()
    for batch in batches:
        for number, text in zip(batch["_id"].to_pylist(), texts(batch["_text"])):
            start = zlib.crc32(f"{'' if number is None else number}:".encode())
            for run, times in Counter(RUN.findall(text.translate(UPPER) if not text.isascii() else text.lower())).items():
                word = altered(run, zlib.crc32(run.encode(), start))
                if len(word) >= SHORTEST:
                    held[word] += times
        if len(held) > HELD_WORDS:
            yield {"word": list(held), "n": list(held.values())}
            held.clear()
    yield {"word": list(held), "n": list(held.values())}


def vectors_of(words: list[str]) -> np.ndarray:
    """Counts by letter group, a row per word."""
    raw = [w.encode("latin-1", "replace") for w in words]
    sizes = np.fromiter(map(len, raw), np.int64, len(raw))
    group = _GROUP_OF[np.frombuffer(b"".join(raw), np.uint8)]
    cell = np.repeat(np.arange(len(raw)), sizes) * LEVELS + group
    counts = np.bincount(cell, minlength=len(raw) * LEVELS).reshape(len(raw), LEVELS)
    return np.minimum(counts, HIGHEST).astype(np.uint8)


def _describe(batches: Iterator[dict]) -> Iterator[dict]:
    for batch in batches:
        words = batch["word"].to_pylist()
        lines = (vectors_of(words) + np.uint8(ZERO)).tobytes().decode("ascii")
        yield {"word": words, "n": batch["n"], "_vec": [lines[i:i + LEVELS] for i in range(0, len(lines), LEVELS)]}


class Trie:
    """Words arranged by their counts, group after group; ``children[level][node, count + 1]`` or -1."""

    def __init__(self, words: list[str], counts: list[int]):
        vectors = vectors_of(words)
        order = np.lexsort(vectors.T[::-1])
        self.words = [words[i] for i in order]
        self.counts = np.array(counts, np.int64)[order]
        vectors = vectors[order]
        self.children = []
        node = np.zeros(len(order), np.int64)
        for level in range(LEVELS):
            own = vectors[:, level].astype(np.int64)
            new = np.ones(len(order), bool)
            new[1:] = (node[1:] != node[:-1]) | (own[1:] != own[:-1])
            below = np.cumsum(new) - 1
            child = np.full((int(node[-1]) + 1, int(own.max()) + 6), -1, np.int32)
            child[node[new], own[new] + 1] = below[new]
            self.children.append(child)
            node = below
        self.starts = np.flatnonzero(new)
        self.sizes = np.diff(np.append(self.starts, len(order)))
        self.letters, self.lengths = letters_of(self.words)

    def leaves(self, vectors: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(rows of ``vectors``, leaves within the budget), depth first."""
        rows = np.arange(len(vectors))
        stack = [(0, np.zeros(len(rows), np.int64), rows, 0, 0)]
        while stack:
            level, node, row, surplus, deficit = stack.pop()
            if level == LEVELS:
                yield row, node
                continue
            child = self.children[level]
            own = np.minimum(vectors[row, level].astype(np.int64), child.shape[1] - 3) + 1
            for step, more, less in ((0, surplus, deficit), (1, surplus + 1, deficit), (-1, surplus, deficit + 1)):
                if more > 1 or less > 1:
                    continue
                below = child[node, own + step]
                there = below >= 0
                if there.any():
                    stack.append((level + 1, below[there], row[there], more, less))

    def near(self, words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(rows of ``words``, places of their near words in this trie)."""
        letters, lengths = letters_of(words)
        for row, leaf in self.leaves(vectors_of(words)):
            sizes = self.sizes[leaf]
            ends = np.cumsum(sizes)
            for low in range(0, len(row), BLOCK):  # leaves are of any size
                high = min(low + BLOCK, len(row))
                own = np.repeat(row[low:high], sizes[low:high])
                skipped = ends[low] - sizes[low]
                place = np.arange(len(own)) - np.repeat(ends[low:high] - sizes[low:high] - skipped, sizes[low:high]) + np.repeat(self.starts[leaf[low:high]], sizes[low:high])
                for a in range(0, len(own), 64 * BLOCK):
                    yield self._verified(words, letters, lengths, own[a:a + 64 * BLOCK], place[a:a + 64 * BLOCK])

    def _verified(self, words, letters, lengths, row, place):
        close = np.abs(lengths[row] - self.lengths[place]) <= 1
        row, place = row[close], place[close]
        long = (lengths[row] > WIDE) | (self.lengths[place] > WIDE)
        good = np.zeros(len(row), bool)
        for at in np.flatnonzero(long):
            good[at] = one_edit(words[row[at]], self.words[place[at]])
        short = np.flatnonzero(~long)
        good[short] = one_edit_rows(letters[row[short]], lengths[row[short]], self.letters[place[short]], self.lengths[place[short]])
        return row[good], place[good]


def letters_of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Letters as a matrix padded with zeros (words up to ``WIDE``), and lengths."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    joined = b"".join((w.encode("latin-1", "replace") if len(w) <= WIDE else b"").ljust(WIDE, b"\0") for w in words)
    return np.frombuffer(joined, np.uint8).reshape(len(words), WIDE), lengths


def one_edit(a: str, b: str) -> bool:
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[at + (len(a) == len(b)):] == b[at + 1:]


def one_edit_rows(a: np.ndarray, a_length: np.ndarray, b: np.ndarray, b_length: np.ndarray) -> np.ndarray:
    """Row by row, whether the words differ by exactly one edit."""
    if not len(a):
        return np.zeros(0, bool)
    width = int(max(a_length.max(), b_length.max()))
    a, b = a[:, :width], b[:, :width]
    same = a == b
    out = (a_length == b_length) & ((~same).sum(axis=1) == 1)
    passed = np.cumsum(~same, axis=1)[:, :-1] > 0  # from the first difference on
    for longer, x, y in ((a_length < b_length, a, b), (a_length > b_length, b, a)):
        at = np.flatnonzero(longer)
        out[at] = ((x[at, :-1] == y[at, 1:]) | ~passed[at]).all(axis=1) & ((x[at, -1] == 0) | (width == 1))
    return out


def _search(batches: Iterator[dict]) -> Iterator[dict]:
    """Rows come by shard, its own words first; each row is also a search."""
    shard, own, trie, waiting = None, [], None, []

    def found(words):
        total = np.zeros(len(words), np.int64)
        best: dict[int, tuple[int, str]] = {}
        for row, place in trie.near(words):
            total += np.bincount(row, minlength=len(words))
            for r, p in zip(row.tolist(), place.tolist()):
                n = int(trie.counts[p])
                if r not in best or n >= best[r][0]:
                    told = (n, trie.words[p])
                    if r not in best or n > best[r][0] or told[1] < best[r][1]:
                        best[r] = told
        rows = sorted(best)
        return {"word": [words[r] for r in rows], "_near": total[rows].tolist(), "_n": [best[r][0] for r in rows], "_form": [best[r][1] for r in rows]}

    for batch in batches:
        columns = (batch[c].to_pylist() for c in ("_path", "_sub", "_own", "word", "n"))
        for path, sub, mine, word, n in zip(*columns):
            if (path, sub) != shard:
                if waiting and own:
                    trie = trie or Trie(*zip(*own))
                    yield found(waiting)
                shard, own, trie, waiting = (path, sub), [], None, []
            if mine:
                own.append((word, n))
            waiting.append(word)
            if len(waiting) >= BLOCK and not mine and own:
                trie = trie or Trie(*zip(*own))
                yield found(waiting)
                waiting = []
        if trie is None and len(waiting) > 16 * BLOCK and not own:
            waiting = []  # a shard without words of its own: nothing to find
    if waiting and own:
        trie = trie or Trie(*zip(*own))
        yield found(waiting)


def words_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): the altered words of all texts that are long and frequent enough."""
    narrow = docs.select(docs[id_col].cast("bigint").alias("_id"), docs[text_col].alias("_text"))
    counted = map_batches(narrow, _count, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST)


def _top(words: DataFrame, most: int) -> tuple[DataFrame, int]:
    """(_path, _full, _words): the root and all children of full nodes; and how deep full nodes lie."""
    classes = settle(words.groupBy("_vec").agg(F.count("*").alias("_words")), "vectors")
    at = F.explode(F.sequence(F.lit(0), F.lit(LEVELS))).alias("_level")
    nodes = (
        classes.select("_vec", "_words", at).groupBy(F.expr("substring(_vec, 1, _level)").alias("_path"))
        .agg(F.sum("_words").alias("_words"))
        .withColumn("_full", (F.col("_words") > most) & (F.length("_path") < LEVELS))
    )
    full = settle(nodes.filter("_full").select(F.col("_path").alias("_parent")), "full")
    depth = full.agg(F.max(F.length("_parent")) + 1).first()[0] or 0
    under = nodes.filter(F.length("_path").between(1, depth)).withColumn("_parent", F.expr("substring(_path, 1, length(_path) - 1)"))
    return settle(under.join(bounded(full)[0], "_parent", "left_semi").select("_path", "_full", "_words"), "nodes"), depth


def sent(words: DataFrame, most: int = SHARD_WORDS) -> DataFrame:
    """(_path, _sub, _own, word, n): the shards each word is looked up in; ``_own`` where it belongs."""
    nodes, depth = _top(words, most)
    out = words.select("word", "n", "_vec", F.lit("").alias("_path"), F.lit(0).alias("_more"), F.lit(0).alias("_less"), F.lit(True).alias("_full"), F.lit(0).cast("bigint").alias("_words"))
    known = bounded(nodes)[0] if depth else None
    for level in range(depth):
        own = F.ascii(F.substring("_vec", level + 1, 1))

        def to(step, more=0, less=0):
            return F.struct(
                F.concat("_path", F.char(own + step)).alias("_path"), (F.col("_more") + more).alias("_more"), (F.col("_less") + less).alias("_less")
            )

        stay = F.struct("_path", "_more", "_less")
        steps = F.array(
            to(0), F.when(F.col("_more") == 0, to(1, more=1)), F.when((F.col("_less") == 0) & (own > ZERO), to(-1, less=1)),
        )
        out = (
            out.withColumn("_to", F.explode(F.when(F.col("_full"), steps).otherwise(F.array(stay)))).filter("_to IS NOT NULL")
            .select("word", "n", "_vec", "_to.*").join(known, "_path")
        )
    parts = F.when(F.length("_path") == LEVELS, F.ceil(F.col("_words") / most)).otherwise(1).cast("int")
    own = F.pmod(F.xxhash64("word"), parts).cast("int")
    return out.withColumn("_sub", F.explode(F.sequence(F.lit(0), F.greatest(parts, F.lit(1)) - 1))).select(
        "_path", "_sub", ((F.col("_more") == 0) & (F.col("_less") == 0) & (F.col("_sub") == F.coalesce(own, F.lit(0)))).alias("_own"), "word", "n"
    )


def spelling_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = SHARD_WORDS,
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of ``docs``."""
    words = settle(map_batches(words_of(docs, id_col, text_col), _describe, "word string, n bigint, _vec string"), "words")
    spark = docs.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    dealt = sent(words, most).repartition(tasks, "_path", "_sub").sortWithinPartitions("_path", "_sub", F.desc("_own"))
    near = map_batches(dealt, _search, "word string, _near bigint, _n bigint, _form string")
    best = near.groupBy("word").agg(F.sum("_near").alias("n_near"), F.min(F.struct((-F.col("_n")).alias("_less"), "_form")).alias("_best"))
    frequent = -F.col("_best._less") >= TIMES * F.col("n")
    told = settle(
        words.select("word", "n").join(best, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
            F.when(frequent, F.col("_best._form")).alias("form"), F.when(frequent, -F.col("_best._less")).alias("form_n"),
        ), "forms",
    )
    ends = _ends(told.filter("form IS NOT NULL").select("word", "form"))
    return told.join(ends, "word", "left").select("word", "form", F.coalesce("_end", "word").alias("root"), "n", "n_near", "form_n")


def _ends(forms: DataFrame) -> DataFrame:
    """(word, _end): where following forms ends; each round doubles the length of the steps."""
    ends = settle(forms.select("word", F.col("form").alias("_end")), "ends")
    while True:
        onward = ends.select(F.col("word").alias("_from"), F.col("_end").alias("_on"))
        ends = settle(
            ends.join(onward, F.col("_end") == F.col("_from"), "left")
            .select("word", F.coalesce("_on", "_end").alias("_end"), F.col("_on").isNotNull().alias("_moved")), "ends",
        )
        if ends.filter("_moved").isEmpty():
            return ends.select("word", "_end")
        ends = ends.select("word", "_end")


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_groups(table(spark, sf_dir, "documents"))
