"""N-gram Jaccard join by prefixes of token combinations (operator 13).

Tokens are a document's distinct shingles. All tokens have one order, and a document's prefix is its first tokens
in that order. Rare tokens are indexed alone, tokens of a frequent class in combinations of k, and the prefix is
extended until it covers one token more than a similar document may lack:

    coverage = (rare tokens) + sum over classes of max(0, tokens of the class - k + 1)

Of two similar documents, let x be the one whose prefix ends first. If they shared no indexed combination, the
other would lack as many tokens of x's prefix as it covers, one too many. So each pair meets, by construction.

1. One pass over the texts: size and digest of the token set. Equal sets collapse to one representative.
2. Document frequencies of the representatives' tokens. Tokens travel packed: a chunk of documents sends each page
   (a range of hashes) its distinct tokens there and how many documents hold them, so a token that a third of all
   documents share is one entry a chunk. Pages add up and answer with the tokens that several documents have; the
   others never meet anything, so they only count for coverage and are not indexed. Within a page a token is 32 bits
   of its hash; tokens that fall together are one token everywhere, which costs candidates but loses none.
3. Combinations per representative, in order of frequency over all tokens, so that a shared passage is indexed only
   where it makes up most of a text. Frequent tokens are dealt to classes by hash; how many classes depends on the
   size range of the document, so that combinations stay proportional to its size. A document near the upper end
   of its range is also indexed in the next one; two similar documents share a range. In ranges of very short
   documents all tokens are indexed alone.
4. Documents that share a combination are candidates; ``linking`` verifies them on full sets, as many as connect
   each group. No list, class or number of partners is capped.

Null and empty texts, and texts without words, have an empty set and are linked with nothing. Rows that share an
id count as one document. A null id never represents others; alone it has a null component. A text is held in
memory whole, however long; combinations of one document are, too. Other columns are ignored. An empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeworks.llm.common import map_batches, settle, table, utf8
from tapeworks.llm.linking import by_group, linked, shingle_set

RANGE = 2**64  # of hashes; order goes range by range, here in one
CHUNK_TOKENS = 1_000_000  # after which a chunk of documents is closed
PAGE_TOKENS = 2_000_000  # of a page, about
LISTED = 64  # a token of more documents of a chunk has its documents sent past the page
CLASSES = ((64, 2),)  # tokens of more than so many documents are indexed in combinations of so many


def lacking(size: int, percent: int) -> int:
    """How many tokens a similar document may lack, and one more."""
    return size - -(-size * percent // 100) + 1


def size_ranges(size: int, percent: int) -> list[int]:
    """Powers of two below which similar documents meet: the own one, and the next if a larger one may be there."""
    own = size.bit_length() - 1
    return [own, own + 1] if 100 * size >= percent << own + 1 else [own]


def classes_of(size_range: int, percent: int) -> int:
    """Into how many classes frequent tokens are dealt; 0 where documents are so short that combinations might not
    reach the coverage, so that all tokens are indexed alone."""
    many = max(1, min(4 + (1 << size_range) // 32, (1 << size_range) // 8))
    least = -(-(percent << size_range) // 100)
    return many if least - lacking(least, percent) >= many * sum(k - 1 for _, k in CLASSES) else 0


def _sizes(batches: Iterator[dict], words: int) -> Iterator[dict]:
    for batch in batches:
        sets = (shingle_set(raw, words) for raw in utf8(batch["_text"]))
        told = [(len(own), hashlib.blake2b(own.tobytes(), digest_size=16).digest() if len(own) else None) for own in sets]
        yield {"_id": batch["_id"], "_hash": batch["_hash"], "_n": [n for n, _ in told], "_digest": [d for _, d in told]}


def paged(tokens: np.ndarray, pages: int) -> np.ndarray:
    """Tokens as page (upper half) and 32 bits within it, in the same order."""
    width = -(-2**64 // pages)
    if pages == 1:
        return tokens >> np.uint64(32)
    page = tokens // np.uint64(width)
    return page << np.uint64(32) | (tokens - page * np.uint64(width)) >> np.uint64(max(0, width.bit_length() - 32))


def _packed(reps: list[int], sets: list[np.ndarray]) -> Iterator[dict]:
    """A chunk's rows: one for the chunk itself (documents, sizes, documents of the tokens that many hold), and one for
    each page (tokens, how many documents hold each, and which)."""
    held = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets]).astype(np.uint16)
    order = np.argsort(held, kind="stable")
    held, owner = held[order], owner[order]
    tokens, counts = np.unique(held, return_counts=True)
    many = counts > LISTED
    past = np.repeat(many, counts)
    sizes = np.array([len(s) for s in sets], np.int64)
    yield {
        "_to": -1 - abs(reps[0]), "_a": np.array(reps, np.int64), "_b": sizes, "_c": np.where(many, counts, 0)[many].astype(np.uint32),
        "_d": owner[past], "_e": tokens[many],
    }
    kept = np.where(many, 0, counts)
    ends = np.append(0, np.cumsum(kept))
    owner = owner[~past]
    starts = np.flatnonzero(np.append(True, np.diff(tokens >> np.uint64(32)) > 0))
    for low, high in zip(starts, np.append(starts[1:], len(tokens))):
        yield {
            "_to": int(tokens[low] >> np.uint64(32)), "_a": tokens[low:high].astype(np.uint32), "_b": counts[low:high].astype(np.uint32),
            "_c": kept[low:high].astype(np.uint8), "_d": owner[ends[low]:ends[high]], "_e": tokens[:0],
        }


def _sent(batches: Iterator[dict], words: int, pages: int) -> Iterator[dict]:
    def rows(reps, sets):
        for row in _packed(reps, sets):
            yield {"_to": [row.pop("_to")], "_chunk": [reps[0]], **{name: [part.tobytes()] for name, part in row.items()}}

    reps, sets, total = [], [], 0
    for batch in batches:
        for rep, raw in zip(batch["_id"].to_pylist(), utf8(batch["_text"])):
            reps.append(rep)
            sets.append(paged(shingle_set(raw, words), pages))
            total += len(sets[-1])
            if total >= CHUNK_TOKENS or len(reps) == 2**16 - 1:
                yield from rows(reps, sets)
                reps, sets, total = [], [], 0
    if reps:
        yield from rows(reps, sets)


def _answered(batches: Iterator[dict]) -> Iterator[dict]:
    """Of every page the tokens that several documents hold, chunk by chunk, with their document frequencies; the rows
    of the chunks themselves go on as they are."""
    names = ["_chunk", "_a", "_b", "_c", "_d", "_e"]
    for (to,), rows in by_group(batches, names, ["_to"]):
        if to < 0:
            yield {"_to": [to] * len(rows), **dict(zip(names, map(list, zip(*rows))))}
            continue
        tokens = [np.frombuffer(r[1], np.uint32) for r in rows]
        _, place = np.unique(np.concatenate(tokens), return_inverse=True)
        often = np.bincount(place, np.concatenate([np.frombuffer(r[2], np.uint32) for r in rows]))[place].astype(np.uint32)
        at = 0
        for row, own in zip(rows, tokens):
            total = often[at:at + len(own)]
            at += len(own)
            shared = total > 1
            if shared.any():
                kept = np.frombuffer(row[3], np.uint8)
                docs = np.frombuffer(row[4], np.uint16)[np.repeat(shared, kept)]
                parts = (own[shared], total[shared], kept[shared], docs)
                yield {"_to": [to], "_chunk": [row[0]], **{n: [p.tobytes()] for n, p in zip(names[1:], parts)}, "_e": [b""]}


def combinations(size: int, percent: int, held: list[int], shared: list[tuple[int, int]]) -> Iterator[int]:
    """Hashes of the indexed combinations of one document: ``held`` counts its tokens by range of hashes, ``shared``
    has (document frequency, token) of those that others have too."""
    by_range: list[list[tuple[int, int]]] = [[] for _ in held]
    for often, token in shared:
        by_range[(token % 2**64) // RANGE].append((often, token))
    enough = lacking(size, percent)
    for size_range in size_ranges(size, percent):
        many = classes_of(size_range, percent)
        covered, classes = 0, {}
        for total, told in zip(held, by_range):
            covered += total - len(told)
            for often, token in sorted(told):
                if covered >= enough:
                    break
                k = max((k for least, k in CLASSES if often > least), default=1) if many else 1
                if k == 1:
                    covered += 1
                    yield hash((size_range, token))
                    continue
                before = classes.setdefault((k, token % many), [])
                covered += len(before) >= k - 1
                for others in itertools.combinations(before, k - 1):
                    yield hash((size_range, *sorted((token, *others))))
                before.append(token)
            if covered >= enough:
                break


def _shared(rows: list[tuple]) -> tuple[np.ndarray, ...]:
    """Of one chunk: documents and their sizes; then document, frequency and token by document and in the order of tokens."""
    own = next(r for r in rows if r[0] < 0)
    many, counts = np.frombuffer(own[5], np.uint64), np.frombuffer(own[3], np.uint32)
    tokens, often, docs = [], [], []
    told = np.zeros(len(many), np.uint32)
    for to, a, b, c, d, _ in (r for r in rows if r[0] >= 0):
        token = np.frombuffer(a, np.uint32).astype(np.uint64) | np.uint64(to) << np.uint64(32)
        total, kept = np.frombuffer(b, np.uint32), np.frombuffer(c, np.uint8)
        past = kept == 0
        told[np.searchsorted(many, token[past])] = total[past]
        tokens.append(np.repeat(token, kept))
        often.append(np.repeat(total, kept))
        docs.append(np.frombuffer(d, np.uint16))
    tokens.append(np.repeat(many, counts))
    often.append(np.repeat(told, counts))
    docs.append(np.frombuffer(own[4], np.uint16))
    token, total, doc = (np.concatenate(x) for x in (tokens, often, docs))
    order = np.lexsort((token, total, doc))
    return np.frombuffer(own[1], np.int64), np.frombuffer(own[2], np.int64), doc[order], total[order], token[order]


def _index(batches: Iterator[dict], percent: int) -> Iterator[dict]:
    extra = sum(k - 1 for _, k in CLASSES)
    for _, rows in by_group(batches, ["_to", "_a", "_b", "_c", "_d", "_e"], ["_chunk"]):
        keys, reps, sizes = [], [], []
        ids, totals, doc, often, token = _shared(rows)
        starts = np.searchsorted(doc, np.arange(len(ids) + 1))
        for rep, n, low, high in zip(ids.tolist(), totals.tolist(), starts[:-1].tolist(), starts[1:].tolist()):
            alone = n - (high - low)
            if alone >= lacking(n, percent):
                continue  # the prefix ends before any shared token
            wanted = lacking(n, percent) + extra * max(classes_of(r, percent) for r in size_ranges(n, percent))
            high = min(high, low + wanted - alone)
            told = list(zip(often[low:high].tolist(), token[low:high].tolist()))
            own = set(combinations(n, percent, [alone + len(told)], told))
            keys.extend(own)
            reps.extend([rep] * len(own))
            sizes.extend([n] * len(own))
            if len(keys) > 100_000:
                yield {"_key": keys, "_rep": reps, "_n": sizes}
                keys, reps, sizes = [], [], []
        yield {"_key": keys, "_rep": reps, "_n": sizes}


def jaccard_groups(
    docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(_id, _n, _component) per row of ``docs``: size of its token set, smallest id it is linked with."""
    spark = docs.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    texts = docs.select(docs[id_col].cast("bigint").alias("_id"), docs[text_col].alias("_text"))
    named = texts.withColumn("_hash", F.xxhash64("_text"))
    told = settle(map_batches(named, _sizes, "_id bigint, _hash bigint, _n bigint, _digest binary", words=words), "sizes")
    first = F.min(F.when(F.col("_id").isNotNull(), F.struct("_id", "_hash")))
    classes = settle(
        told.filter("_n > 0").groupBy("_digest").agg(first.alias("_first"), F.count("*").alias("_rows"), F.min("_n").alias("_n"))
        .select("_digest", F.col("_first._id").alias("_rep"), F.col("_first._hash").alias("_of"), "_rows", "_n"), "classes",
    )
    pages = max(tasks, -(-(classes.agg(F.sum("_n")).first()[0] or 0) // PAGE_TOKENS))
    reps = classes.filter("_rep IS NOT NULL").select("_rep", "_of")
    single = (
        named.join(reps.hint("merge"), (F.col("_id") == F.col("_rep")) & (F.col("_hash") == F.col("_of")), "left_semi")
        .dropDuplicates(["_id", "_hash"])
    )
    packed = "_to bigint, _chunk bigint, _a binary, _b binary, _c binary, _d binary, _e binary"
    sent = map_batches(single, _sent, packed, words=words, pages=pages).repartition(tasks, "_to").sortWithinPartitions("_to", "_chunk")
    answers = map_batches(sent, _answered, packed).repartition(tasks, "_chunk").sortWithinPartitions("_chunk", "_to")
    index = settle(map_batches(answers, _index, "_key bigint, _rep bigint, _n bigint", percent=percent), "index")
    roots = linked(texts, index, words, percent)
    changed = classes.join(roots, F.col("_rep") == F.col("_node"), "left").select(
        F.col("_digest").alias("_d"), F.coalesce("_root", "_rep").alias("_component"), "_rows", "_rep"
    ).filter("_rows > 1 OR _component != _rep").select("_d", "_component")
    return told.join(changed, F.col("_digest") == F.col("_d"), "left").select(
        "_id", "_n", F.coalesce("_component", "_id").alias("_component")
    )


def op13_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = jaccard_groups(table(spark, sf_dir, "documents"))
    return groups.select(F.col("_id").alias("doc_id"), F.col("_n").alias("n_shingles"), F.col("_component").alias("component_id"))


OP13_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
  ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b USING (g) WHERE a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 80 * (a.n + b.n - c)),
e AS (SELECT x AS a, y AS b FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT doc_id AS id, doc_id AS c FROM documents UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.id),
m AS (SELECT id, min(c) AS component_id FROM r GROUP BY 1)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id FROM documents LEFT JOIN n USING (doc_id) JOIN m ON m.id = doc_id
"""
