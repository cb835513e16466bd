"""Components of similar documents from candidate lists: what operators 2 and 13 share.

``members`` tells which documents stand in which list (a band of a signature, a combination of tokens). Documents
of one list may be similar; links are decided on full sets, here, and only as many are looked for as connect each
group.

1. Of lists with the same documents one is kept. Then every document is compared with one leader of its lists, the
   most central one, so a text is shipped once, in chunks beside the leader's. What links becomes one component,
   and lists within one component are done: a group of near copies ends here, whatever its size.
2. Documents connected by the lists still open are a family; numbers alone are shuffled for that. A family of
   bounded size goes to one task, which tests its pairs at once.
3. While large families hold many documents and leaders find theirs alike, further rounds of leaders follow. In
   the lists open after that, the members outside the list's largest component are compared with the others, in
   blocks of bounded size; two documents only where they first meet, and only across components. Which rows that
   takes is settled on numbers before texts are shipped.

No list, family or number of partners is capped. All tables lie in the shared folder.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tapeworks.llm.common import map_batches, settle
from tapeworks.llm.components import components

GROUP_DOCS = 512  # of a family or block
GROUP_SHINGLES = 2_000_000
ROUNDS = 6  # of leaders, at most
WORTH = 2  # rounds go on while one document in so many finds its leader alike,
MANY = 32  # and large families hold so many times GROUP_DOCS documents
CELLS = 4096  # columns of the comparison matrix held at once
FOLD = np.random.default_rng(7).integers(1, 2**63, 16, dtype=np.uint64) | np.uint64(1)


def mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(raw: bytes, words: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles; A-Z lower-cased, split at ASCII white space."""
    told = raw.lower().split()
    if not told:
        return np.empty(0, np.uint64)
    own = np.fromiter(map(xxhash.xxh3_64_intdigest, told), np.uint64, len(told))
    width = min(words, len(own))
    mixed = np.full(len(own) - width + 1, width, np.uint64)
    for i in range(width):
        mixed += own[i:i + len(mixed)] * FOLD[i]
        mixed = mix64(mixed)
    return np.unique(mixed)


def similar(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Matrix of the pairs with 100 * intersection >= percent * union."""
    sizes = np.array([len(s) for s in sets], np.int64)
    _, place, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    shared = counts[place] > 1  # what one document has alone adds to no intersection
    column = (np.cumsum(counts > 1) - 1)[place[shared]]
    owner = owner[shared]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    both = np.zeros((len(sets), len(sets)), np.float32)
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, CELLS):
        a, b = np.searchsorted(column, [low, low + CELLS])
        cells = np.zeros((len(sets), CELLS), np.float32)
        cells[owner[a:b], column[a:b] - low] = 1
        both += cells @ cells.T
    common = both.astype(np.int64)
    return 100 * common >= percent * (sizes[:, None] + sizes[None, :] - common)


def alike(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """The same for two sets."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= percent * (len(a) + len(b) - common)


def groups_of(linked: np.ndarray) -> np.ndarray:
    """For each row of a symmetric matrix of links, the first row of its component."""
    label = np.arange(len(linked))
    linked = linked | np.eye(len(linked), dtype=bool)
    while True:
        least = np.where(linked, label[None, :], len(linked)).min(axis=1)
        least = least[least]
        if (least == label).all():
            return label
        label = least


def by_group(batches: Iterator[dict], columns: list[str], keys: list[str]) -> Iterator[tuple[tuple, list[tuple]]]:
    """Runs of equal keys in sorted rows, over batch borders."""
    current, rows = None, []
    for batch in batches:
        for k, row in zip(zip(*(batch[c].to_pylist() for c in keys)), zip(*(batch[c].to_pylist() for c in columns))):
            if k != current:
                if rows:
                    yield current, rows
                current, rows = k, []
            rows.append(row)
    if rows:
        yield current, rows


def _set(text: str | None, words: int) -> np.ndarray:
    return shingle_set((text or "").encode(), words)


def _settle_families(batches: Iterator[dict], words: int, percent: int) -> Iterator[dict]:
    for _, rows in by_group(batches, ["_rep", "_text"], ["_family"]):
        ids = np.array([r[0] for r in rows])
        label = groups_of(similar([_set(r[1], words) for r in rows], percent))
        least = np.full(len(ids), np.iinfo(np.int64).max)
        np.minimum.at(least, label, ids)
        yield {"_a": ids, "_b": least[label]}


def _follow_leaders(batches: Iterator[dict], words: int, percent: int) -> Iterator[dict]:
    """Rows come by leader and part, the leader's own first."""
    task, lead = None, None
    for batch in batches:
        a, b = [], []
        columns = (batch[c].to_pylist() for c in ("_leader", "_part", "_rep", "_text"))
        for leader, part, rep, text in zip(*columns):
            if (leader, part) != task:
                task, lead = (leader, part), _set(text, words)
            elif alike(lead, _set(text, words), percent):
                a.append(leader)
                b.append(rep)
        yield {"_a": a, "_b": b}


def _to_compare(rows: list[tuple], key: int, percent: int) -> np.ndarray:
    """Matrix of the pairs of rows (minor, rep, label, keys, n) to be compared in this list and pair of blocks: a member
    outside the largest component and one of the other block, that did not meet in an earlier list."""
    minor, _, labels, _, sizes = (np.array(x) for x in zip(*((m, i, x, 0, n) for m, i, x, _, n in rows)))
    minor = minor.astype(bool)
    new = (labels[:, None] != labels[None, :]) & (minor[:, None] != minor[None, :])
    new &= 100 * np.minimum(sizes[:, None], sizes[None, :]) >= percent * np.maximum(sizes[:, None], sizes[None, :])
    earlier = defaultdict(list)
    for row, (_, _, _, keys, _) in enumerate(rows):
        for k in keys:
            if k < key:
                earlier[k].append(row)
    for met in earlier.values():
        if len(met) > 1:
            new[np.ix_(met, met)] = False
    return new


def _needed(batches: Iterator[dict], percent: int) -> Iterator[dict]:
    """The rows that have anything to be compared with."""
    names = ["_minor", "_rep", "_label", "_keys", "_n"]
    for (key, low, high), rows in by_group(batches, names, ["_key", "_low", "_high"]):
        kept = [row for row, any_ in zip(rows, _to_compare(rows, key, percent).any(axis=1)) if any_]
        if kept:
            yield {"_key": [key] * len(kept), "_low": [low] * len(kept), "_high": [high] * len(kept), **dict(zip(names, map(list, zip(*kept))))}


def _link_blocks(batches: Iterator[dict], words: int, percent: int) -> Iterator[dict]:
    for (key, *_), rows in by_group(batches, ["_minor", "_rep", "_label", "_keys", "_n", "_text"], ["_key", "_low", "_high"]):
        new = _to_compare([r[:5] for r in rows], key, percent)
        ids = np.array([r[1] for r in rows])
        label = groups_of(similar([_set(r[5], words) for r in rows], percent) & new)
        own = label != np.arange(len(ids))
        yield {"_a": ids[own], "_b": ids[label[own]]}


def _relabelled(members: DataFrame, links: DataFrame, pairs: DataFrame) -> DataFrame:
    """Members of the lists that still hold two components or more, under their components' names."""
    roots = components(links).toDF("_linked", "_root")
    led = pairs.groupBy("_leader").agg(F.lit(1).alias("_led"))
    named = (
        members.join(roots, F.col("_rep") == F.col("_linked"), "left").join(led, F.col("_rep") == F.col("_leader"), "left")
        .select("_key", "_rep", "_n", "_weight", (F.col("_used") + F.coalesce("_led", F.lit(0))).alias("_used"), F.coalesce("_root", "_rep").alias("_label"))
    )
    open_lists = named.groupBy("_key").agg(F.min("_label").alias("_x"), F.max("_label").alias("_y")).filter("_x != _y").select(F.col("_key").alias("_open"))
    return settle(named.join(open_lists, F.col("_key") == F.col("_open"), "left_semi"), "members")


def _round(members: DataFrame, own: DataFrame, words: int, percent: int, tasks: int) -> tuple[DataFrame, DataFrame]:
    """Links of documents with the best leader of their lists, and who was compared with whom."""
    rank = F.struct("_used", (-F.col("_weight")).alias("_rank"), F.xxhash64("_rep").alias("_hash"), F.col("_rep").alias("_of"), F.col("_n").alias("_m"), F.col("_label").alias("_in"))
    leads = members.groupBy("_key").agg(F.min(rank).alias("_lead")).select(F.col("_key").alias("_list"), "_lead")
    fits = 100 * F.least("_n", "_lead._m") >= percent * F.greatest("_n", "_lead._m")
    pairs = (
        members.join(leads, F.col("_key") == F.col("_list")).filter((F.col("_label") != F.col("_lead._in")) & fits)
        .groupBy("_rep").agg(F.min("_lead")["_of"].alias("_leader"))
    )
    pairs = settle(pairs, "pairs")
    parts = pairs.groupBy("_leader").agg(F.ceil(F.count("*") / GROUP_DOCS).cast("int").alias("_parts"))
    text = own.select(F.col("_rep").alias("_own"), "_text")
    follow = (
        pairs.join(parts.withColumnRenamed("_leader", "_l"), F.col("_leader") == F.col("_l"))
        .withColumn("_part", F.pmod(F.xxhash64("_rep"), F.col("_parts")).cast("int")).select("_leader", "_part", "_rep", F.lit(1).alias("_after"))
    )
    lead = parts.select("_leader", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)).alias("_part"), F.col("_leader").alias("_rep"), F.lit(0).alias("_after"))
    sent = lead.unionByName(follow).join(text, F.col("_rep") == F.col("_own")).select("_leader", "_part", "_after", "_rep", "_text")
    dealt = sent.repartition(tasks, "_leader", "_part").sortWithinPartitions("_leader", "_part", "_after")
    return settle(map_batches(dealt, _follow_leaders, "_a bigint, _b bigint", words=words, percent=percent), "links"), pairs


def _blocks(members: DataFrame, own: DataFrame, words: int, percent: int, tasks: int) -> DataFrame:
    """Links in open lists: members outside the largest component of the list with all others."""
    held = members.groupBy("_key", "_label").agg(F.count("*").alias("_docs"), F.sum("_n").alias("_shingles"))
    totals = held.groupBy("_key").agg(
        F.max(F.struct("_docs", "_label"))["_label"].alias("_main"), F.sum("_docs").alias("_all"), F.max("_docs").alias("_most"), F.sum("_shingles").alias("_sum"),
    ).select(
        F.col("_key").alias("_list"), "_main",
        F.greatest(F.ceil(F.col("_all") / GROUP_DOCS), F.ceil(F.col("_sum") / GROUP_SHINGLES)).cast("int").alias("_wide"),
        F.greatest(F.ceil((F.col("_all") - F.col("_most")) / GROUP_DOCS), F.ceil(F.col("_sum") / GROUP_SHINGLES * (1 - F.col("_most") / F.col("_all"))), F.lit(1)).cast("int").alias("_narrow"),
    )
    placed = members.join(totals, F.col("_key") == F.col("_list"))

    def block(parts):
        return F.pmod(F.xxhash64("_rep"), F.col(parts)).cast("int")

    minor = placed.filter("_label != _main").select(
        "_key", "_rep", "_label", "_n", F.lit(True).alias("_minor"), block("_narrow").alias("_low"), F.explode(F.sequence(F.lit(0), F.col("_wide") - 1)).alias("_high")
    )
    all_of = placed.select(
        "_key", "_rep", "_label", "_n", F.lit(False).alias("_minor"), F.explode(F.sequence(F.lit(0), F.col("_narrow") - 1)).alias("_low"), block("_wide").alias("_high")
    )
    lists = members.groupBy("_rep").agg(F.sort_array(F.collect_list("_key")).alias("_keys"))  # a document's own lists
    rows = minor.unionByName(all_of).join(lists.withColumnRenamed("_rep", "_r"), F.col("_rep") == F.col("_r")).drop("_r")
    dealt = rows.repartition(tasks, "_key", "_low", "_high").sortWithinPartitions("_key", "_low", "_high")
    schema = "_key bigint, _low int, _high int, _minor boolean, _rep bigint, _label bigint, _keys array<bigint>, _n bigint"
    needed = settle(map_batches(dealt, _needed, schema, percent=percent), "needed")
    sent = needed.join(own.select(F.col("_rep").alias("_own"), "_text"), F.col("_rep") == F.col("_own")).drop("_own")
    dealt = sent.repartition(tasks, "_key", "_low", "_high").sortWithinPartitions("_key", "_low", "_high")
    return map_batches(dealt, _link_blocks, "_a bigint, _b bigint", words=words, percent=percent)


def _families(members: DataFrame) -> DataFrame:
    """(_rep, _n, _family, _small) of documents connected by lists."""
    hubs = members.groupBy("_key").agg(F.min("_rep").alias("_hub")).select(F.col("_key").alias("_list"), "_hub")
    edges = members.join(hubs, F.col("_key") == F.col("_list")).filter("_rep != _hub").select(F.col("_rep").alias("_a"), F.col("_hub").alias("_b")).distinct()
    roots = components(edges).select(F.col("_node").alias("_rep"), F.col("_root").alias("_family"))
    placed = roots.join(members.select("_rep", "_n").distinct(), "_rep")
    sizes = placed.groupBy("_family").agg(F.count("*").alias("_docs"), F.sum("_n").alias("_shingles"))
    small = (F.col("_docs") <= GROUP_DOCS) & (F.col("_shingles") <= GROUP_SHINGLES)
    return settle(placed.join(sizes.select(F.col("_family").alias("_f"), small.alias("_small")), F.col("_family") == F.col("_f")).drop("_f"), "families")


def _different(members: DataFrame) -> DataFrame:
    """One of all lists with the same documents, told by two 64-bit hashes and their number; none of one document.

    Near copies share dozens of lists, and one is enough for them to meet.
    """
    lists = members.groupBy("_key").agg(
        F.count("*").alias("_docs"), F.bit_xor(F.xxhash64("_rep")).alias("_x"), F.bit_xor(F.xxhash64(F.lit(1), "_rep")).alias("_y")
    ).filter("_docs > 1")
    kept = lists.groupBy("_docs", "_x", "_y").agg(F.min("_key").alias("_list"))
    met = members.join(kept.select("_list", "_docs"), F.col("_key") == F.col("_list"))
    weight = F.sum("_docs").over(W.partitionBy("_rep"))  # central documents of a family are in its longest lists
    return settle(met.select("_key", "_rep", "_n", F.col("_rep").alias("_label"), weight.alias("_weight"), F.lit(0).alias("_used")), "members")


def linked(texts: DataFrame, members: DataFrame, words: int, percent: int) -> DataFrame:
    """(_node, _root): components of similar documents, from texts(_id, _text) and members(_key, _rep, _n).

    A document is in a list once. Documents without a similar one may be missing.
    """
    spark = texts.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    rest = _different(members)
    reps = rest.select(F.col("_rep").alias("_r")).distinct()
    own = settle(texts.join(reps.hint("shuffle_hash"), texts["_id"] == reps["_r"]).select(F.col("_r").alias("_rep"), "_text"), "candidates")
    links, placed = [], None
    for _ in range(ROUNDS):
        new, pairs = _round(rest, own, words, percent, tasks)
        links.append(new)
        rest = _relabelled(rest, _union(links), pairs)
        if rest.isEmpty():
            return components(_union(links))
        placed = _families(rest)
        if placed.filter("NOT _small").count() < MANY * GROUP_DOCS or new.count() * WORTH < pairs.count():
            break
    placed = placed.select(F.col("_rep").alias("_p"), "_family", "_small")
    links.append(_whole(own.join(placed.filter("_small"), F.col("_rep") == F.col("_p")), words, percent, tasks))
    if not placed.filter("NOT _small").isEmpty():
        wide = rest.join(placed.filter("NOT _small"), F.col("_rep") == F.col("_p"), "left_semi")
        links.append(_blocks(wide, own, words, percent, tasks))
    return components(settle(_union(links), "links"))


def _union(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for more in tables[1:]:
        out = out.unionByName(more)
    return out


def _whole(own: DataFrame, words: int, percent: int, tasks: int) -> DataFrame:
    whole = own.select("_family", "_rep", "_text").repartition(tasks, "_family").sortWithinPartitions("_family")
    return map_batches(whole, _settle_families, "_a bigint, _b bigint", words=words, percent=percent).filter("_a != _b")
