"""Mixing sources to target weights by hierarchical budgets (operator 9), in DataFrame functions throughout.

The levels (domain, language, source) form a tree. Weights are whole numbers per node, 1 where none is given,
0 for nothing. The budget goes down the tree by weight; a node can take at most its tokens times
``max_epochs``, and what it can't take its siblings share by weight. As a parent never gets more than its
children can take together, a shortage leaves the parent only when all of them are full. Shares are exact:
the children's tokens add up to the parent's.

A leaf with budget T and A tokens takes all its documents T div A times; the rest of T is a prefix of the
leaf's documents in the seeded order of the next epoch, its last document cut to fit.

One source may hold any share of the rows: the prefix is found on totals of hash buckets, and documents are
only ordered within a bucket. Only (id, levels, tokens) rows are shuffled.

Null levels form nodes of their own; null texts have no tokens and are never part of a prefix. Rows that
repeat an id are told apart by their tokens only. Other columns are ignored. An empty table gives an empty
result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tapeworks.llm.common import settle, table

WORDS = r"[^\x20\x09-\x0D]+"
BUCKET_DIGITS = 3
SEPARATOR = "/"
# Production weights of the registered query; nodes that aren't listed have weight 1.
DOMAINS = ("web", "books", "reference", "forum")
WEIGHTS = {
    ("web",): 4, ("books",): 3, ("reference",): 2, ("forum",): 1, ("web", "en"): 3, ("books", "en"): 2,
    ("web", "en", "src0"): 2, ("forum", "de"): 0,
}
SHARE = 700  # of 1000 tokens
EPOCHS = 2
SEED = 17


def _same(left: list[str], right: list[str]) -> Column:
    return reduce(lambda a, b: a & b, (F.col(x).eqNullSafe(F.col(y)) for x, y in zip(left, right)), F.lit(True))


def _path(levels: list[str]) -> Column:
    return F.concat_ws(SEPARATOR, *(F.coalesce(F.col(c), F.lit("")) for c in levels))


def _weight(levels: list[str], weights: dict[tuple, int]) -> Column:
    given = {SEPARATOR.join(k): v for k, v in weights.items() if len(k) == len(levels)}
    if not given:
        return F.lit(1).cast("bigint")
    known = F.create_map(*(F.lit(x) for pair in given.items() for x in pair))
    return F.coalesce(F.element_at(known, _path(levels)), F.lit(1)).cast("bigint")


def pour(children: DataFrame, parents: list[str], own: str) -> DataFrame:
    """Share ``given`` of each parent among its children (weight, most) as far as each can take.

    In the order of most / weight, the children that get full come first; the others share what is left.
    Remainders of the division go to the first of them, a token each.
    """
    order = W.partitionBy(*parents).orderBy(F.col("most") / F.col("weight"), F.asc_nulls_first(own))
    before, onward = order.rowsBetween(W.unboundedPreceding, -1), order.rowsBetween(0, W.unboundedFollowing)
    wide = "decimal(38,0)"
    ranked = (
        children.filter("weight > 0")
        .withColumn("_left", F.col("given") - F.coalesce(F.sum("most").over(before), F.lit(0)))
        .withColumn("_weights", F.sum("weight").over(onward))
        .withColumn("_full", F.col("weight").cast(wide) * F.col("_left").cast(wide) >= F.col("most").cast(wide) * F.col("_weights").cast(wide))
        .withColumn("_full", F.min("_full").over(order.rowsBetween(W.unboundedPreceding, 0)))
    )
    every = W.partitionBy(*parents)
    rest = ranked.withColumn("_sum", F.sum(F.when(~F.col("_full"), F.col("weight"))).over(every)).withColumn(
        "_pool", F.col("given") - F.coalesce(F.sum(F.when(F.col("_full"), F.col("most"))).over(every), F.lit(0))
    )
    shared = rest.withColumn("_share", F.when(F.col("_full"), F.col("most")).otherwise(
        F.expr(f"CAST(_pool AS {wide}) * CAST(weight AS {wide}) div CAST(_sum AS {wide})")
    ))
    spare = F.col("_pool") - F.sum(F.when(~F.col("_full"), F.col("_share"))).over(every)
    turn = F.sum(F.when(F.col("_full"), 0).otherwise(1)).over(order.rowsBetween(W.unboundedPreceding, 0))
    return shared.withColumn("share", F.col("_share") + F.when(~F.col("_full") & (turn <= spare), 1).otherwise(0)).select(
        *parents, own, "most", "share"
    )


def budgets(leaves: DataFrame, levels: list[str], weights: dict[tuple, int], share: int, epochs: int) -> DataFrame:
    """Leaf table (levels, held) -> with ``share``, the tokens each leaf gives; leaves of weight 0 are left out."""
    nodes = {}
    below = leaves.withColumn("most", F.col("held") * epochs)
    for depth in range(len(levels), 0, -1):
        own = levels[:depth]
        below = below.withColumn("weight", _weight(own, weights))
        below = below.withColumn("most", F.when(F.col("weight") > 0, F.col("most")).otherwise(0))
        nodes[depth] = below.select(*own, "most", "weight", "held")
        below = below.groupBy(*own[:-1]).agg(F.sum("most").alias("most"), F.sum("held").alias("held"))
    every = W.partitionBy()  # over the nodes of the top level
    wanted = F.expr(f"_held * {share} div 1000")
    top = nodes[1].withColumn("_held", F.sum("held").over(every)).withColumn("_most", F.sum("most").over(every))
    out = pour(top.withColumn("given", F.least("_most", wanted)).select(levels[0], "most", "weight", "given"), [], levels[0])
    for depth in range(2, len(levels) + 1):
        over, own = levels[:depth - 1], levels[depth - 1]
        up = out.select(*(F.col(c).alias(f"_up_{c}") for c in over), F.col("share").alias("given"))
        children = nodes[depth].join(up, _same(over, [f"_up_{c}" for c in over]))
        out = pour(children.select(*over, own, "most", "weight", "given"), over, own)
    return out.select(*levels, "share")


def mix(
    docs: DataFrame, levels: dict[str, Column], weights: dict[tuple, int], share: int, epochs: int = 1, seed: int = SEED,
    tokens: Column | None = None, id_col: str = "doc_id", digits: int = BUCKET_DIGITS,
) -> DataFrame:
    """(_id, levels, n_tokens, copies, part_tokens, leaf_tokens) per row of ``docs``.

    ``share`` of 1000 tokens of the corpus is the budget. ``copies`` tells how often the whole document is
    taken, ``part_tokens`` how many of its tokens the last, incomplete epoch takes.
    """
    names = list(levels)
    own = F.regexp_count(F.coalesce(docs["text"], F.lit("")), F.lit(WORDS)) if tokens is None else tokens
    rows = settle(docs.select(
        docs[id_col].cast("bigint").alias("_id"), *(c.cast("string").alias(n) for n, c in levels.items()), own.cast("bigint").alias("n_tokens")
    ), "mixing-rows")
    held = settle(rows.groupBy(*names).agg(F.sum("n_tokens").alias("held")), "mixing-leaves")
    told = budgets(held, names, weights, share, epochs)
    leaf = held.join(
        told.select(*(F.col(c).alias(f"_t_{c}") for c in names), "share"), _same(names, [f"_t_{c}" for c in names]), "left"
    ).select(
        *(F.col(c).alias(f"_l_{c}") for c in names), F.coalesce("share", F.lit(0)).alias("leaf_tokens"),
        F.when(F.col("held") > 0, F.expr("coalesce(share, 0) div held")).otherwise(0).alias("copies"),
        F.when(F.col("held") > 0, F.expr("coalesce(share, 0) % held")).otherwise(0).alias("_rest"),
    )
    leaf = settle(leaf, "mixing-budgets")
    text = F.concat_ws(":", F.lit(str(seed)), F.col("copies").cast("string"), F.coalesce(F.col("_id").cast("string"), F.lit("null")))
    placed = rows.join(leaf, _same(names, [f"_l_{c}" for c in names])).drop(*(f"_l_{c}" for c in names)).withColumn(
        "_place", F.md5(text)
    ).withColumn("_bucket", F.substring("_place", 1, digits))
    keys = [*names, "_bucket"]
    totals = placed.filter("_rest > 0").groupBy(*keys).agg(F.sum("n_tokens").alias("_sum"))
    earlier = W.partitionBy(*names).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    start = totals.withColumn("_start", F.coalesce(F.sum("_sum").over(earlier), F.lit(0))).select(
        *(F.col(c).alias(f"_b_{c}") for c in keys), "_start"
    )
    met = placed.join(start, _same(keys, [f"_b_{c}" for c in keys]), "left").drop(*(f"_b_{c}" for c in keys))
    within = W.partitionBy(*keys).orderBy("_place", "_id", "n_tokens").rowsBetween(W.unboundedPreceding, -1)
    at = F.coalesce("_start", F.lit(0)) + F.coalesce(F.sum("n_tokens").over(within), F.lit(0))
    part = F.greatest(F.lit(0), F.least(F.col("n_tokens"), F.col("_rest") - at))
    return met.withColumn("part_tokens", part).select("_id", *names, "n_tokens", "copies", "part_tokens", "leaf_tokens")


def tree(docs: DataFrame) -> dict[str, Column]:
    """Domain, language and source of the given documents; the domain follows from the source's number."""
    number = F.regexp_extract(F.coalesce(docs["source"], F.lit("")), r"([0-9]+)$", 1)
    known = F.element_at(F.array(*map(F.lit, DOMAINS)), (number.cast("int") % len(DOMAINS) + 1))
    return {"domain": F.when(number != "", known).otherwise("other"), "lang": docs["lang"], "source": docs["source"]}


def keep_mixed(docs: DataFrame, weights: dict[tuple, int], share: int, seed: int = SEED) -> DataFrame:
    """The rows of ``docs`` that one epoch takes at least a part of, whole and with all their columns."""
    chosen = mix(docs, tree(docs), weights, share, 1, seed).filter("copies > 0 OR part_tokens > 0").select("_id").distinct()
    return docs.join(chosen.hint("shuffle_hash"), docs["doc_id"].cast("bigint").eqNullSafe(chosen["_id"]), "left_semi")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mix(docs, tree(docs), WEIGHTS, SHARE, EPOCHS).withColumnRenamed("_id", "doc_id")


def _sql() -> str:
    names = ["domain", "lang", "source"]

    def weight(depth: int) -> str:
        whens = "".join(
            f" WHEN concat_ws('/', {', '.join(f'coalesce({c}, chr(0))' for c in names[:depth])}) = '{'/'.join(k)}' THEN {v}"
            for k, v in WEIGHTS.items() if len(k) == depth
        )
        return f"CASE{whens} ELSE 1 END"

    def step(depth: int) -> str:
        own, up = ", ".join(names[:depth]), names[:depth - 1]
        by = f"PARTITION BY {', '.join(up)} " if up else ""
        on = " AND ".join(f"n.{c} IS NOT DISTINCT FROM u.{c}" for c in up) or "true"
        tail = f"{by}ORDER BY most / weight, {names[depth - 1]} NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND"
        return f"""
c{depth} AS (SELECT {', '.join(f'n.{c}' for c in names[:depth])}, n.most, n.weight, u.share AS given
  FROM n{depth} n JOIN s{depth - 1} u ON {on} WHERE n.weight > 0),
r{depth} AS (SELECT *, given - coalesce(sum(most) OVER ({tail} 1 PRECEDING), 0) AS l,
  sum(weight) OVER ({by}ORDER BY most / weight, {names[depth - 1]} NULLS FIRST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS w
  FROM c{depth}),
f{depth} AS (SELECT *, min((weight::HUGEINT * l >= most::HUGEINT * w)::INT) OVER ({tail} CURRENT ROW) = 1 AS f FROM r{depth}),
p{depth} AS (SELECT *, given - coalesce(sum(most) FILTER (f) OVER ({by}), 0) AS pool, sum(weight) FILTER (NOT f) OVER ({by}) AS ws FROM f{depth}),
q{depth} AS (SELECT *, CASE WHEN f THEN most ELSE pool::HUGEINT * weight // ws END AS sh FROM p{depth}),
s{depth} AS (SELECT {own}, (sh + CASE WHEN NOT f AND sum((NOT f)::INT) OVER ({tail} CURRENT ROW)
  <= pool - sum(sh) FILTER (NOT f) OVER ({by}) THEN 1 ELSE 0 END)::BIGINT AS share FROM q{depth}),"""

    domains = ", ".join(f"'{d}'" for d in DOMAINS)
    return f"""
WITH d AS (SELECT doc_id, CASE WHEN regexp_matches(coalesce(source, ''), '[0-9]+$')
    THEN [{domains}][regexp_extract(source, '([0-9]+)$', 1)::INT % {len(DOMAINS)} + 1] ELSE 'other' END AS domain,
  lang, source, len(regexp_extract_all(coalesce(text, ''), '{WORDS}')) AS n_tokens FROM documents),
leaf AS (SELECT domain, lang, source, sum(n_tokens)::BIGINT AS held FROM d GROUP BY ALL),
n3 AS (SELECT *, CASE WHEN weight > 0 THEN held * {EPOCHS} ELSE 0 END AS most FROM (SELECT *, {weight(3)} AS weight FROM leaf)),
n2 AS (SELECT domain, lang, weight, CASE WHEN weight > 0 THEN m ELSE 0 END::BIGINT AS most FROM
  (SELECT domain, lang, {weight(2)} AS weight, sum(most) AS m FROM n3 GROUP BY domain, lang)),
n1 AS (SELECT domain, weight, CASE WHEN weight > 0 THEN m ELSE 0 END::BIGINT AS most FROM
  (SELECT domain, {weight(1)} AS weight, sum(most) AS m FROM n2 GROUP BY domain)),
s0 AS (SELECT least((SELECT sum(most) FROM n1), (SELECT sum(held) FROM leaf)::BIGINT * {SHARE} // 1000) AS share),{step(1)}{step(2)}{step(3)}
b AS (SELECT leaf.*, coalesce(share, 0) AS leaf_tokens, CASE WHEN held > 0 THEN coalesce(share, 0) // held ELSE 0 END AS copies,
  CASE WHEN held > 0 THEN coalesce(share, 0) % held ELSE 0 END AS rest FROM leaf LEFT JOIN s3 ON leaf.domain IS NOT DISTINCT FROM s3.domain
  AND leaf.lang IS NOT DISTINCT FROM s3.lang AND leaf.source IS NOT DISTINCT FROM s3.source),
o AS (SELECT d.*, copies, rest, leaf_tokens, coalesce(sum(n_tokens) OVER (PARTITION BY d.domain, d.lang, d.source
  ORDER BY md5('{SEED}:' || copies || ':' || doc_id), doc_id, n_tokens ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos
  FROM d JOIN b ON d.domain IS NOT DISTINCT FROM b.domain AND d.lang IS NOT DISTINCT FROM b.lang AND d.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, domain, lang, source, n_tokens, copies, greatest(0, least(n_tokens, rest - pos))::BIGINT AS part_tokens, leaf_tokens FROM o
"""


OP9_SQL = _sql()
