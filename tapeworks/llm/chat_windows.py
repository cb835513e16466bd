"""Chat formatting in budgeted windows (operator 3), in DataFrame functions throughout.

Each turn becomes ``<|start|>role<|text|>text<|end|>``. Within roles and texts ``~``, ``<`` and ``[`` are written
as ``~0``, ``~1`` and ``~2``, so that no control string, of this template or of other common ones, can occur in
them, and the text can be told back exactly.

A conversation is cut into windows of whole turns. Prefix sums of turn tokens (words and a fixed cost) choose
the cuts: a turn belongs to the span that its prefix sum falls in, spans being half of what the budget leaves
after the system turn and the history; longer turns stand alone. So a window keeps to the budget unless a
single turn is larger. Each window opens with the system turn and with the turns that start within
``history`` tokens before it. Loss spans (start and length in code points) cover the texts of the window's
own assistant turns; repeated turns are masked.

Turns are ordered by turn (null first), then by role and text, so repeated rows follow each other and count
as turns. Null roles and texts are empty; a null conversation id is a conversation of its own. The system
turn is a conversation's first row if its role is ``system``; later system rows are ordinary turns. Other
columns are ignored. An empty table gives an empty result. One shuffle, by conversation: the turns of one
conversation meet in one task, which its digest over all turns needs anyhow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tapeworks.llm.common import table

START, TEXT, END = "<|start|>", "<|text|>", "<|end|>"
ESCAPES = (("~", "~0"), ("<", "~1"), ("[", "~2"))
WORDS = r"[^\x20\x09-\x0D]+"
TURN_TOKENS = 4
BUDGET = 256
HISTORY = 64
CONTROL = "</s>[INST] ok [/INST]"


def escaped(text: Column) -> Column:
    for plain, code in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def told(text: Column) -> Column:
    """The text behind an escaped one."""
    for plain, code in reversed(ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def windows(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """turns(conv_id, turn, role, text) -> (conv_id, window, formatted, n_repeated, loss)."""
    order = W.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    before, upto = order.rowsBetween(W.unboundedPreceding, -1), order.rowsBetween(W.unboundedPreceding, 0)
    zero = F.lit(0)
    rows = turns.select(
        turns["conv_id"], turns["turn"], F.coalesce(turns["role"], F.lit("")).alias("role"), F.coalesce(turns["text"], F.lit("")).alias("text")
    )
    said = rows.select(
        "conv_id", "role", F.row_number().over(order).alias("at"),
        F.concat(F.lit(START), escaped(F.col("role")), F.lit(TEXT)).alias("lead"), escaped(F.col("text")).alias("body"),
        (F.regexp_count("text", F.lit(WORDS)) + TURN_TOKENS).cast("bigint").alias("tokens"), "turn", "text",
    )
    first = (F.col("at") == 1) & (F.col("role") == "system")
    sized = (
        said.withColumn("head", first).withColumn("shown", F.concat("lead", "body", F.lit(END)))
        .withColumn("cost", F.when(F.col("head"), zero).otherwise(F.col("tokens")))
        .withColumn("size", F.when(F.col("head"), zero).otherwise(F.length("shown")))
        .withColumn("p", F.coalesce(F.sum("cost").over(before), zero))
        .withColumn("chars", F.coalesce(F.sum("size").over(before), zero))
        .withColumn("system", F.max(F.when(F.col("head"), F.col("tokens"))).over(upto))
        .withColumn("half", F.greatest(F.floor((F.lit(budget - history) - F.coalesce("system", zero)) / 2), F.lit(1)))
        .withColumn("long", (F.col("cost") > F.col("half")).cast("bigint"))
        .withColumn("part", 2 * F.coalesce(F.sum("long").over(before), zero) + F.col("long"))
        .withColumn("part", F.when(F.col("head"), F.coalesce(F.lead("long").over(order), zero)).otherwise(F.col("part")))
        .withColumn("key", F.struct("part", F.expr("p div half").alias("k")))
        .withColumn("opens", (F.lag("key").over(order).isNull() | (F.lag("key").over(order) != F.col("key"))).cast("int"))
        .withColumn("window", F.sum("opens").over(upto))
    )
    recent = W.partitionBy("conv_id").orderBy("p").rangeBetween(-history, -1)
    held = sized.withColumn("recent", F.collect_list(F.when(~F.col("head"), F.col("shown"))).over(recent))
    held = held.withColumn("opening", F.max(F.when(F.col("head"), F.col("shown"))).over(upto))
    turn = F.struct("at", "shown", "chars", F.length("lead").alias("skip"), F.length("body").alias("length"), (F.col("role") == "assistant").alias("target"))
    grouped = held.groupBy("conv_id", "window").agg(
        F.array_sort(F.collect_list(F.when(~F.col("head"), turn))).alias("own"),
        F.min_by("recent", F.when(~F.col("head"), F.col("at"))).alias("recent"), F.max("opening").alias("opening"),
    )
    opening, recent_list = F.coalesce("opening", F.lit("")), F.coalesce("recent", F.array().cast("array<string>"))
    start = F.length(opening) + F.length(F.array_join(recent_list, ""))
    loss = F.transform(
        F.filter("own", lambda t: t["target"]),
        lambda t: F.struct((start + t["chars"] - F.get("own", F.lit(0))["chars"] + t["skip"]).cast("int").alias("start"), t["length"].alias("length")),
    )
    return grouped.select(
        "conv_id", "window",
        F.concat(opening, F.array_join(recent_list, ""), F.array_join(F.transform("own", lambda t: t["shown"]), "")).alias("formatted"),
        (F.when(F.col("opening").isNotNull() & (F.col("window") > 1), 1).otherwise(0) + F.size(recent_list)).alias("n_repeated"),
        loss.alias("loss"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Windows -> (conv_id, turns, loss, formatted_chars): the turns in order, each once, and the unmasked text."""
    pieces = F.split("formatted", r"<\|start\|>", -1)
    own = F.slice(pieces, F.col("n_repeated") + 2, F.size(pieces))
    turns = F.transform(own, lambda p: F.struct(
        told(F.substring_index(p, TEXT, 1)).alias("role"),
        told(F.substring_index(F.substring_index(p, END, 1), TEXT, -1)).alias("text"),
    ))
    unmasked = F.transform("loss", lambda s: told(F.substring(F.col("formatted"), s["start"] + 1, s["length"])))
    each = formatted.select(
        "conv_id", F.struct("window", turns.alias("turns"), unmasked.alias("unmasked"), F.length("formatted").cast("bigint").alias("chars")).alias("w")
    )
    whole = each.groupBy("conv_id").agg(F.array_sort(F.collect_list("w")).alias("w"))
    return whole.select(
        "conv_id", F.flatten(F.transform("w", lambda w: w["turns"])).alias("turns"),
        F.array_join(F.flatten(F.transform("w", lambda w: w["unmasked"])), "").alias("loss"),
        F.aggregate("w", F.lit(0).cast("bigint"), lambda n, w: n + w["chars"]).alias("formatted_chars"),
    )


def op3_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(0, 2, 1, 1).select(
        F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROL).alias("text"),
    )
    back = read_back(windows(given.unionByName(extra)))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"), F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"), "formatted_chars",
    )


def _sql() -> str:
    code = "x"
    for plain, short in ESCAPES:
        code = f"replace({code}, '{plain}', '{short}')"
    esc = lambda c: code.replace("x,", f"{c},")
    fixed = len(START) + len(TEXT) + len(END)
    by, until = "PARTITION BY conv_id ORDER BY nth", "ROWS BETWEEN UNBOUNDED PRECEDING AND"
    return f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{CONTROL}' UNION ALL SELECT -1, 1, 'assistant', '{CONTROL}'),
a AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS nth,
  length({esc('role')}) + length({esc('text')}) + {fixed} AS chars,
  len(regexp_extract_all(text, '{WORDS}')) + {TURN_TOKENS} AS tokens FROM t),
b AS (SELECT *, nth = 1 AND role = 'system' AS head FROM a),
c AS (SELECT *, CASE WHEN head THEN 0 ELSE tokens END AS cost, CASE WHEN head THEN 0 ELSE chars END AS size,
  max(CASE WHEN head THEN tokens END) OVER (PARTITION BY conv_id) AS sys, max(CASE WHEN head THEN chars END) OVER (PARTITION BY conv_id) AS opening FROM b),
d AS (SELECT *, coalesce(sum(cost) OVER ({by} {until} 1 PRECEDING), 0)::BIGINT AS p,
  greatest(({BUDGET - HISTORY} - coalesce(sys, 0)) // 2, 1) AS half FROM c),
e AS (SELECT *, (cost > half)::INT AS long FROM d),
f AS (SELECT *, CASE WHEN head THEN coalesce(lead(long) OVER ({by}), 0)
  ELSE 2 * coalesce(sum(long) OVER ({by} {until} 1 PRECEDING), 0) + long END AS part, p // half AS k,
  coalesce(sum(size) OVER (PARTITION BY conv_id ORDER BY p RANGE BETWEEN {HISTORY} PRECEDING AND 1 PRECEDING), 0) AS recent FROM e),
g AS (SELECT *, (lag(part) OVER ({by}) IS NULL OR lag(part) OVER ({by}) <> part OR lag(k) OVER ({by}) <> k) AS opens FROM f),
h AS (SELECT *, sum(opens::INT) OVER ({by} {until} CURRENT ROW) AS win FROM g),
w AS (SELECT conv_id, win, max(opening) AS opening, sum(size) AS own, coalesce(arg_min(recent, nth) FILTER (NOT head), 0) AS recent FROM h GROUP BY ALL),
n AS (SELECT conv_id, sum(coalesce(opening, 0) + own + recent)::BIGINT AS formatted_chars FROM w GROUP BY conv_id),
o AS (SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY nth)) AS turns_sha256,
  coalesce(string_agg(text, '' ORDER BY nth) FILTER (role = 'assistant'), '') AS loss FROM h GROUP BY conv_id)
SELECT o.conv_id, n_turns, turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars
FROM o JOIN n ON o.conv_id IS NOT DISTINCT FROM n.conv_id
"""


OP3_SQL = _sql()
