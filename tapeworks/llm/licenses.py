"""Licence scan by ordered signature rules (operator 10), in DataFrame functions throughout.

Words are runs of digits, letters and non-ASCII characters, with A-Z lower-cased. Two prefilters decide what
is tried: texts with none of the gate's words are not scanned, and a rule is tried only where its keyword
stands. A scanned text is written as its words, each with its place in front (``0:mit 1:license``), so that
a match tells where it starts and ends.

Detections are resolved by place: one that lies inside another of the same or a higher priority is dropped;
of equal places the higher priority stays, then the earlier rule. Base phrases are counted wherever they
stand and their labels always stay. ``score`` is the weight of the best detection that stays, 0 without any.

Null and empty texts have no words, empty labels and score 0. Rows are judged one by one: repeated rows and
ids, or null ids, give a row each. Other columns are ignored. An empty table gives an empty result. Only
the detections (four small numbers each) are shuffled, never texts.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tapeworks.llm.common import table
from tapeworks.llm.license_rules import GATE, RULES, WEIGHTS, Rule

LETTERS = r"0-9A-Za-z\x{80}-\x{10FFFF}"
WORD = f"[{LETTERS}]+"
CC = rf"(?i)(?<![{LETTERS}])cc0?(?![{LETTERS}])"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def placed(pattern: str) -> str:
    """A rule's pattern over words that carry their places."""
    return r"(?<= )\d+:(?:" + pattern.replace(" ", r" \d+:") + r")(?= )"


def gate(text: Column) -> Column:
    lower = F.lower(text)
    passed = F.lit(False)
    for word in GATE:
        passed = passed | F.contains(lower, F.lit(word))
    return passed | (F.contains(lower, F.lit("cc")) & F.rlike(text, F.lit(CC)))


def _rules(rules: tuple[Rule, ...]) -> Column:
    rows = [{
        "n": r.number, "l": r.label, "p": r.priority, "k": r.keyword, "r": placed(r.pattern), "b": r.base,
    } for r in rules]
    return F.from_json(F.lit(json.dumps(rows)), "array<struct<n:int, l:string, p:int, k:string, r:string, b:boolean>>")


def _detections(words: Column, rules: tuple[Rule, ...]) -> Column:
    """array<struct<start, end, priority, number, label, base>> of a scanned text."""
    keywords = F.array(*(F.lit(k) for k in sorted({r.keyword for r in rules})))
    told = F.concat(
        F.lit(" "), F.array_join(F.transform(words, lambda w, i: F.concat(i.cast("string"), F.lit(":"), w)), " "), F.lit(" ")
    )

    def found(text_and_keys: Column) -> Column:
        tried = F.filter(_rules(rules), lambda r: F.array_contains(text_and_keys["keys"], r["k"]))
        return F.flatten(F.transform(tried, lambda r: F.transform(
            F.regexp_extract_all(text_and_keys["told"], r["r"], F.lit(0)),
            lambda m: F.struct(
                F.substring_index(m, ":", 1).cast("int").alias("start"),
                (F.substring_index(m, ":", 1).cast("int") + F.length(m) - F.length(F.replace(m, F.lit(" "), F.lit("")))).alias("end"),
                r["p"].alias("priority"), r["n"].alias("number"), r["l"].alias("label"), r["b"].alias("base"),
            ),
        )))

    # A one-element array holds what every rule reads, so that it is computed once a text.
    held = F.array(F.struct(told.alias("told"), F.array_intersect(words, keywords).alias("keys")))
    return F.flatten(F.transform(held, found))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(id, n_words, _row, found): one row per detection, and one with ``found`` null per text without any."""
    plain = docs.select(
        docs[id_col].alias("_id"), F.coalesce(docs[text_col], F.lit("")).alias("_text"), F.monotonically_increasing_id().alias("_row")
    )
    words = F.regexp_extract_all(F.translate("_text", UPPER, LOWER), F.lit(WORD), F.lit(0))
    counted = plain.select(
        "_id", "_row", F.regexp_count("_text", F.lit(WORD)).cast("bigint").alias("n_words"),
        F.when(gate(F.col("_text")), words).alias("_words"),
    )
    scanned = counted.select("_id", "_row", "n_words", F.when(F.col("_words").isNotNull(), _detections(F.col("_words"), rules)).alias("_all"))
    return scanned.select("_id", "_row", "n_words", F.explode_outer("_all").alias("found"))


def resolve(scanned: DataFrame) -> DataFrame:
    """Adds ``stays``: whether no detection of the same or a higher priority covers this one."""
    earlier = (
        W.partitionBy("_row")
        .orderBy("found.start", F.desc("found.end"), "found.priority", "found.number")
        .rowsBetween(W.unboundedPreceding, -1)
    )
    covered = F.lit(False)
    for priority in sorted(WEIGHTS):
        reach = F.max(F.when(F.col("found.priority") <= priority, F.col("found.end"))).over(earlier)
        covered = covered | ((F.col("found.priority") == priority) & F.coalesce(reach >= F.col("found.end"), F.lit(False)))
    return scanned.withColumn("stays", ~F.coalesce(covered, F.lit(False)))


def license_report(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per document of ``docs(doc_id, text)``."""
    base = F.when(F.col("found.base"), F.lit(True))
    weight = F.lit(0.0)
    for priority, value in WEIGHTS.items():
        weight = F.when(F.col("found.priority") == priority, F.lit(value)).otherwise(weight)
    told = lambda label: F.array_join(F.array_sort(F.collect_set(label)), ",")
    return (
        resolve(scan(docs, rules=rules)).groupBy("_row", "_id", "n_words").agg(
            F.count(base).alias("n_base"),
            F.min(F.when(base, F.col("found.start"))).cast("bigint").alias("first_word"),
            F.max(F.when(base, F.col("found.start"))).cast("bigint").alias("last_word"),
            told(F.when(base, F.col("found.label"))).alias("base_labels"),
            told(F.when(F.coalesce(base, F.col("stays")), F.col("found.label"))).alias("labels"),
            F.coalesce(F.max(F.when(F.col("stays") & F.col("found").isNotNull(), weight)), F.lit(0.0)).alias("score"),
        ).select(F.col("_id").alias("doc_id"), "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    )


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_report(table(spark, sf_dir, "documents"))
