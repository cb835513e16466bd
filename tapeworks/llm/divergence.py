"""Quality rules by distribution divergence (operator 6).

A document's characters, by class, and its words, by common word, make two histograms. Each is compared with
the histograms of all documents of each language by Jensen-Shannon distance (base 2, so 0 to 1), and the
nearest language counts, whatever the document's label says. Documents too short for a fair histogram are
not judged by it. The references hold every row of the table: two small histograms per language, summed
before they are shuffled, so that a language with most of the rows costs no more than another.

Base rules come first: too few words, or too many words in repeated eight-word windows.

Null texts are empty: no words, ``base_failed``, not kept. Rows with a null or unlisted language add nothing to
the references, but are judged by them; without any reference the verdict is to keep. Repeated rows and
ids are judged row by row. Other columns are ignored (``keep_good`` passes them on). An empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeworks.llm.common import keep_between_tasks, map_batches, table, texts

WINDOW = 8
LEAST_WORDS = 20
REPEAT_PERCENT = 30
LEAST_CHARS_JUDGED = 200
LEAST_WORDS_JUDGED = 100
MOST_CLASS_DISTANCE = 0.30
MOST_WORD_DISTANCE = 0.35

# Frequent function words.
COMMON_WORDS = {
    "en": "the of and to in a is that for it was on with as be by at this are from or an he you not",
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus",
    "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se ce avec",
    "es": "de la que el en y a los del se las por un para con no una su al es lo como más o pero",
}
WORDS = sorted({w for line in COMMON_WORDS.values() for w in line.split()})
SYMBOLS = b"#*$%&|<>"
WHITE = " \t\n\r\x0b\x0c"
# Character classes; the first that has a character counts.
CLASSES = (
    ("lower", "abcdefghijklmnopqrstuvwxyz"), ("upper", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"), ("digit", "0123456789"),
    ("white", WHITE), ("stop", ".,;:?'\"()-"), ("loud", "!"), ("pipe", "|"),
)
SYMBOL, ACCENTED, OTHER = len(CLASSES), len(CLASSES) + 1, len(CLASSES) + 2
N_CLASSES = len(CLASSES) + 3
LATIN_END = 0x250


def _class_table() -> np.ndarray:
    out = np.full(LATIN_END + 1, OTHER, np.int64)
    for point in range(0x21, 0x7F):
        out[point] = SYMBOL
    for point in range(0x80, LATIN_END):
        out[point] = ACCENTED if chr(point).isalpha() else OTHER
    for number, (_, chars) in enumerate(CLASSES):
        out[[ord(c) for c in chars]] = number
    return out


CLASS_OF = _class_table()


class _CommonWords(dict):
    """Word as it stands -> its number among the common words, or the last number for all others."""

    def __init__(self):
        super().__init__()
        self.known = {w.encode(): i for i, w in enumerate(WORDS)}

    def __missing__(self, word: bytes) -> int:
        number = self.known.get(word.strip(b".,;:?!'\"()-").lower(), len(WORDS))
        if len(self) >= 300_000:
            self.clear()
        if len(word) <= 32:
            self[word] = number
        return number


_common = _CommonWords()
keep_between_tasks(__name__, _common.clear)


def class_counts(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    return np.bincount(CLASS_OF[np.minimum(points, LATIN_END)], minlength=N_CLASSES)


def word_counts(words: list[bytes]) -> np.ndarray:
    return np.bincount(np.fromiter(map(_common.__getitem__, words), np.int64, len(words)), minlength=len(WORDS) + 1)


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words in windows that stand twice or more in the text."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    known: dict[bytes, int] = {}
    number = np.array([known.setdefault(w, len(known)) for w in words], np.uint64)
    mixed = np.zeros(n, np.uint64)
    for i in range(window):
        mixed = (mixed ^ (number[i:i + n] + np.uint64(1))) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    _, inverse, counts = np.unique(mixed, return_inverse=True, return_counts=True)
    starts = np.flatnonzero(counts[inverse] > 1)
    cover = np.zeros(len(words) + 1, np.int64)
    cover[starts] += 1
    np.subtract.at(cover, starts + window, 1)
    return int((np.cumsum(cover) > 0).sum())


def base_counts(text: str, raw: bytes, words: list[bytes]) -> tuple[int, int, int, int]:
    """(characters in words, symbols, repeated lines, repeated words)."""
    lines = [line for line in raw.split(b"\n") if line.strip()]
    return (
        len(text) - sum(map(text.count, WHITE)), len(raw) - len(raw.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)), repeated_words(words),
    )


def distances(counts: np.ndarray, references: np.ndarray) -> np.ndarray:
    """Least Jensen-Shannon distance of each row of counts to the references; 0 where there is nothing to compare."""
    if not len(references) or not len(counts):
        return np.zeros(len(counts))
    p = (counts / np.maximum(counts.sum(axis=1, keepdims=True), 1))[:, None, :]
    q = (references / np.maximum(references.sum(axis=1, keepdims=True), 1))[None, :, :]
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        a = np.where(p > 0, p * np.log2(p / m), 0).sum(axis=2)
        b = np.where(q > 0, q * np.log2(q / m), 0).sum(axis=2)
    return np.sqrt(np.maximum((a + b) / 2, 0)).min(axis=1)


def _gather(batches: Iterator[dict], languages: list[str]) -> Iterator[dict]:
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        for text, lang in zip(texts(batch["_text"]), batch["_lang"].to_pylist()):
            if lang in languages:
                own = np.concatenate([class_counts(text), word_counts(text.encode().split())])
                sums[lang] = sums[lang] + own if lang in sums else own
    for lang, counts in sums.items():
        yield {"_lang": [lang] * len(counts), "_bin": range(len(counts)), "_count": counts}


def references(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> tuple[np.ndarray, np.ndarray]:
    """Class and word histograms per language over all rows; a few hundred numbers, whatever the input."""
    narrow = docs.select(docs[text_col].alias("_text"), docs[lang_col].alias("_lang"))
    sums = (
        map_batches(narrow, _gather, "_lang string, _bin int, _count bigint", languages=list(COMMON_WORDS))
        .groupBy("_lang", "_bin").agg(F.sum("_count").alias("_count")).collect()
    )
    rows = {lang: np.zeros(N_CLASSES + len(WORDS) + 1) for lang in sorted({r["_lang"] for r in sums})}
    for lang, number, count in sums:
        rows[lang][number] = count
    whole = np.array(list(rows.values())).reshape(len(rows), N_CLASSES + len(WORDS) + 1)
    return whole[:, :N_CLASSES], whole[:, N_CLASSES:]


def judge(batch: list[str], classes: np.ndarray, words: np.ndarray, class_most: float, word_most: float) -> dict[str, list]:
    """Base figures, both distances and the verdict of each text."""
    out: dict[str, list] = {c: [] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")}
    own_classes, own_words, chars = [], [], []
    for text in batch:
        raw = text.encode()
        told = raw.split()
        for column, value in zip(out.values(), (len(told), *base_counts(text, raw, told))):
            column.append(value)
        own_classes.append(class_counts(text))
        own_words.append(word_counts(told))
        chars.append(len(text))
    by_class, by_word = distances(np.array(own_classes), classes), distances(np.array(own_words), words)
    count, repeat = np.array(out["n_words"]), np.array(out["n_repeat_words"])
    failed = (count < LEAST_WORDS) | (100 * repeat > REPEAT_PERCENT * count)
    far = (np.array(chars) >= LEAST_CHARS_JUDGED) & (by_class > class_most)
    far |= (count >= LEAST_WORDS_JUDGED) & (by_word > word_most)
    return out | {"class_distance": by_class, "word_distance": by_word, "base_failed": failed, "kept": ~failed & ~far}


def _judge(batches: Iterator[dict], columns: list[str], **given) -> Iterator[dict]:
    for batch in batches:
        yield {c: batch[c] for c in columns} | judge(texts(batch["_text"]), **given)


def _good(batches: Iterator[dict], columns: list[str], **given) -> Iterator[dict]:
    for batch in batches:
        stay = np.flatnonzero(judge(texts(batch["_text"]), **given)["kept"])
        yield {c: batch[c].take(stay) for c in columns}


def quality(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", class_most: float = MOST_CLASS_DISTANCE,
    word_most: float = MOST_WORD_DISTANCE, id_col: str = "doc_id",
) -> DataFrame:
    """(_id, base figures, both distances, base_failed, kept) per row."""
    classes, words = references(docs, text_col, lang_col)
    narrow = docs.select(docs[id_col].cast("bigint").alias("_id"), docs[text_col].alias("_text"))
    schema = (
        "_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
        "base_failed boolean, kept boolean, class_distance double, word_distance double"
    )
    return map_batches(narrow, _judge, schema, columns=["_id"], classes=classes, words=words, class_most=class_most, word_most=word_most)


def keep_good(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", class_most: float = MOST_CLASS_DISTANCE,
    word_most: float = MOST_WORD_DISTANCE,
) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns; no shuffle."""
    classes, words = references(docs, text_col, lang_col)
    names = [f"_c{i}" for i in range(len(docs.columns))]
    plain = docs.select(*(docs[c].alias(n) for c, n in zip(docs.columns, names)), docs[text_col].alias("_text"))
    schema = ", ".join(f"{n} {f.dataType.simpleString()}" for n, f in zip(names, docs.schema))
    kept = map_batches(plain, _good, schema, columns=names, classes=classes, words=words, class_most=class_most, word_most=word_most)
    return kept.select(*(F.col(n).alias(c) for n, c in zip(names, docs.columns)))


def op6_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = quality(table(spark, sf_dir, "documents")).withColumnRenamed("_id", "doc_id")
    return told.withColumns({c: F.round(c, 6) for c in ("class_distance", "word_distance")})


def _sql() -> str:
    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    def inside(chars: str) -> str:
        return "".join(f"\\x{ord(c):02X}" for c in chars)

    strip = ".,;:?!'\"()-"
    listed = [f"[{inside(chars)}]" for _, chars in CLASSES]
    known = "".join(inside(chars) for _, chars in CLASSES)
    rest = "".join(f"\\x{p:02X}" for p in range(0x21, 0x7F) if not any(chr(p) in chars for _, chars in CLASSES))
    accented = "".join(chr(p) for p in range(0x80, LATIN_END) if chr(p).isalpha())
    classes = [*listed, f"[{rest}]", f"[{accented}]", f"[^{known}{rest}{accented}]"]
    counts = ", ".join(f"length(t) - length(regexp_replace(t, '{c}', '', 'g'))" for c in classes)
    langs = ", ".join(map(quoted, COMMON_WORDS))
    words = ", ".join(map(quoted, WORDS))
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

    def nearest(name: str) -> str:
        """Least distance per row between its histogram and those of the languages."""
        return f"""
{name}_l AS (SELECT lang, bin, sum(c) AS c FROM {name} JOIN d USING (r) WHERE lang IN ({langs}) GROUP BY ALL),
{name}_q AS (SELECT lang, bin, c / greatest(sum(c) OVER (PARTITION BY lang), 1) AS q FROM {name}_l),
{name}_p AS (SELECT r, bin, c / greatest(sum(c) OVER (PARTITION BY r), 1) AS p FROM {name}),
{name}_j AS (SELECT r, lang, (sum(CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END)
  + sum(CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END)) / 2 AS j FROM {name}_p JOIN {name}_q USING (bin) GROUP BY ALL),
{name}_d AS (SELECT r, sqrt(greatest(min(j), 0)) AS {name} FROM {name}_j GROUP BY r),"""

    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w, string_split(t, chr(10)) AS lines FROM d),
b AS (SELECT r, doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, length(t) AS chars,
  length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
  list_filter(lines, lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS told FROM w),
v AS (SELECT r, i, array_to_string(w[i:i + {WINDOW - 1}], ' ') AS g FROM w, unnest(range(1, len(w) - {WINDOW - 2})) AS u(i) WHERE len(w) >= {WINDOW}),
twice AS (SELECT r, i FROM v QUALIFY count(*) OVER (PARTITION BY r, g) > 1),
cover AS (SELECT r, count(DISTINCT i + k) AS n FROM twice, unnest(range({WINDOW})) AS u(k) GROUP BY r),
class AS (SELECT r, unnest([{counts}]) AS c, unnest(range({N_CLASSES})) AS bin FROM d),
word AS (SELECT r, bin, count(x) AS c FROM (SELECT r, coalesce(list_position([{words}],
    translate(trim(x, {quoted(strip)}), '{upper}', '{lower}')), 0) AS bin, x FROM (SELECT r, unnest(w) AS x FROM w))
  GROUP BY ALL UNION ALL SELECT r, bin, 0 FROM d, range({len(WORDS) + 1}) AS z(bin)),
words AS (SELECT r, bin, sum(c) AS c FROM word GROUP BY ALL),{nearest('class')}{nearest('words')}
f AS (SELECT b.*, coalesce(n, 0) AS n_repeat_words, coalesce(class, 0) AS by_class, coalesce(words, 0) AS by_word,
  n_words < {LEAST_WORDS} OR 100 * coalesce(n, 0) > {REPEAT_PERCENT} * n_words AS base_failed
  FROM b LEFT JOIN cover USING (r) LEFT JOIN class_d USING (r) LEFT JOIN words_d USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, len(told) - len(list_distinct(told)) AS n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT (chars >= {LEAST_CHARS_JUDGED} AND by_class > {MOST_CLASS_DISTANCE})
    AND NOT (n_words >= {LEAST_WORDS_JUDGED} AND by_word > {MOST_WORD_DISTANCE}) AS kept,
  round(by_class, 6) AS class_distance, round(by_word, 6) AS word_distance FROM f
"""


OP6_SQL = _sql()
