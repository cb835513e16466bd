"""The corpus pipeline, stage by stage, against brute force on what each stage was given."""

import numpy as np
import public_tokenizers
import tiktoken
from oracle import duck
from test_documents import plain_counts, plain_distance, plain_quality
from test_duplicates import brute_near

import corpus_pipeline
from tapeworks.llm import bpe_prefix, divergence, mixing
from tapeworks.llm.common import settle

FOLDER = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def good(rows):
    sums = {}
    for _, text, lang in rows:
        old = sums.get(lang, ([0] * divergence.N_CLASSES, [0] * (len(divergence.WORDS) + 1)))
        sums[lang] = tuple([a + b for a, b in zip(x, y)] for x, y in zip(old, plain_counts(text)))
    out = set()
    for i, text, _ in rows:
        own, base = plain_counts(text), plain_quality(text)
        by_class, by_word = (min(plain_distance(own[k], ref[k]) for ref in sums.values()) for k in (0, 1))
        far = len(text) >= 200 and by_class > divergence.MOST_CLASS_DISTANCE or base[0] >= 100 and by_word > divergence.MOST_WORD_DISTANCE
        if not base[-1] and not far:
            out.add(i)
    return out


def test_every_stage(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        given = docs
        docs = settle(stage(spark, docs, FOLDER), name)
        seen[name] = (given, docs)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == COLUMNS and 0 < docs.count() < given.count()

    def rows(name, side):
        return [tuple(r) for r in seen[name][side].select("doc_id", "text", "lang").collect()]

    assert {i for i, *_ in rows("quality_rules", 1)} == good(rows("quality_rules", 0))
    last = {}
    for i, text, _ in rows("exact_dedup", 0):
        key = text.encode().lower()
        last[key] = max(i, last.get(key, i))
    assert {i for i, *_ in rows("exact_dedup", 1)} == set(last.values())
    near = brute_near([r[:2] for r in rows("near_dedup", 0)], 5, 80)
    assert {i for i, *_ in rows("near_dedup", 1)} == {i for i, _, least in near if i == least}
    given = seen["mixing"][0]
    taken = mixing.mix(given, mixing.tree(given), corpus_pipeline.WEIGHTS, corpus_pipeline.SHARE, 1).collect()
    assert {i for i, *_ in rows("mixing", 1)} == {r._id for r in taken if r.copies or r.part_tokens}
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, special_tokens={},
        mergeable_ranks=bpe_prefix.read_ranks(public_tokenizers.path(bpe_prefix.RANKS)),
    )
    counts = {r.doc_id: r.n_tokens for r in docs.collect()}
    assert counts == {i: len(library.encode_ordinary(text)) for i, text, _ in rows("token_ids", 0)}
    assert np.mean(list(counts.values())) > 10


def test_clean_documents_survive_the_filters(spark):
    folder = "/root/testdata/sf0.01"
    con = duck(folder)
    labels = dict(con.execute("SELECT doc_id, quality FROM labels").fetchall())
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {r.doc_id for r in corpus_pipeline.quality_rules(spark, docs, folder).select("doc_id").collect()}
    long = {i for i, n in con.execute("SELECT doc_id, len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) FROM documents").fetchall() if n >= 20}
    good_ones = {i for i, q in labels.items() if q == 1 and i in long}
    assert len(good_ones & kept) >= 0.98 * len(good_ones)


def test_a_table_without_rows_passes_through(spark, tmp_path):
    spark.read.parquet(f"{FOLDER}/documents.parquet").filter("false").write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
