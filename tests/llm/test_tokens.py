"""Operators 7 and 8: ids against the public libraries, exact round trips, files read in parts."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import tiktoken
from oracle import duck

from tapeworks.llm import bitplanes, bpe_prefix
from tapeworks.llm.files import open_file
from tapeworks.llm.pieces import _full, pieces
from tapeworks.session import work_folder

RANKS = public_tokenizers.path(bpe_prefix.RANKS)
ALPHABETS = ["ab", " \n\t\r\x1c\x85 a'st", "aAé1²½ _-", "漢字かな١٢　  x", "\U0001f600‍♂️ x", "the and of ion tion", " ", "'sS"]


def random_texts(n, seed=1, longest=60):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, longest))) for alphabet in (rnd.choice(ALPHABETS) for _ in range(n))]


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe_prefix.read_ranks(RANKS), special_tokens={})


def test_ids_equal_the_library(library):
    own = bpe_prefix.encoder(RANKS)
    for text in random_texts(4000) + ["x" * 3000, "=" * 1000 + " " * 777 + "\n" * 99, "<|endoftext|>"]:
        packed = own.encode(text)
        assert np.frombuffer(packed, "<u4").tolist() == library.encode_ordinary(text), text
        assert own.decode(packed) == text.encode()


def test_pieces_make_up_the_text_and_both_matchers_agree():
    for text in random_texts(4000, 2):
        assert "".join(pieces(text)) == text
        assert pieces(text) == _full.findall(text)


def test_appends_and_edits_equal_encoding_anew():
    vocabulary, rnd = bpe_prefix.encoder(RANKS).vocabulary, random.Random(3)
    for _ in range(300):
        raw = bytes(rnd.choice(b"theationofrdx") for _ in range(rnd.randint(1, 40)))
        table = bpe_prefix.Prefixes(vocabulary, raw[:5])
        table.append(raw[5:])
        assert table.last == bpe_prefix.Prefixes(vocabulary, raw).last
        begin = rnd.randint(0, len(raw))
        end = rnd.randint(begin, len(raw))
        table.edit(begin, end, b"ion")
        changed = raw[:begin] + b"ion" + raw[end:]
        assert table.piece == changed and table.tokens() == bpe_prefix.Prefixes(vocabulary, changed).tokens()


def test_every_prefix_is_encoded(library):
    vocabulary, word = bpe_prefix.encoder(RANKS).vocabulary, b" internationalisation"
    table = bpe_prefix.Prefixes(vocabulary, word)
    for end in range(1, len(word) + 1):
        assert table.tokens(end) == library.encode_ordinary(word[:end].decode())


ROWS = [(3, "MIT x"), (1, None), (2, ""), (3, "MIT x"), (None, "é漢"), (7, "long " * 30_000), (3, "other"), (-5, "<|endoftext|> \x00\x1c")]


def rows(spark, given=ROWS):
    return spark.createDataFrame([(i, t, "x", "y") for i, t in given], "doc_id long, text string, _text string, ids string")


def test_bpe_of_odd_rows(spark, library):
    got = sorted((tuple(r) for r in bpe_prefix.encode_report(rows(spark), RANKS).collect()), key=str)
    want = []
    for i, t in ROWS:
        ids = np.array(library.encode_ordinary(t or ""), "<u4").tobytes()
        want.append((i, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want, key=str)
    ids = bpe_prefix.encode(rows(spark), RANKS)
    assert {bytes(r.raw) for r in bpe_prefix.decode(ids, RANKS).collect()} == {(t or "").encode() for _, t in ROWS}
    assert bpe_prefix.encode_report(rows(spark, []), RANKS).count() == 0


def plain_ids(text):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path(bitplanes.VOCABULARY))
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, bitplanes.END_ID]


def report(given):
    out, start = [], 0
    for i, t in sorted(given, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode())):
        ids = np.array(plain_ids(t), "<u4")
        out.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("kind,most", [("byte", 1 << 20), ("bit", 100)])
def test_plane_files_of_odd_rows(spark, kind, most):
    given = ROWS + [(i, t) for i, t in enumerate(random_texts(40, 5), 100)]
    manifest = bitplanes.write_planes(
        rows(spark, given).repartition(3), work_folder(spark, "t"), public_tokenizers.path(bitplanes.VOCABULARY), kind=kind, block=64, most=most
    )
    got = sorted((tuple(r) for r in bitplanes.read_report(manifest).collect()), key=lambda r: r[1])
    assert got == report(given)
    first = manifest.orderBy("base").first()
    with open_file(first.file) as file:
        reader = bitplanes.PlaneReader(file)
        whole = np.concatenate([p for _, _, parts in reader.documents() for p in parts])
        assert (reader.ids(1, len(whole) - 1) == whole[1:]).all()

ADDED = ["a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|>", "漢<|endoftext|>字 x", "  <|endoftext|>\n", "<|endoftext|", "<|ENDOFTEXT|>", "plain", "é" * 50 + "<|endoftext|>"]


def test_added_tokens_are_one_id_as_in_the_unaltered_library(spark):
    from tokenizers import Tokenizer

    path = public_tokenizers.path(bitplanes.VOCABULARY)
    library, own = Tokenizer.from_file(path), bitplanes.encoder(path)
    for text in [*ADDED, *random_texts(500, 6)]:
        assert own.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids, text
    assert own.encode("a <|endoftext|> b").tolist() == [64, 220, 50256, 275]
    manifest = bitplanes.write_planes(rows(spark, list(enumerate(ADDED))), work_folder(spark, "t"), path)
    want, start = [], 0
    for i, text in enumerate(ADDED):
        ids = np.array([*library.encode(text, add_special_tokens=False).ids, bitplanes.END_ID], "<u4")
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(tuple(r) for r in bitplanes.read_report(manifest).collect()) == want



def test_planes_of_an_empty_table(spark):
    manifest = bitplanes.write_planes(rows(spark, []), work_folder(spark, "t"), public_tokenizers.path(bitplanes.VOCABULARY))
    assert bitplanes.read_report(manifest).count() == 0


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_planes_turn_back(kind):
    ids = np.random.default_rng(1).integers(0, 2**32, 1001, dtype=np.uint32)
    assert (bitplanes.join_planes(bitplanes.split_planes(ids, kind), 1001, kind) == ids).all()


def test_a_file_that_is_none():
    with pytest.raises(ValueError):
        bitplanes.PlaneReader(pa.BufferReader(b"x" * 64))


def test_queries_on_the_smallest_tables(spark, library):
    folder = "/root/testdata/sf0.001"
    docs = duck(folder).execute("SELECT doc_id, text FROM documents").fetchall()
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in bitplanes.op8_bitplanes(spark, folder).collect()}
    assert got == {i: rest for i, *r in report(docs) for rest in [tuple(r)]}
    counts = {r.doc_id: r.n_tokens for r in bpe_prefix.op7_bpe_prefix(spark, folder).collect()}
    assert counts == {i: len(library.encode_ordinary(t)) for i, t in docs}
