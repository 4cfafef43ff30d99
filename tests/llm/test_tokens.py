"""BPE coding and token files against the tokenizers library."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark import session
from tidemark.llm import bpe, token_files
from tidemark.llm.queries import tokenizer_path

PATH = tokenizer_path()
ODD = [
    None, "", " ", "Hello, World.", "hello world", "don't DON'T it's 's", "é é ́x", "a b\x1cc d", "İI ΣΑΣ",
    "<|endoftext|>", "<|ENDOFTEXT|>", "x<|startoftext|>y z", "a.b, c., d,. .", "1234 12.5,", "😀😀 日本語 テキスト", "\x00 \x1f", "a" * 300,
    "ab" * 5000, "!?" * 4000 + "'s" * 3000, "é" * 9000, "word " * 3000, "Hello, World.",
]


@pytest.fixture(scope="module")
def library():
    return bpe.load(PATH)


def expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return ids, library.decode(ids, skip_special_tokens=False)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from(list("aAbé́'stll.,!<|>endoftx 1\n\t İß😀")), max_size=60), max_size=4))
def test_coder(texts):
    coder, library = bpe.Coder(PATH), bpe.load(PATH)
    for text, ids in zip(texts, coder.encode([t.encode() for t in texts])):
        want, decoded = expected(library, text)
        assert ids.tolist() == want
        assert coder.decode(ids).decode() == decoded


@pytest.mark.parametrize("unsplit,long,part", [(64, 100, 40), (bpe.UNSPLIT, 1000, 200), (bpe.UNSPLIT, bpe.LONG, bpe.PART)])
def test_bpe(make_docs, library, unsplit, long, part):
    docs = make_docs(ODD).withColumn("ids", F.lit(1)).withColumn("copies", F.lit(2))
    got = bpe.decode(bpe.encode(docs, PATH, unsplit, long, part), PATH).collect()
    assert sorted(r.doc_id for r in got) == list(range(len(ODD)))
    for r in got:
        ids, text = expected(library, ODD[r.doc_id])
        assert (r.n_tokens, np.frombuffer(r.ids, "<u4").tolist(), r.text) == (len(ids), ids, text)


def test_tree_of_long_texts(make_docs, library):
    """Long texts of words, signs, marks and special tokens, cut anywhere."""
    rng = random.Random(3)
    bits = ["word", "it's", "'s", "<|endoftext|>", "<|start", "é", "é", "日本", "  ", "\n", "1234", "...", "!?", "aaaa", "\x01", "x.y,", " "]
    texts = ["".join(rng.choice(bits) + rng.choice(["", " "]) for _ in range(n)) for n in (60, 900, 4000, 12_000)]
    docs = make_docs([(i, t) for i, t in enumerate(texts)] + [(2, texts[2])])
    rows = bpe.encode(docs, PATH, bpe.UNSPLIT, 200, 64).collect()
    assert sorted(r.doc_id for r in rows) == [0, 1, 2, 2, 3]
    for r in rows:
        assert np.frombuffer(r.ids, "<u4").tolist() == expected(library, texts[r.doc_id])[0]


def test_two_generations(library):
    """A small cache that is renewed all the time gives the same ids."""
    rng = random.Random(5)
    coder = bpe.Coder(PATH, cached=40)
    texts = [" ".join(rng.choice("abcdefgh") * rng.randint(1, 9) + rng.choice(["", ".", ",", "!", "\x01"]) for _ in range(30)) for _ in range(600)]
    for text, ids in zip(texts, coder.encode([t.encode() for t in texts])):
        assert ids.tolist() == expected(library, text)[0]
    assert len(coder.seen) + len(coder.older) < 2000


def test_bpe_repeated_rows_and_nothing(make_docs):
    rows = [(1, "xy" * 100), (1, "xy" * 100), (None, "xy" * 100), (None, "a"), (1, "b")]
    assert bpe.encode(make_docs(rows), PATH, 64).count() == 5
    assert bpe.encode(make_docs([]), PATH).count() == 0


def test_tree_of_joins(library):
    """Random unsplit texts, halved down to small parts, give the library's ids."""
    rng = random.Random(5)
    for n in range(60):
        alphabet = rng.choice(["ab", "the ing and tion er".replace(" ", ""), "!.'s-", "aé1'", "0123456789", "日本語a", "éa"])
        text = "".join(rng.choices(alphabet, k=rng.randint(64, 900)))
        parts = [(p, t, bpe.located(library, t, p)) for p, t in bpe.parts_of(text, 48)]
        while len(parts) > 1:
            pairs = zip(parts[::2], parts[1::2], strict=True)
            parts = [(p, a + b, bpe.join(library, a + b, p, x, q, y)) for (p, a, x), (q, b, y) in pairs]
        assert parts[0][2][:, 2].tolist() == library.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize("most", [1, 2, 1000, 49_408, 2**32 - 1])
@pytest.mark.parametrize("n", [0, 1, 127, 128, 5000])
def test_blocks(most, n):
    rng = np.random.default_rng(n + most)
    ids = rng.integers(0, most, n, dtype=np.uint32, endpoint=True)
    ids[rng.random(n) < 0.05] = most
    data, sizes = token_files.pack(ids)
    starts = np.cumsum(sizes) - sizes
    assert np.array_equal(token_files.unpack(np.frombuffer(data, np.uint8), starts)[:n], ids)


def test_blocks_patch_outliers():
    ids = np.arange(1000, 1128, dtype=np.uint32)
    ids[7] = 4_000_000_000
    assert len(token_files.pack(ids)[0]) == 8 + 16 * 7 + 5


@pytest.mark.parametrize("rows", [list(enumerate(ODD)), [(3, "b"), (None, "n"), (1, "a"), (3, "b"), (3, "c"), (-5, None)], []])
def test_token_files(spark, make_docs, library, rows):
    docs = make_docs(rows).withColumn("_tie", F.lit("x")).withColumn("start", F.lit("x"))
    folder = session.scratch_path(spark, "tokens")
    manifest = token_files.write(docs.repartition(3), PATH, folder)
    got = token_files.read(manifest, folder).orderBy("start").collect()
    assert sorted((-1e9 if i is None else i) for i, _ in rows) == [(-1e9 if r.doc_id is None else r.doc_id) for r in got]
    at, want = 0, {(i, tuple(expected(library, t)[0] + [1])) for i, t in rows}
    for r in got:
        ids = np.frombuffer(r.ids, "<u4")
        assert r.start == at and r.n_tokens == len(ids) and (r.doc_id, tuple(ids.tolist())) in want
        at += r.n_tokens
    crc = {(r.start, r.ids_crc32) for r in token_files.read(manifest, folder, digest=True).collect()}
    assert crc == {(r.start, zlib.crc32(r.ids)) for r in got}


def test_query_matches_library(spark, library):
    from tidemark.llm.queries import op7_bpe

    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    for r in op7_bpe(spark, "/root/testdata/sf0.001").collect():
        ids, text = expected(library, texts[r.doc_id])
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_stores(make_docs):
    assert token_files._store("/tmp/x")[1] == "/tmp/x"
    store, path = token_files._store("s3a://bucket/folder?region=eu-west-1")
    assert (store.type_name, path) == ("s3", "bucket/folder")
    with pytest.raises(ValueError, match="viewfs"):
        token_files.write(make_docs(["a"]), PATH, "viewfs://store/in")
