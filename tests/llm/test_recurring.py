"""Suffix and phrase deduplication against every window of every text."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import phrases, recurring, suffix_dedup


def plain_bytes(rows, width=200):
    """(id, bytes, removed, spans, digest) of each row."""
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = {}
    for _, t in texts:
        for p in range(len(t) - width + 1):
            seen[t[p : p + width]] = seen.get(t[p : p + width], 0) + 1
    out = []
    for i, t in texts:
        gone = np.zeros(len(t), bool)
        for p in range(len(t) - width + 1):
            if seen[t[p : p + width]] > 1:
                gone[p : p + width] = True
        stays = bytes(b for b, g in zip(t, gone) if not g)
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out.append((i, len(t), int(gone.sum()), spans, hashlib.sha256(stays).hexdigest()))
    return sorted(out, key=repr)


def plain_words(rows, width=50):
    texts = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    least = {}
    rank = lambda i: float("inf") if i is None else i
    for i, ws in texts:
        for p in range(len(ws) - width + 1):
            key = tuple(ws[p : p + width])
            least[key] = min(least.get(key, float("inf")), rank(i))
    out = []
    for i, ws in texts:
        gone = [False] * len(ws)
        for p in range(len(ws) - width + 1):
            if least[tuple(ws[p : p + width])] < rank(i):
                gone[p : p + width] = [True] * width
        stays = " ".join(w for w, g in zip(ws, gone) if not g)
        out.append((i, len(ws), sum(gone), hashlib.sha256(stays.encode()).hexdigest()))
    return sorted(out, key=repr)


def corpus(seed):
    """Texts with passages in common (whole, cut, with edits), periodic texts, copies, odd rows."""
    rng = random.Random(seed)
    some = lambda n: "".join(rng.choices("abcdé \n", k=n))
    talk = lambda n: rng.choice([" ", "\n", "  "]).join(f"w{rng.randint(0, 300)}" for _ in range(n))
    shared = [some(n) for n in (199, 200, 201, 260, 500)] + [talk(n) for n in (49, 50, 51, 80, 200)]
    texts = [None, "", "x", "ab" * 400, "a" * 1500, "w " * 300, "one two " * 60, None, "\t \n"]
    for _ in range(60):
        parts = [rng.choice([some, talk])(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 2)):
            passage = rng.choice(shared)
            if rng.random() < 0.3:
                passage = passage[rng.randint(0, 40) :]
            if rng.random() < 0.3:
                at = rng.randrange(len(passage))
                passage = passage[:at] + "Q" + passage[at + 1 :]
            parts += [" ", passage, " ", some(rng.randint(0, 40))]
        texts.append("".join(parts))
    texts += rng.sample(texts, 12)
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    return rows + [rows[20], (None, texts[30]), (3, texts[31]), (3, texts[32])]


def compare(got, want, columns):
    rows = sorted(((r.doc_id, *(r[c] for c in columns)) for r in got.collect()), key=repr)
    assert rows == want


@pytest.mark.parametrize("hot", [recurring.HOT_BYTES, 1000])
def test_suffix_dedup(make_docs, hot):
    rows = corpus(1)
    docs = make_docs(rows).withColumn("sha", F.lit("x")).withColumn("class", F.lit(1)).withColumn("rep", F.lit(1))
    got = suffix_dedup.removal(docs, hot)
    compare(got, plain_bytes(rows), ["n_bytes", "n_removed", "n_spans", "kept_sha256"])


@pytest.mark.parametrize("hot", [recurring.HOT_BYTES, 1000])
def test_phrases(make_docs, hot):
    rows = corpus(2)
    docs = make_docs(rows).withColumn("sha", F.lit("x")).withColumn("n", F.lit(1)).withColumn("anchor", F.lit(1))
    compare(phrases.removal(docs, hot), plain_words(rows), ["n_words", "n_removed", "kept_sha256"])


def log_like(seed, lines):
    """One text of lines that have much in common, some of them again."""
    rng = random.Random(seed)
    common = " ".join(f"field{k}=value{k}" for k in range(40))
    return "\n".join(f"{rng.randrange(lines // 2)} {common} user{rng.randrange(lines)} took {k % 7} ms" for k in range(lines))


@pytest.mark.parametrize("module,plain,columns", [
    (suffix_dedup, plain_bytes, ["n_bytes", "n_removed", "n_spans", "kept_sha256"]),
    (phrases, plain_words, ["n_words", "n_removed", "kept_sha256"]),
])
def test_kernels_get_bounded_bytes(make_docs, module, plain, columns, monkeypatch, tmp_path):
    """A large log and very many texts that share a line: no kernel gets more than a chunk and an anchor."""
    line = " ".join(f"shared{k}" for k in range(60))
    rows = [(0, log_like(1, 1200)), (1, log_like(2, 300))] + [(i, f"a{i} {line} z{i}") for i in range(2, 1500)]
    chunk, hot, kernel = 1 << 16, 1 << 15, module.kernel
    note = str(tmp_path / "sizes")

    def measured(table):
        with open(note, "a") as file:
            file.write(f"{table['data'].combine_chunks().nbytes} ")
        return kernel(table)

    monkeypatch.setattr(module, "CHUNK_BYTES", chunk)
    monkeypatch.setattr(module, "kernel", measured)
    compare(module.removal(make_docs(rows), hot), plain(rows), columns)
    sizes = [int(x) for x in open(note).read().split()]
    assert sizes and max(sizes) <= 2 * (chunk + hot)


def test_texts_that_stay(make_docs):
    rows = [(1, "x" * 150 + "y" * 150), (2, "z" + "x" * 150 + "y" * 150), (3, "short")]
    got = {r.doc_id: bytes(r.kept) for r in suffix_dedup.without_repeats(make_docs(rows)).collect()}
    assert got == {1: b"", 2: b"z", 3: b"short"}
    said = " ".join(f"w{k}" for k in range(60))
    rows = [(1, said), (2, "new  " + said), (3, said), (4, "a  b")]
    got = {r.doc_id: r.kept for r in phrases.without_repeats(make_docs(rows)).collect()}
    assert got == {1: said, 2: "new", 3: "", 4: "a  b"}


def test_nothing(make_docs):
    assert suffix_dedup.removal(make_docs([])).count() == 0
    assert phrases.removal(make_docs([])).count() == 0
    assert suffix_dedup.removal(make_docs(["a"])).collect()[0].n_removed == 0
    assert phrases.removal(make_docs([None])).collect()[0].n_words == 0


def test_merged_transforms(monkeypatch):
    """Many small shards give the rows and intervals of one sort."""
    rng = np.random.default_rng(3)
    for shard in (300, 1000, 10**6):
        monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", shard)
        parts = [rng.integers(0, 2, rng.integers(200, 500), dtype=np.uint8) for _ in range(8)]
        parts += [parts[0][:250], np.concatenate([parts[1][30:], parts[2]]), parts[3]]
        data, first = np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        seen = {}
        for a, b in zip(first, first[1:]):
            for p in range(a, b - 199):
                seen.setdefault(data[p : p + 200].tobytes(), []).append(p)
        want = sorted(p for places in seen.values() if len(places) > 1 for p in places)
        assert suffix_dedup.repeated(data, first).tolist() == want


def repeating(seed):
    """Texts put together of a few units of 40 bytes and passages, so that chains end like others go on."""
    rng = random.Random(seed)
    some = lambda n: "".join(rng.choices("abc", k=n))
    units, shared = [some(40) for _ in range(2)], [some(rng.randint(40, 500)) for _ in range(3)]
    pick = lambda: rng.choice([rng.choice(shared), rng.choice(units) * rng.randint(1, 7), some(rng.randint(1, 100))])
    return ["".join(pick() for _ in range(rng.randint(2, 6))) for _ in range(8)]


def test_chains_that_end_flush_with_their_segment():
    for seed in range(40):
        parts = [np.frombuffer(t.encode(), np.uint8) for t in repeating(seed) if len(t) >= 200]
        data, first = np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        seen = {}
        for a, b in zip(first, first[1:]):
            for p in range(a, b - 199):
                seen.setdefault(data[p : p + 200].tobytes(), []).append(p)
        want = sorted(p for places in seen.values() if len(places) > 1 for p in places)
        assert suffix_dedup.repeated(data, first).tolist() == want


@pytest.mark.parametrize("hot", [recurring.HOT_BYTES, 1000])
def test_suffix_dedup_of_repeating_units(make_docs, hot):
    rows = list(enumerate(t for seed in range(100, 140) for t in repeating(seed)))
    compare(suffix_dedup.removal(make_docs(rows), hot), plain_bytes(rows), ["n_bytes", "n_removed", "n_spans", "kept_sha256"])


def test_equal_windows_have_equal_anchors():
    rng = random.Random(9)
    passage = "".join(rng.choices("abcd", k=260))
    texts = ["".join(rng.choices("abcd", k=rng.randint(0, 300))) + passage + "zz" for _ in range(9)]
    own = suffix_dedup.units_of(pa.array(texts, pa.string()))
    anchors = {}
    for text, a, b, anchor in zip(*recurring.segments(own, 200, 16)):
        for p in range(a - own.first[text], b - own.first[text] - 199):
            anchors.setdefault(texts[text][p : p + 200], set()).add(int(anchor))
    assert max(map(len, anchors.values())) == 1
    windows = sum(max(0, len(t) - 199) for t in texts)
    held = sum(b - a - 199 for _, a, b, _ in zip(*recurring.segments(own, 200, 16)))
    assert windows == held


@pytest.mark.parametrize("module", [suffix_dedup, phrases])
def test_anchors_are_looked_for_once_in_all_texts(make_docs, module, monkeypatch, tmp_path):
    """All texts are gone through once; only those with a shared anchor are gone through again."""
    rng = random.Random(7)
    words = lambda n: " ".join(f"{rng.randrange(10**9)}" for _ in range(n))
    line = words(80)
    texts = [words(120) for _ in range(20)] + [f"{words(9)} {line}", f"{line} {words(9)}"]
    note, real = str(tmp_path / "bytes"), recurring.segments

    def counted(units, width, grain):
        with open(note, "a") as file:
            file.write(f"{len(units.hashes)} ")
        return real(units, width, grain)

    monkeypatch.setattr(recurring, "segments", counted)
    done = module.removal(make_docs(list(enumerate(texts)))).collect()
    assert sum(r.n_removed > 0 for r in done) == (2 if module is suffix_dedup else 1)
    size = len if module is suffix_dedup else lambda t: len(t.split())
    seen = sum(map(int, open(note).read().split()))
    assert seen == sum(map(size, texts)) + sum(map(size, texts[-2:]))
