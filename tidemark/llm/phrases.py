"""Substring deduplication by repeated-phrase automata.

Every word covered by ``WIDTH`` words in a row that also start in a document with a smaller id is
removed.

``recurring`` deals the segments that can hold such words over tasks. A task confirms the windows
that stand in texts of different ids, by 128-bit hashes, with the least id of each; runs of
confirmed windows are the recurring passages. Their distinct texts are compiled into an
Aho-Corasick automaton (one a shard of ``CHUNK_BYTES``, which bounds its memory), and
every segment of every document dealt to the shard streams through it, which locates each
occurrence exactly. An occurrence's windows with a smaller least id are removed.

Texts are taken as words; a null text has none, a text of fewer words than ``WIDTH`` keeps all.
Equal ids are one document. A null id counts as larger than all others. Repeated rows are judged
alike. An empty table gives no rows. Only the id and text columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import recurring
from tidemark.llm.bpe import slices
from tidemark.llm.decontam import expand
from tidemark.llm.recurring import Units
from tidemark.llm.tables import kept
from tidemark.llm.words import BASE, SEPARATOR, mixed, prefix_hash, slice_hash, words

WIDTH = 50
CHUNK_BYTES = 4 << 20  # segments a shard, hence the size of its automaton
GRAIN = 8
LAST = np.iinfo(np.int64).max


def canonical(column: pa.Array) -> tuple[np.ndarray, np.ndarray, Units]:
    """(text, word starts, units): all words with one space after each."""
    found = words(column)
    length = found.ends - found.starts
    starts = np.concatenate([[0], np.cumsum(length + 1)])
    text = np.full(starts[-1], 0x20, np.uint8)
    text[expand(starts[:-1], length)] = found.data[~SEPARATOR[found.data]]
    return text, starts, Units(found.hashes, found.first, lambda i, j: text[starts[i] : starts[j] - 1].tobytes())


def units(batch: pa.RecordBatch) -> Units:
    return canonical(batch.column("text"))[2]


def locate(passages: list[bytes], text: bytes) -> Iterator[tuple[int, int]]:
    """(passage, end) of every occurrence; texts are bytes as characters, so lengths are bytes."""
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for k, passage in enumerate(passages):
        automaton.add_word(passage.decode("latin-1"), k)
    if passages:
        automaton.make_automaton()
        for end, k in automaton.iter(text.decode("latin-1")):
            yield k, end + 1


def kernel(table: pa.Table) -> Iterator[pa.RecordBatch]:
    """The runs of each segment that also start in documents with smaller ids."""
    text, starts, own = canonical(table["data"].combine_chunks())
    rep = table["rep"].fill_null(LAST).to_numpy()
    count = np.maximum(np.diff(own.first) - WIDTH + 1, 0)
    at, row = expand(own.first[:-1], count), np.repeat(np.arange(len(count)), count)
    pair = np.zeros(len(at), [("a", np.uint64), ("b", np.uint64)])
    pair["a"] = slice_hash(prefix_hash(own.hashes), at, at + WIDTH)
    pair["b"] = slice_hash(prefix_hash(mixed(own.hashes ^ BASE)), at, at + WIDTH)
    _, which = np.unique(pair, return_inverse=True)
    least, most = np.full(len(which), LAST), np.full(len(which), np.iinfo(np.int64).min)
    np.minimum.at(least, which, rep[row])
    np.maximum.at(most, which, rep[row])
    least, most = least[which], most[which]

    shared = np.flatnonzero(least < most)
    if not len(shared):
        return
    begins = np.ones(len(shared), bool)
    begins[1:] = (np.diff(at[shared]) != 1) | (row[shared[1:]] != row[shared[:-1]])
    b = np.flatnonzero(begins)
    passages: dict[bytes, np.ndarray] = {}
    for i, j in zip(shared[b], shared[np.append(b[1:], len(shared)) - 1]):
        passages.setdefault(text[starts[at[i]] : starts[at[j] + WIDTH]].tobytes(), least[i : j + 1])
    # a passage begins at a word: the space before it is part of the pattern
    names, leasts = [b" " + p for p in passages], list(passages.values())
    lengths = np.array([len(p) for p in names])
    hits = np.array(list(locate(names, b" " + text.tobytes())), np.int64).reshape(-1, 2)
    word = np.searchsorted(starts, hits[:, 1] - lengths[hits[:, 0]])
    segment = np.searchsorted(own.first, word, "right") - 1
    gone = np.zeros(len(own.hashes), bool)
    for k, w, s in zip(hits[:, 0].tolist(), word.tolist(), segment.tolist()):
        n = len(leasts[k])
        if w + n + WIDTH - 1 <= own.first[s + 1]:  # not across two segments
            gone[w : w + n] |= leasts[k] < rep[s]
    at = np.flatnonzero(gone)
    segment = np.searchsorted(own.first, at, "right") - 1
    rows, first = np.unique(segment, return_index=True)
    runs = [recurring.runs_of(x - own.first[r], WIDTH) for r, x in zip(rows, np.split(at, first[1:]))]
    yield recurring.found_rows(table, rows, runs)


def finish(text: bytes, starts: list[bytes], runs: list[bytes]) -> tuple[int, bytes]:
    """(removed words, the words that stay joined by one space)."""
    whole, at, own = canonical(pa.array([text], pa.binary()))
    gone = recurring.covered(starts, runs, len(own.hashes))
    stays = np.flatnonzero(~gone)
    return int(gone.sum()), whole[expand(at[stays], at[stays + 1] - at[stays])][:-1].tobytes()


def digest(text: bytes, starts: list[bytes], runs: list[bytes]) -> tuple[int, str]:
    n, stays = finish(text, starts, runs)
    return n, hashlib.sha256(stays).hexdigest()


def word_counts(docs: DataFrame) -> DataFrame:
    """(doc_id, sha, n_words, plain): words of each text and the digest of them joined by one space."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in rows:
            for batch in slices(whole, "text", recurring.BATCH_BYTES):
                own = units(batch)
                a, b = own.first[:-1].tolist(), own.first[1:].tolist()
                plain = [hashlib.sha256(own.cut(i, j) if j > i else b"").hexdigest() for i, j in zip(a, b)]
                yield pa.record_batch([batch.column("doc_id"), batch.column("sha"), pa.array(np.diff(own.first)), pa.array(plain)], ["doc_id", "sha", "n_words", "plain"])

    return docs.select("doc_id", "sha", "text").mapInArrow(run, "doc_id long, sha binary, n_words long, plain string")


def _found(docs: DataFrame, hot: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    marked, classes = recurring.with_classes(docs)
    anchors = recurring.anchors_of(marked, units, WIDTH, GRAIN)
    shared = recurring.shared_anchors(anchors, within=False)
    texts = recurring.candidate_texts(marked, classes, anchors, shared)
    cut = recurring.cut_segments(texts, units, WIDTH, GRAIN)
    earlier = F.coalesce(F.col("reps") < F.col("rep"), F.col("rep").isNull() & F.col("reps").isNotNull())
    found = recurring.judged(
        cut, kernel, lambda data: canonical(pa.array(data, pa.binary()))[2], WIDTH, earlier, hot, CHUNK_BYTES
    )
    return marked, classes, texts, found


def removal(docs: DataFrame, hot: int = recurring.HOT_BYTES) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every document."""
    marked, classes, texts, found = _found(docs, hot)
    done = kept(recurring.with_runs(texts, found, digest, "n_removed long, kept_sha256 string"), "removed")
    base = kept(word_counts(marked), "word-counts")
    by_class = kept(classes.select("sha", "rep").join(done, "sha", "left"), "class-results")
    copy = ~F.col("doc_id").eqNullSafe(F.col("rep")) & (F.col("n_words") >= WIDTH)
    return base.join(by_class, "sha").select(
        "doc_id",
        "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(copy, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("kept_sha256", "plain")).alias("kept_sha256"),
    )


def without_repeats(docs: DataFrame, hot: int = recurring.HOT_BYTES) -> DataFrame:
    """(doc_id, kept): the words of each document that stay, joined by one space where any went."""
    marked, classes, texts, found = _found(docs, hot)
    done = recurring.with_runs(texts, found, finish, "n_removed long, kept binary").select("sha", F.col("kept").cast("string").alias("kept"))
    base = marked.join(word_counts(marked).select("sha", "n_words").distinct(), "sha")
    by_class = classes.select("sha", "rep").join(done, "sha", "left")
    copy = ~F.col("doc_id").eqNullSafe(F.col("rep")) & (F.col("n_words") >= WIDTH)
    return base.join(by_class, "sha").select("doc_id", F.when(copy, F.lit("")).otherwise(F.coalesce("kept", "text")).alias("kept"))
