"""Suffix-array deduplication by merging Burrows-Wheeler transforms.

Every byte covered by a ``WIDTH``-byte string that also starts anywhere else is removed.

``recurring`` deals the segments that can hold such a string over tasks. A task parts its
segments into shards and sorts each shard's suffixes once, to a depth of ``WIDTH`` bytes, giving
the shard's transform over ``SYMBOL``-byte symbols: the symbol before each suffix, in suffix order
(a segment's suffixes ``SYMBOL`` bytes apart are one cyclic chain, along which both sorting and
merging go).
The shards' transforms are then merged by iterative interleave refinement: the interleave says
which shard each merged row comes from, and one step deals its rows stably by the symbols before
them. After h steps rows stand in order of their first h symbols, no suffix having been sorted
again. Rows whose symbols or former intervals differ part at step h, so each row's common prefix
with the one before it is known to a symbol; intervals left whole after all steps are the repeated
strings. A second hash of their bytes confirms each row of an interval.

Texts are UTF-8 bytes, null as empty; a text under ``WIDTH`` bytes keeps all. Repeated rows and
rows with equal texts are other places, so of two equal long texts nothing stays. Null ids are
kept. An empty table gives no rows. Only the id and text columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import recurring
from tidemark.llm.recurring import Units
from tidemark.llm.tables import kept
from tidemark.llm.words import BASE, BYTE, mixed, prefix_hash, raw, slice_hash

WIDTH = 200
GRAIN = 40  # shorter ones recur by chance and send texts without a repeated string
SYMBOL = 40
STEPS = WIDTH // SYMBOL
SHARD_BYTES = 1 << 18
CHUNK_BYTES = 1 << 20  # a task holds some 150 bytes for each of them


def units(batch: pa.RecordBatch) -> Units:
    return units_of(batch.column("text"))


def units_of(column: pa.Array) -> Units:
    data, offsets = raw(column)
    return Units(BYTE[data], offsets, lambda i, j: data[i:j].tobytes())


def stable_order(codes: np.ndarray) -> np.ndarray:
    """A stable sorting order of 32-bit codes, by their halves."""
    order = np.argsort((codes & np.uint32(0xFFFF)).astype(np.uint16), kind="stable")
    if len(codes) and codes.max() > 0xFFFF:
        order = order[np.argsort((codes >> np.uint32(16)).astype(np.uint16)[order], kind="stable")]
    return order


def symbols(running: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes, before, after) of every place: its symbol's rank, the places a symbol away.

    The last places of a segment have no whole symbol and get one of their own; the place before a
    chain's first is its last. Whether the last has a whole symbol (where a chain ends flush with
    its segment) or not, sorting follows the same chains.
    """
    n = len(running) - 1
    at = np.arange(n)
    length = np.diff(first)
    begin, end = np.repeat(first[:-1], length), np.repeat(first[1:], length)
    whole = at + SYMBOL <= end
    code = np.zeros(n, np.uint32)
    names, code[whole] = np.unique(slice_hash(running, at[whole], at[whole] + SYMBOL), return_inverse=True)
    code[~whole] = len(names) + np.arange((~whole).sum())
    back = at - SYMBOL
    left = back < begin
    back[left] = (at + (end - 1 - at) // SYMBOL * SYMBOL)[left]
    return code, back, end


def along(code: np.ndarray, back: np.ndarray) -> list[np.ndarray]:
    """The first to the ``STEPS``-th symbol from every place on, along its chain."""
    after = np.empty_like(back)
    after[back] = np.arange(len(back))
    out = [code]
    for _ in range(STEPS - 1):
        out.append(out[-1][after])
    return out


def transform(ahead: list[np.ndarray], places: np.ndarray) -> np.ndarray:
    """A shard's places in order of the ``STEPS`` symbols from each on."""
    order = places
    for code in reversed(ahead):
        order = order[stable_order(code[order])]
    return order


def merge(transforms: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(interleave, intervals): the shard of each merged row and its interval's number.

    Refined ``STEPS`` times; two rows share an interval if their first ``STEPS`` symbols are equal.
    """
    sizes = [len(t) for t in transforms]
    shard = np.repeat(np.arange(len(sizes)), sizes)
    interval = np.zeros(len(shard), np.int64)
    for _ in range(STEPS):
        before = np.empty(len(shard), np.uint32)
        for z, t in enumerate(transforms):
            before[shard == z] = t
        order = stable_order(before)
        before, shard, interval = before[order], shard[order], interval[order]
        parts = np.ones(len(shard), bool)
        parts[1:] = (before[1:] != before[:-1]) | (interval[1:] != interval[:-1])
        interval = np.cumsum(parts)
    return shard, interval


def repeated(data: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The places whose ``WIDTH`` bytes, all within their segment, stand at another place too."""
    running = prefix_hash(BYTE[data])
    code, back, end = symbols(running, first)
    bounds = np.searchsorted(first, np.arange(SHARD_BYTES, len(data) + SHARD_BYTES, SHARD_BYTES))
    bounds = np.unique(np.append(0, np.minimum(bounds, len(first) - 1)))
    ahead = along(code, back)
    orders = [transform(ahead, np.arange(first[a], first[b])) for a, b in zip(bounds, bounds[1:])]
    del ahead
    shard, interval = merge([code[back[order]] for order in orders])
    merged = np.empty(len(data), np.int64)
    for z, order in enumerate(orders):
        merged[shard == z] = order
    size = np.bincount(interval)
    several = (size[interval] > 1) & (merged + WIDTH <= end[merged])
    at, interval = merged[several], interval[several]
    other = slice_hash(prefix_hash(mixed(BYTE[data] ^ BASE)), at, at + WIDTH)
    _, which, times = np.unique(np.column_stack([interval.astype(np.uint64), other]), axis=0, return_inverse=True, return_counts=True) if len(at) else (0, at, at)
    return np.sort(at[times[which] > 1])


def kernel(table: pa.Table) -> Iterator[pa.RecordBatch]:
    """The repeated runs of each segment; equal segments go through once."""
    data, first = raw(table["data"].combine_chunks())
    same = slice_hash(prefix_hash(BYTE[data]), first[:-1], first[1:])
    _, one, which = np.unique(same, return_index=True, return_inverse=True)
    times = np.bincount(which, weights=table["times"].to_numpy(), minlength=len(one))
    length = np.diff(first)[one]
    starts = np.concatenate([[0], np.cumsum(length)])
    bytes_at = np.repeat(first[one] - starts[:-1], length) + np.arange(starts[-1])
    places = repeated(data[bytes_at], starts)
    ends = np.searchsorted(places, starts)
    runs = []
    for k in range(len(one)):
        own = places[ends[k] : ends[k + 1]] - starts[k]
        runs.append(np.array([0, length[k]], "<i4") if times[k] > 1 else recurring.runs_of(own, WIDTH))
    rows = np.flatnonzero(np.array([len(r) for r in runs])[which] > 0)
    yield recurring.found_rows(table, rows, [runs[w] for w in which[rows]])


def finish(text: bytes, starts: list[bytes], runs: list[bytes]) -> tuple[int, int, bytes]:
    """(removed, spans, what stays) of a text."""
    data = np.frombuffer(text, np.uint8)
    gone = recurring.covered(starts, runs, len(data))
    return int(gone.sum()), int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum()), data[~gone].tobytes()


def digest(text: bytes, starts: list[bytes], runs: list[bytes]) -> tuple[int, int, str]:
    n, spans, stays = finish(text, starts, runs)
    return n, spans, hashlib.sha256(stays).hexdigest()


def _found(docs: DataFrame, hot: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    marked, classes = recurring.with_classes(docs)
    anchors = recurring.anchors_of(marked, units, WIDTH, GRAIN)
    shared = recurring.shared_anchors(anchors, within=True)
    texts = recurring.candidate_texts(marked, classes, anchors, shared)
    cut = recurring.cut_segments(texts, units, WIDTH, GRAIN)
    found = recurring.judged(
        cut, kernel, lambda data: units_of(pa.array(data, pa.binary())), WIDTH, F.col("all") > 1, hot, CHUNK_BYTES
    )
    return marked, classes, texts, found


def removal(docs: DataFrame, hot: int = recurring.HOT_BYTES) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every document."""
    marked, classes, texts, found = _found(docs, hot)
    done = kept(recurring.with_runs(texts, found, digest, "n_removed long, n_spans long, kept_sha256 string"), "removed")
    base = kept(marked.select("doc_id", "sha", F.octet_length("text").cast("long").alias("n_bytes")), "sizes")
    by_class = kept(classes.select("sha", "copies").join(done, "sha", "left"), "class-results")
    gone = (F.col("copies") > 1) & (F.col("n_bytes") >= WIDTH)
    return base.join(by_class, "sha").select(
        "doc_id",
        "n_bytes",
        F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(gone, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(gone, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("kept_sha256", F.lower(F.hex("sha")))).alias("kept_sha256"),
    )


def without_repeats(docs: DataFrame, hot: int = recurring.HOT_BYTES) -> DataFrame:
    """(doc_id, kept): the bytes of each document that stay."""
    marked, classes, texts, found = _found(docs, hot)
    done = recurring.with_runs(texts, found, finish, "n_removed long, n_spans long, kept binary").select("sha", "kept")
    by_class = classes.select("sha", "copies").join(done, "sha", "left")
    gone = (F.col("copies") > 1) & (F.octet_length("text") >= WIDTH)
    stays = F.when(gone, F.lit("").cast("binary")).otherwise(F.coalesce("kept", F.col("text").cast("binary")))
    return marked.join(by_class, "sha").select("doc_id", stays.alias("kept"))
