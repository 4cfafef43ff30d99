"""What finding recurring passages has in common, whether their units are bytes or words.

A window is ``width`` units in a row. Its anchor is the ``grain`` units within it that hash lowest
(the leftmost, of equal ones), so equal windows have equal anchors at the same offset. Windows in a
row with one anchor make a segment. Only segments whose anchor also occurs in another text (or
again in its own, if that counts) can hold a recurring window; they alone travel, each to the task
that owns its anchor, and equal windows always meet there.

Texts that are equal as a whole are one class, represented by the row with the least id: a large
group of copies is one text from the start. An anchor whose segments, over all texts and within one,
are more than ``HOT_BYTES`` is not gathered: its windows are compared by 128-bit hashes in an
aggregation that combines before its shuffle. What a task holds at a time is bounded by that and by
the size of a chunk.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bpe import slices
from tidemark.llm.tables import kept
from tidemark.llm.words import BASE, mixed, prefix_hash, slice_hash

HOT_BYTES = 2 << 20
BATCH_BYTES = 1 << 20
PLACE = np.uint64((1 << 32) - 1)  # the upper half of a hash ranks, the lower half tells where
SEGMENT = "anchor long, sha binary, rep long, times int, starts binary, data binary"
FOUND = "sha binary, starts binary, runs binary"


@dataclass
class Units:
    """The units of a batch of texts: a hash of each, and where each text's begin."""

    hashes: np.ndarray
    first: np.ndarray
    cut: Callable[[int, int], bytes]
    """The stored form of a run of units."""


def least_in_windows(values: np.ndarray, n: int) -> np.ndarray:
    """The least of each ``n`` values in a row."""
    span = 1
    while 2 * span <= n:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    rest = n - span
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def segments(units: Units, width: int, grain: int) -> tuple[np.ndarray, ...]:
    """(text, first unit, past the last unit, anchor) of each segment of a batch."""
    none = np.zeros(0, np.int64)
    if len(units.hashes) < width:
        return none, none, none, none.astype(np.uint64)
    running = prefix_hash(units.hashes)
    at = np.arange(len(units.hashes) - grain + 1)
    value = slice_hash(running, at, at + grain)
    ranked = (value & ~PLACE) | at.astype(np.uint64)
    place = (least_in_windows(ranked, width - grain + 1) & PLACE).astype(np.int64)
    n = np.diff(units.first)
    text = np.repeat(np.arange(len(n)), n)[: len(place)]
    inside = np.flatnonzero(np.arange(len(place)) + width <= units.first[1:][text])
    if not len(inside):
        return none, none, none, none.astype(np.uint64)
    text, place = text[inside], place[inside]
    begins = np.ones(len(inside), bool)
    begins[1:] = (place[1:] != place[:-1]) | (text[1:] != text[:-1])
    b = np.flatnonzero(begins)
    last = np.append(b[1:], len(inside)) - 1
    return text[b], inside[b], inside[last] + width, value[place[b]]


def batches_of(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in rows:
        yield from slices(whole, "text", BATCH_BYTES)


def anchors_of(docs: DataFrame, units: Callable, width: int, grain: int) -> DataFrame:
    """(anchor, owner, times): the anchors of each class of texts, and how often one text has them."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of(rows):
            text, _, _, anchor = segments(units(batch), width, grain)
            owner = batch.column("class").to_numpy()[text]
            # texts of one class are the same text, which has an anchor as often as any of them
            first_of = np.unique(owner, return_index=True)[1] if len(owner) else text
            one = np.isin(text, text[first_of])
            pair = np.zeros(one.sum(), [("anchor", np.int64), ("owner", np.int64)])
            pair["anchor"], pair["owner"] = anchor[one].view(np.int64), owner[one]
            pair, times = np.unique(pair, return_counts=True)
            yield pa.record_batch(
                [pa.array(np.ascontiguousarray(pair["anchor"])), pa.array(np.ascontiguousarray(pair["owner"])), pa.array(times)],
                ["anchor", "owner", "times"],
            )

    return kept(docs.select("text", "class").mapInArrow(run, "anchor long, owner long, times long"), "anchors")


def shared_anchors(anchors: DataFrame, within: bool) -> DataFrame:
    """(anchor): the anchors of more than one class of texts, or that one text has again."""
    found = anchors.groupBy("anchor").agg(
        F.min("owner").alias("low"), F.max("owner").alias("high"), F.max("times").alias("times")
    )
    several = (F.col("low") < F.col("high")) | (F.lit(within) & (F.col("times") > 1))
    return kept(found.where(several).select("anchor"), "shared-anchors")


def candidate_texts(docs: DataFrame, classes: DataFrame, anchors: DataFrame, shared: DataFrame) -> DataFrame:
    """(sha, rep, text, anchors): one row of each class that has a shared anchor."""
    has = anchors.select("anchor", F.col("owner").alias("class"))
    of_class = has.join(shared, "anchor").groupBy("class").agg(F.collect_set("anchor").alias("anchors"))
    wanted = classes.select("sha", "rep", "class").join(of_class, "class").drop("class")
    whole = docs.select("sha", "doc_id", "text").join(kept(wanted, "wanted"), "sha")
    mine = whole.where(F.col("doc_id").eqNullSafe(F.col("rep"))).select("sha", "rep", "text", "anchors")
    return kept(mine.dropDuplicates(["sha"]), "candidate-texts")


def cut_segments(texts: DataFrame, units: Callable, width: int, grain: int) -> DataFrame:
    """The segments of candidate texts at shared anchors; one row for what repeats within a text."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of(rows):
            own = units(batch)
            text, a, b, anchor = segments(own, width, grain)
            shared = np.unique(batch.column("anchors").flatten().to_numpy())
            use = np.isin(anchor.view(np.int64), shared)
            text, a, b, anchor = text[use], a[use], b[use], anchor[use]
            same = slice_hash(prefix_hash(own.hashes), a, b)
            order = np.lexsort((a, same, text))
            text, a, b, anchor, same = (x[order] for x in (text, a, b, anchor, same))
            new = np.ones(len(a), bool)
            new[1:] = (text[1:] != text[:-1]) | (same[1:] != same[:-1])
            at = np.flatnonzero(new)
            times = np.diff(np.append(at, len(a)))
            starts = (a - own.first[text]).astype("<i4")
            where = pa.array(text[at])
            yield pa.record_batch(
                [
                    pa.array(anchor[at].view(np.int64)), batch.column("sha").take(where), batch.column("rep").take(where), pa.array(times.astype(np.int32)),
                    pa.array([starts[i : i + k].tobytes() for i, k in zip(at, times)], pa.binary()),
                    pa.array([own.cut(i, j) for i, j in zip(a[at].tolist(), b[at].tolist())], pa.binary()),
                ],
                ["anchor", "sha", "rep", "times", "starts", "data"],
            )

    return texts.mapInArrow(run, SEGMENT)


def in_chunks(rows: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.Table]:
    """Whole anchors' rows of an anchor-sorted stream, ``most`` bytes of data or one anchor at a time."""
    held: list[pa.Table] = []
    size = 0
    for batch in rows:
        for part in slices(batch, "data", most):
            held.append(pa.Table.from_batches([part]))
            size += part.nbytes
            if size >= most:
                table = pa.concat_tables(held).combine_chunks()
                anchor = table["anchor"].to_numpy()
                whole = int(np.searchsorted(anchor, anchor[-1]))
                if whole:
                    yield table.slice(0, whole)
                    held, size = [table.slice(whole)], table.slice(whole).nbytes
    if held:
        yield pa.concat_tables(held).combine_chunks()


def runs_of(starts: np.ndarray, width: int) -> np.ndarray:
    """Sorted window starts as the runs of units they cover, (start, end) one after the other."""
    if not len(starts):
        return np.zeros(0, "<i4")
    gap = np.flatnonzero(np.diff(starts) > width)
    first, last = np.append(starts[:1], starts[gap + 1]), np.append(starts[gap], starts[-1:]) + width
    return np.column_stack([first, last]).astype("<i4").reshape(-1)


def found_rows(table: pa.Table, rows: np.ndarray, runs: list[np.ndarray]) -> pa.RecordBatch:
    where = pa.array(rows)
    return pa.record_batch(
        [table["sha"].combine_chunks().take(where), table["starts"].combine_chunks().take(where), pa.array([r.tobytes() for r in runs], pa.binary())],
        ["sha", "starts", "runs"],
    )


def judged(cut: DataFrame, kernel: Callable, hashed: Callable, width: int, recurs, hot: int, chunk: int) -> DataFrame:
    """(sha, starts, runs): what ``kernel`` finds anchor by anchor, and hot anchors by window hashes.

    ``kernel`` gets the segments of whole anchors, ``chunk`` bytes and one anchor at most, which
    bounds its memory: an anchor that is not hot has ``hot`` bytes at most, however many of them
    stand in one text.  ``recurs``: whether a window recurs, from its own ``rep`` and ``times`` and
    from ``reps`` (the least ``rep`` with it) and ``all`` (how often it stands).
    """
    parted = kept(cut.withColumn("size", F.octet_length("data").cast("long")), "segments")
    sizes = parted.groupBy("anchor").agg(F.sum("size").alias("size")).where(F.col("size") > hot)
    hot_anchors = kept(sizes.select("anchor"), "hot-anchors")
    parted = parted.drop("size")
    cold = parted.join(hot_anchors, "anchor", "left_anti")

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in in_chunks(rows, chunk):
            yield from kernel(table)

    by_anchor = cold.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(run, FOUND)

    def windows(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in rows:
            for batch in slices(whole, "data", BATCH_BYTES // 8):
                own = hashed(batch.column("data").to_pylist())
                n = np.diff(own.first) - width + 1
                at = np.repeat(own.first[:-1] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                row = np.repeat(np.arange(len(n)), n)
                h1 = slice_hash(prefix_hash(own.hashes), at, at + width)
                h2 = slice_hash(prefix_hash(mixed(own.hashes ^ BASE)), at, at + width)
                where = pa.array(row)
                columns = [batch.column(c).take(where) for c in ("sha", "starts", "rep", "times")]
                kinds = [pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64)), pa.array((at - own.first[row]).astype(np.int32))]
                yield pa.record_batch([*kinds, *columns], ["a", "b", "at", "sha", "starts", "rep", "times"])

    wide = kept(
        parted.join(hot_anchors, "anchor", "left_semi").mapInArrow(windows, "a long, b long, at int, sha binary, starts binary, rep long, times int"), "hot-windows"
    )
    least = kept(wide.groupBy("a", "b").agg(F.min("rep").alias("reps"), F.sum("times").alias("all")), "hot-counts")
    hits = wide.join(least, ["a", "b"]).where(recurs).groupBy("sha", "starts").agg(F.sort_array(F.collect_list("at")).alias("at"))

    def gather(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            runs = [runs_of(np.array(x), width) for x in batch.column("at").to_pylist()]
            yield pa.record_batch([batch.column("sha"), batch.column("starts"), pa.array([r.tobytes() for r in runs], pa.binary())], ["sha", "starts", "runs"])

    return by_anchor.unionByName(hits.mapInArrow(gather, FOUND))


def covered(starts: list[bytes], runs: list[bytes], n: int) -> np.ndarray:
    """Which of a text's units its found runs cover."""
    step = np.zeros(n + 1, np.int64)
    for s, r in zip(starts, runs):
        s, r = np.frombuffer(s, "<i4").astype(np.int64), np.frombuffer(r, "<i4").reshape(-1, 2)
        np.add.at(step, (s[:, None] + r[None, :, 0]).reshape(-1), 1)
        np.add.at(step, (s[:, None] + r[None, :, 1]).reshape(-1), -1)
    return np.cumsum(step[:-1]) > 0


def with_runs(texts: DataFrame, found: DataFrame, finish: Callable, schema: str) -> DataFrame:
    """``finish`` (text, starts, runs) for each candidate text that has runs; keyed by ``sha``."""
    lists = found.groupBy("sha").agg(F.collect_list("starts").alias("starts"), F.collect_list("runs").alias("runs"))

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of(rows):
            columns = (batch.column(c).to_pylist() for c in ("text", "starts", "runs"))
            done = [finish(t.encode(), s, r) for t, s, r in zip(*columns)]
            names = [x.split()[0] for x in schema.split(", ")]
            kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
            arrays = [pa.array(c, kinds[x.split()[1]]) for c, x in zip(zip(*done), schema.split(", "))]
            yield pa.record_batch([batch.column("sha"), *arrays], ["sha", *names])

    return texts.select("sha", "text").join(lists, "sha").mapInArrow(run, "sha binary, " + schema)


def with_classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents with the digest of their text and a hash of it, and the classes of equal texts."""
    marked = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("sha", F.unhex(F.sha2("text", 256)))
    marked = marked.withColumn("class", F.xxhash64("sha"))
    groups = marked.groupBy("sha", "class").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    return marked, kept(groups, "text-classes")
