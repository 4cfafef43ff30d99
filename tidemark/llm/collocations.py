"""Phrase collocations by relational mining of sorted occurrences.

The occurrence relation of one word has, for every piece of text, the words in their order. Level
by level a relation of longer phrases is made from the one before: occurrences are merge-joined
with their right neighbours in the same piece, the joined groups are counted, groups with fewer
than ``LEAST`` occurrences are dropped, and the rest, by a semi-join, are the occurrences that the
next level extends. Two phrases of k words that overlap in k - 1 make one of k + 1, so every level
joins adjacent places of one relation.

Relations are persisted sorted, in buckets, a chunk of some ``CHUNK_BYTES`` of whole texts a row:
neighbours are neighbours in the row, so the merge-join is a shift. Groups are counted in each
chunk before they are shuffled. The groups that stay come back to their chunks by a cogroup that
reads the relation by its buckets, without shuffling it; a task holds one chunk at a time. Words and
phrases are numbered densely, so a group is a pair of numbers at every length, and counts are exact.

A phrase's score is that of its weakest cut into two parts, floor(10^6 a^2 / (l r)), in decimal
arithmetic. Phrases that lie mostly within one longer phrase are dropped: one longer by a word is
enough to look at, as every longer one has it in between with at least as many occurrences.

Text: A-Z are lower-cased; pieces end at ``PIECE_ENDS``, words at space and tab. Nulls: a null text
has no words, a null lang is ``und``, ids are not used. Repeated rows count each. Ties rank by
phrase, in UTF-8 byte order. An empty table gives no rows. Only text and lang are read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark import session
from tidemark.llm.bpe import slices
from tidemark.llm.decontam import expand
from tidemark.llm.tables import kept
from tidemark.llm.words import mixed, words
from tidemark.sources import folders

LONGEST = 3
LEAST = 10
COVERED = 50  # percent of a phrase's occurrences within one longer phrase
TOP = 2000
CHUNK_BYTES = 4 << 20
BATCH_BYTES = 1 << 20
SALTS = 64
PIECE_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
UNKNOWN = "und"
PIECE = np.zeros(256, bool)
PIECE[list(PIECE_ENDS)] = True
GAP = PIECE.copy()
GAP[[0x20, 0x09]] = True
LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[65:91] += 32
COUNTS = "chunk long, seq binary, place long, lang string, word string, f long"
GROUPS = "chunk long, left long, right long, f long"


class Relation:
    """Occurrences persisted in buckets of chunks, sorted by them."""

    def __init__(self, df: DataFrame, name: str):
        self.spark = df.sparkSession
        self.path, self.name = session.scratch_path(self.spark, name), f"tidemark_{name}_{uuid.uuid4().hex}"
        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        writer = df.write.bucketBy(buckets, "chunk").sortBy("chunk").option("path", self.path)
        writer.option("compression", "zstd").format("parquet").saveAsTable(self.name)

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def drop(self) -> None:
        """Give the relation's folder back; the next one has been stored."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        folders.delete(self.spark, self.path)


class Chunk:
    """Texts gathered in one task until they fill a chunk."""

    def __init__(self):
        self.parts, self.langs, self.size = [], {}, 0

    def add(self, batch: pa.RecordBatch) -> None:
        found = words(batch.column("text"), lower=True, break_at=GAP)
        text = found.text_of()
        fresh = np.ones(len(text), bool)
        piece = np.cumsum(PIECE[found.data], dtype=np.int32)[found.starts]
        fresh[1:] = (piece[1:] != piece[:-1]) | (text[1:] != text[:-1])
        of_row = np.array([self.langs.setdefault(x, len(self.langs)) for x in batch.column("lang").to_pylist()], np.int64)
        lang = of_row[text].astype(np.int32)
        hashes = mixed(found.hashes ^ mixed(lang.astype(np.uint64) + np.uint64(1)))
        self.parts.append((LOWERED[found.data], found.starts + self.size, found.ends - found.starts, hashes, lang, fresh))
        self.size += len(found.data)

    def emit(self, number: int) -> Iterator[pa.RecordBatch]:
        """The chunk's occurrences as one row, then one row for each of its words."""
        data, starts, lengths, hashes, lang, fresh = (np.concatenate(x) for x in zip(*self.parts))
        if not len(starts):
            return
        _, first, which, f = np.unique(hashes, return_index=True, return_inverse=True, return_counts=True)
        seq = np.where(fresh, -1 - which, 1 + which)
        names = [x.split()[0] for x in COUNTS.split(", ")]
        kinds = [pa.int64(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        yield pa.record_batch([pa.array([v], k) for v, k in zip((number, seq.tobytes(), None, None, None, None), kinds)], names)
        length = lengths[first]
        ends = np.append(0, np.cumsum(length)).astype(np.int32)
        text = pa.StringArray.from_buffers(len(first), pa.py_buffer(ends), pa.py_buffer(data[expand(starts[first], length)]))
        langs = pa.array(list(self.langs), pa.string()).take(pa.array(lang[first]))
        chunk = pa.array(np.full(len(first), number))
        empty = pa.nulls(len(first), pa.binary())
        yield pa.record_batch([chunk, empty, pa.array(np.arange(len(first)) + 1), langs, text, pa.array(f.astype(np.int64))], names)


def occurrences(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The words of all texts by chunk: its occurrences (``seq``), and a row for each word it has.

    ``seq`` holds, place by place, the number that the word has in its chunk, negative where a
    piece begins.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, chunk = TaskContext.get().partitionId() << 32, Chunk()
        for whole in batches:
            for batch in slices(whole, "text", min(BATCH_BYTES, chunk_bytes)):
                chunk.add(batch)
                if chunk.size >= chunk_bytes:
                    yield from chunk.emit(number)
                    number, chunk = number + 1, Chunk()
        if chunk.parts:
            yield from chunk.emit(number)

    texts = docs.select(F.coalesce("text", F.lit("")).alias("text"), F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"))
    return texts.mapInArrow(run, COUNTS)


def neighbours(seq: np.ndarray) -> np.ndarray:
    """The places whose group and its right neighbour's stand in one piece."""
    return np.flatnonzero((seq[:-1] != 0) & (seq[1:] > 0))


def joined(relation: DataFrame) -> DataFrame:
    """(chunk, left, right, f): adjacent groups of a relation, counted in each chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, data in zip(batch.column("chunk").to_pylist(), batch.column("seq")):
                seq = np.frombuffer(data.as_buffer(), np.int64)
                at = neighbours(seq)
                ids, local = np.unique(np.abs(seq), return_inverse=True)
                pair, f = np.unique(local[at] * len(ids) + local[at + 1], return_counts=True)
                left, right = np.divmod(pair, max(1, len(ids)))
                columns = [pa.array(np.full(len(pair), chunk)), pa.array(ids[left]), pa.array(ids[right]), pa.array(f.astype(np.int64))]
                for part in pa.Table.from_arrays(columns, ["chunk", "left", "right", "f"]).to_batches(1 << 18):
                    yield part

    return relation.select("chunk", "seq").mapInArrow(run, GROUPS)


def frequent(counts: DataFrame, keys: list[str], least: int) -> DataFrame:
    """The rows of groups with ``least`` occurrences in all: with the total and a dense number (``id``)."""
    total = F.sum("f").over(Window.partitionBy(*keys))
    rows = counts.withColumn("total", total).where(F.col("total") >= least).drop("f")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, last, rank = TaskContext.get().partitionId(), None, -1
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            new = np.zeros(n, bool)
            columns = [batch.column(k) for k in keys]
            for c in columns:
                new[1:] |= pc.not_equal(c.slice(1), c.slice(0, n - 1)).to_numpy(zero_copy_only=False)
            new[0] = [c[0].as_py() for c in columns] != last
            last = [c[n - 1].as_py() for c in columns]
            ranks = rank + np.cumsum(new)
            rank = int(ranks[-1])
            more = [pa.array(np.full(n, task, np.int32)), pa.array(ranks)]
            yield pa.record_batch([*batch.columns, *more], [*batch.schema.names, "task", "rank"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    ranked = kept(rows.sortWithinPartitions(*keys).mapInArrow(run, f"{schema}, task int, rank long"), "frequent")
    sizes = ranked.groupBy("task").agg(F.max("rank").alias("most")).orderBy("task").collect()  # one row a task
    before, at = [1], 1
    for row in sizes:
        before += [at] * (row["task"] + 1 - len(before))
        before[row["task"]], at = at, at + row["most"] + 1
    first = F.get(F.array(*[F.lit(x).cast("long") for x in before]), F.col("task"))
    return ranked.withColumn("id", first + F.col("rank")).drop("task", "rank")


def renamed(seq: np.ndarray, groups: pa.Table) -> np.ndarray:
    """Places by the numbers of their words; 0 for a word that is not frequent."""
    number = np.zeros(int(np.abs(seq).max(initial=0)) + 1, np.int64)
    number[groups["place"].to_numpy()] = groups["id"].to_numpy()
    return np.where(seq < 0, -1, 1) * number[np.abs(seq)]


def extended(seq: np.ndarray, groups: pa.Table) -> np.ndarray:
    """Places by the number of the longer group that begins there; 0 where none is frequent."""
    at = neighbours(seq)
    ids, local = np.unique(np.abs(seq), return_inverse=True)
    of = lambda name: np.searchsorted(ids, groups[name].to_numpy())
    known = of("left") * len(ids) + of("right")
    order = np.argsort(known)
    known, number = known[order], groups["id"].to_numpy()[order]
    mine = local[at] * len(ids) + local[at + 1]
    place = np.minimum(np.searchsorted(known, mine), len(known) - 1)
    hit = known[place] == mine
    out = np.zeros(len(seq), np.int64)
    out[at[hit]] = number[place[hit]]
    return out


def semi_joined(relation: DataFrame, groups: DataFrame, change) -> DataFrame:
    """(chunk, seq): the relation with only the occurrences of ``groups``, by their numbers.

    Both sides meet by chunk, sorted; the relation is not shuffled.
    """

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["chunk", "seq"]
        if not len(left) or not len(right):
            return pa.table([pa.array([], pa.int64()), pa.array([], pa.binary())], names)
        seq = np.frombuffer(left["seq"][0].as_buffer(), np.int64)
        return pa.table([left["chunk"].slice(0, 1), pa.array([change(seq, right.combine_chunks()).tobytes()], pa.binary())], names)

    sides = relation.select("chunk", "seq").groupBy("chunk").cogroup(groups.groupBy("chunk"))
    return sides.applyInArrow(run, "chunk long, seq binary")


def _score(a, left, right):
    exact = lambda c: c.cast("decimal(14,0)")
    return F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * exact(a) * exact(a), exact(left) * exact(right))


def levels(docs: DataFrame, longest: int, least: int, chunk_bytes: int) -> tuple[DataFrame, list[DataFrame]]:
    """(words by lang, [level 1, level 2, ...]): a level's frequent groups, stored.

    Level 1: (id, lang, word, a); further ones: (id, left, right, a) with numbers of the level before.
    """
    found = Relation(occurrences(docs, chunk_bytes), "occurrences")
    counted = found.rows().where("seq is null").select("chunk", "place", "lang", "word", "f")
    words_by_lang = kept(counted.groupBy("lang").agg(F.sum("f").alias("n")), "words-by-lang")
    groups = frequent(counted, ["lang", "word"], least)
    out = [kept(groups.groupBy("id", "lang", "word").agg(F.max("total").alias("a")), "level")]
    relation, change, key = found.rows().where("seq is not null"), renamed, ["place"]
    for length in range(2, longest + 1):
        shorter = Relation(semi_joined(relation, groups.select("chunk", *key, "id"), change), "occurrences")
        found.drop()
        found = shorter
        pairs, key = joined(found.rows()), ["left", "right"]
        if length < longest:
            groups = frequent(pairs, key, least)
            out.append(kept(groups.groupBy("id", *key).agg(F.max("total").alias("a")), "level"))
            relation, change = found.rows(), extended
        else:  # nothing extends the longest ones: they need no chunk and no number
            last = pairs.groupBy(*key).agg(F.sum("f").alias("a")).where(F.col("a") >= least)
            out.append(kept(last.withColumn("id", F.lit(None).cast("long")), "level"))
    found.drop()
    return words_by_lang, out


def collocations(
    docs: DataFrame, longest: int = LONGEST, least: int = LEAST, covered: int = COVERED, top: int = TOP,
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``top`` phrases of 2 to ``longest`` words."""
    words_by_lang, found = levels(docs, longest, least, chunk_bytes)
    one = F.array("a")
    shorter = found[0].select("id", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"), one.alias("heads"), one.alias("tails"))
    candidates = []
    for k, level in enumerate(found[1:], start=2):
        x = shorter.select(F.col("id").alias("left"), "lang", F.col("phrase").alias("head"), "heads")
        y = shorter.select(F.col("id").alias("right"), "last", "tails")
        both = level.join(x, "left").join(y, "right").select(
            "id", "lang", F.concat("head", F.lit(" "), "last").alias("phrase"), "last", "a",
            F.concat("heads", one).alias("heads"), F.concat("tails", one).alias("tails"),
        )
        shorter = kept(both, "phrases")
        cuts = []
        for cut in range(1, k):
            l, r = F.get("heads", F.lit(cut - 1)), F.get("tails", F.lit(k - cut - 1))  # noqa: E741
            cuts.append(F.struct(_score(F.col("a"), l, r).alias("score"), F.lit(cut).alias("cut"), l.alias("l"), r.alias("r")))
        rows = shorter.withColumn("weakest", F.array_min(F.array(*cuts)))
        if k < longest:
            longer = found[k]
            within = longer.select(F.col("left").alias("id"), F.col("a").alias("most")).unionByName(
                longer.select(F.col("right").alias("id"), F.col("a").alias("most"))
            ).groupBy("id").agg(F.max("most").alias("most"))
            rows = rows.join(within, "id", "left").where(100 * F.coalesce("most", F.lit(0)) < covered * F.col("a"))
        candidates.append(rows.select("lang", "phrase", "a", "weakest.l", "weakest.r", "weakest.score"))
    every = candidates[0]
    for more in candidates[1:]:
        every = every.unionByName(more)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # a language may hold most phrases: its first ones are chosen within parts of it before
    part = Window.partitionBy("lang", "part").orderBy(*order)
    parts = every.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    first = parts.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= top).drop("part")
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.where(F.col("rank") <= top).join(words_by_lang, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
