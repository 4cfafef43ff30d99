"""Benchmark decontamination: a BM25 index of test items, queried by every training passage.

Passages are windows of ``2 * STRIDE`` words every ``STRIDE`` words, so any ``STRIDE`` words in a
row lie in one passage whole. A posting's impact is its BM25 share divided by the least score that
``STRIDE`` words of its item in a row have (the whole item's, if shorter): a passage with a copy
of that many words scores 1 or more, and ``THRESHOLD`` means the same for every item.

Retrieval is block-max WAND on whole batches of passages. Items stand in blocks; each term has its
largest impact per block. Terms that, taken together, can't lift any block over half the threshold
are not essential and skipped at first. A block whose bounds (those of the essential terms in the
passage, and what the others could add) stay under the threshold is passed over; only the items of
the other blocks are scored, with all terms. Nothing over the threshold is missed.

A copy of the question alone, or one in pieces, may score under the threshold. So the question's
rarest shingles are indexed as well, as many as can't all be missing when ``OVERLAP`` is reached:
a pair with one of them is verified too, and reported with its best passage's score.

A retrieved pair is verified on the whole document: ``OVERLAP`` of the question's five-word
shingles must occur in it. The answer's share is reported, and ``full`` tells whether it reaches
``OVERLAP`` as well. Either way the item's question is known to the document.

The index is broadcast, ``SHARD_WORDS`` words at a time at most: more test items than that are
dealt over shards by hash, each with statistics of its own, and the documents pass each shard.

Nulls: null or wordless items match nothing; a null text is empty. Repeated rows are judged each;
repeated item ids are items of their own. Without items or documents there are no rows. Words are
runs of ASCII letters, digits and all characters beyond ASCII, with A-Z lower-cased. Only the
named columns are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import worker
from tidemark.llm.bpe import slices
from tidemark.llm.tables import kept
from tidemark.llm.words import Words, mixed, words

STRIDE = 64
THRESHOLD = 0.5
OVERLAP = 0.8
SHINGLE = 5
BLOCK = 8
SHARD_WORDS = 2_000_000
BATCH_BYTES = 2 << 20
K1, B = 1.2, 0.75
STEP = np.uint64(0xA0761D6478BD642F)
HITS = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"

#: What parts words: all of ASCII but letters and digits.
BREAK = np.ones(256, bool)
BREAK[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def split_item(text: str | None) -> tuple[str, str]:
    """(question, answer) of an item: its last sentence is the answer, if a question remains."""
    text = text or ""
    parts = re.match(r"(?s)(.*[.?!\n])\s*(\S.*)$", text.rstrip().rstrip(".?!"))
    if parts and len(parts[1].split()) >= 2 * SHINGLE:
        return parts[1], parts[2]
    return text, ""


def expand(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of each range, one after the other."""
    before = np.cumsum(counts) - counts
    return np.repeat(starts - before, counts) + np.arange(counts.sum())


def grams(hashes: np.ndarray, size: int) -> np.ndarray:
    """The hash of each run of ``size`` words."""
    n = max(0, len(hashes) - size + 1)
    out = np.zeros(n, np.uint64)
    for j in range(size):
        out = mixed(out * STEP + hashes[j : j + n] + np.uint64(j + 1))
    return out


def fingerprint(hashes: np.ndarray) -> tuple[int, np.ndarray]:
    """(size, distinct shingles) of a part of an item; a part of fewer words is one shingle."""
    size = min(SHINGLE, len(hashes))
    return size, np.unique(grams(hashes, size)) if size else hashes


class Shingles:
    """A document's shingles, worked out once for each size that is asked for."""

    def __init__(self, hashes: np.ndarray):
        self.hashes, self.known = hashes, {}

    def share(self, part: tuple[int, np.ndarray]) -> float:
        """How much of an item's part occurs among the document's words."""
        size, wanted = part
        if not size:
            return 0.0
        if size not in self.known:
            self.known[size] = np.unique(grams(self.hashes, size))
        own = self.known[size]
        if not len(own):
            return 0.0
        return float((own[np.minimum(np.searchsorted(own, wanted), len(own) - 1)] == wanted).mean())


@dataclass
class Index:
    """Postings by term, sorted by item, and their block maxima."""

    items: np.ndarray
    terms: np.ndarray
    first: np.ndarray
    item: np.ndarray
    impact: np.ndarray
    block_first: np.ndarray
    block: np.ndarray
    block_max: np.ndarray
    essential: np.ndarray
    rest: np.ndarray
    """What the terms that are not essential can add to each block."""
    question: list[tuple[int, np.ndarray]]
    answer: list[tuple[int, np.ndarray]]
    keys: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]
    """By shingle size: shingles of which a known question has one at least, and their items."""


def question_keys(parts: list[tuple[int, np.ndarray]]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(shingles, first places, items) by size: each question's rarest, one more than it can lack."""
    out = {}
    for size in {part[0] for part in parts} - {0}:
        own = [k for k, part in enumerate(parts) if part[0] == size]
        names, df = np.unique(np.concatenate([parts[k][1] for k in own]), return_counts=True)
        chosen = []
        for k in own:
            at = np.searchsorted(names, parts[k][1])
            least = int(np.argmax(np.arange(len(at) + 1) / len(at) >= OVERLAP))
            chosen.append(at[np.argsort(df[at], kind="stable")[: len(at) - least + 1]])
        key, item = np.concatenate(chosen), np.repeat(own, [len(c) for c in chosen])
        order = np.argsort(key, kind="stable")
        used, first = np.unique(key[order], return_index=True)
        out[size] = names[used], np.append(first, len(key)), item[order]
    return out


@dataclass
class Statistics:
    """What scores need to know of all items, whichever of them an index holds."""

    n: int
    length: float
    """Words of an item that has any, on average."""
    terms: np.ndarray
    df: np.ndarray


def build(
    items: list[tuple[int | None, str, str]], threshold: float = THRESHOLD, statistics: Statistics | None = None
) -> Index | None:
    """An index of (item id, question, answer); without ``statistics`` they are all there are."""
    whole = words(pa.array([f"{q or ''}\n{a or ''}" for _, q, a in items], pa.string()), True, BREAK)
    some = np.flatnonzero(np.diff(whole.first) > 0)
    if not len(some):
        return None
    text = whole.text_of()
    terms, term = np.unique(whole.hashes, return_inverse=True)
    pair, tf = np.unique(term * len(items) + text, return_counts=True)
    term, item = pair // len(items), pair % len(items)
    length = np.diff(whole.first)
    df = np.bincount(term, minlength=len(terms))
    every = statistics or Statistics(len(some), float(length[some].mean()), terms, df)
    of_all = every.df[np.searchsorted(every.terms, terms)]
    idf = np.log1p((every.n - of_all + 0.5) / (of_all + 0.5))
    impact = idf[term] * tf * (1 + K1) / (tf + K1 * (1 - B + B * length[item] / every.length))
    least = np.ones(len(items))
    of_word = np.searchsorted(terms, whole.hashes)
    for k in some:
        own = of_word[whole.first[k] : whole.first[k + 1]]
        value = impact[np.searchsorted(pair, own * len(items) + k)]
        sums = []
        for a in range(max(1, len(own) - STRIDE + 1)):
            _, at = np.unique(own[a : a + STRIDE], return_index=True)
            sums.append(value[a : a + STRIDE][at].sum())
        least[k] = min(sums)
    impact = impact / least[item]
    blocks, inverse = np.unique(term * (len(items) // BLOCK + 1) + item // BLOCK, return_inverse=True)
    block_max = np.zeros(len(blocks))
    np.maximum.at(block_max, inverse, impact)
    block_term, block = blocks // (len(items) // BLOCK + 1), blocks % (len(items) // BLOCK + 1)
    block_first = np.searchsorted(block_term, np.arange(len(terms) + 1))
    rest, essential = np.zeros(len(items) // BLOCK + 1), np.ones(len(terms), bool)
    for t in np.argsort(-df, kind="stable"):
        own = slice(block_first[t], block_first[t + 1])
        if df[t] < 2 or len(block[own]) < 2:
            break
        if (rest[block[own]] + block_max[own] <= threshold / 2).all():
            rest[block[own]] += block_max[own]
            essential[t] = False
    parts = []
    for k in (1, 2):
        part = words(pa.array([i[k] or "" for i in items], pa.string()), True, BREAK)
        parts.append([fingerprint(part.hashes[a:b]) for a, b in zip(part.first, part.first[1:])])
    ids = np.array([-1 if i[0] is None else i[0] for i in items], np.int64)
    first = np.searchsorted(term, np.arange(len(terms) + 1))
    return Index(ids, terms, first, item, impact, block_first, block, block_max, essential, rest, *parts, question_keys(parts[0]))


def _sum_by(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    names, where = np.unique(keys, return_inverse=True)
    return names, np.bincount(where, weights=values, minlength=len(names))


def retrieve(index: Index, found: Words, threshold: float = THRESHOLD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, item number, best score) of all pairs with a passage over the threshold."""
    n = np.diff(found.first)
    passages = np.maximum(1, -(-(n - STRIDE) // STRIDE))
    begin = np.concatenate([[0], np.cumsum(passages)])
    at = np.minimum(np.searchsorted(index.terms, found.hashes), len(index.terms) - 1)
    hit = np.flatnonzero(index.terms[at] == found.hashes)
    text = found.text_of()[hit]
    slot = (hit - found.first[text]) // STRIDE
    keys = []
    for back in (0, 1):
        inside = (slot >= back) & (slot - back < passages[text])
        keys.append((begin[text] + slot - back)[inside] * len(index.terms) + at[hit][inside])
    pairs = np.unique(np.concatenate(keys))
    passage, term = pairs // len(index.terms), pairs % len(index.terms)

    use = index.essential[term]
    counts = (index.block_first[term + 1] - index.block_first[term])[use]
    place = expand(index.block_first[term[use]], counts)
    blocks = len(index.rest)
    names, bound = _sum_by(np.repeat(passage[use], counts) * blocks + index.block[place], index.block_max[place])
    alive = names[bound + index.rest[names % blocks] >= threshold]
    mine = np.isin(passage, alive // blocks)
    passage, term = passage[mine], term[mine]
    counts = index.first[term + 1] - index.first[term]
    place = expand(index.first[term], counts)
    passage = np.repeat(passage, counts)
    scored = np.isin(passage * blocks + index.item[place] // BLOCK, alive)
    names, score = _sum_by(passage[scored] * len(index.items) + index.item[place[scored]], index.impact[place[scored]])
    over = score >= threshold
    text = np.searchsorted(begin, names[over] // len(index.items), "right") - 1
    pair, where = np.unique(text * len(index.items) + names[over] % len(index.items), return_inverse=True)
    best = np.zeros(len(pair))
    np.maximum.at(best, where, score[over])
    return pair // len(index.items), pair % len(index.items), best


def asking(index: Index, found: Words) -> np.ndarray:
    """text number * items + item number of all pairs with a key of the item's question."""
    pairs = [np.zeros(0, np.int64)]
    text = found.text_of()
    for size, (names, first, items) in index.keys.items():
        runs = grams(found.hashes, size)
        at = np.minimum(np.searchsorted(names, runs), len(names) - 1)
        hit = np.flatnonzero(names[at] == runs)
        hit = hit[text[hit] == text[hit + size - 1]]
        seen = np.unique(text[hit] * len(names) + at[hit])
        key = seen % len(names)
        counts = first[key + 1] - first[key]
        pairs.append(np.unique(np.repeat(seen // len(names), counts) * len(index.items) + items[expand(first[key], counts)]))
    return np.unique(np.concatenate(pairs))


def best_score(index: Index, item: int, there: np.ndarray) -> float:
    """The best score of an item over the passages of one text."""
    own = np.flatnonzero(index.item == item)
    terms, impact = index.terms[np.searchsorted(index.first, own, "right") - 1], index.impact[own]
    at = np.minimum(np.searchsorted(terms, there), len(terms) - 1)
    hit = np.flatnonzero(terms[at] == there)
    passages = max(1, -(-(len(there) - STRIDE) // STRIDE))
    slot = np.concatenate([hit // STRIDE, hit // STRIDE - 1])
    inside = (slot >= 0) & (slot < passages)
    pairs = np.unique(slot[inside] * len(terms) + np.tile(at[hit], 2)[inside])
    return float(np.bincount(pairs // len(terms), weights=impact[pairs % len(terms)]).max())


def hits(index: Index, column: pa.Array) -> list[tuple[int, int, float, float, float]]:
    """(text number, item number, score, question's share, answer's share) of verified pairs."""
    found = words(column, True, BREAK)
    text, item, score = retrieve(index, found)
    scores = dict(zip((text * len(index.items) + item).tolist(), score.tolist()))
    out = []
    last, there = -1, Shingles(found.hashes[:0])
    for pair in sorted({*scores, *asking(index, found).tolist()}):
        t, i = divmod(pair, len(index.items))
        if t != last:
            last, there = t, Shingles(found.hashes[found.first[t] : found.first[t + 1]])
        asked = there.share(index.question[i])
        if asked >= OVERLAP:
            best = scores[pair] if pair in scores else best_score(index, i, there.hashes)
            out.append((t, i, best, asked, there.share(index.answer[i])))
    return out


def item_words(items: DataFrame, shard: Column) -> DataFrame:
    """(shard, item, term): the distinct words of each item; ``item`` numbers the rows of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            found = words(pa.array([f"{q}\n{a}" for q, a in map(parts_of_item, batch.to_pylist())], pa.string()), True, BREAK)
            n = len(found.first) - 1
            text = found.text_of()
            pair = np.unique(np.column_stack([text.view(np.uint64), found.hashes]), axis=0)
            text, size = pair[:, 0].astype(np.int64), np.diff(found.first)
            yield pa.record_batch(
                [batch.column("shard").take(pa.array(text)), pa.array(text + number), pa.array(size[text]), pa.array(np.ascontiguousarray(pair[:, 1]).view(np.int64))],
                ["shard", "item", "length", "term"],
            )
            number += n

    rows = items.select(shard.alias("shard"), *[c for c in ("text", "question", "answer") if c in items.columns])
    return rows.mapInArrow(worker.lean(run, "powers"), "shard long, item long, length long, term long")


def parts_of_item(row: dict) -> tuple[str, str]:
    """(question, answer) of an item's row."""
    return split_item(row["text"]) if "text" in row else (row["question"] or "", row["answer"] or "")


def indexes(items: DataFrame, shard_words: int = SHARD_WORDS) -> Iterator[Index]:
    """Indexes of (item_id, text) or (item_id, question, answer), a shard at a time."""
    whole = F.col("text") if "text" in items.columns else F.concat_ws(" ", "question", "answer")
    size = items.select(F.sum(F.length(whole)).alias("n")).first().n or 0
    shards = max(1, -(-size // (4 * shard_words)))  # four characters a word, or more shards than needed
    of = F.pmod(F.xxhash64("item_id", whole), F.lit(shards))
    if shards > 1:  # scores are the same however many shards there are
        found = kept(item_words(items, of), "item-words")
        each = found.groupBy("item").agg(F.first("length").alias("length"))
        n, length = each.agg(F.count(F.lit(1)), F.avg("length")).first()
        counts = found.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
        shares = kept(found.select("shard", "term").distinct().join(counts, "term"), "item-terms")
    for shard in range(shards):
        rows = items.where(of == shard).collect()  # a shard's items; their words are bounded
        known = None
        if shards > 1:
            terms = shares.where(F.col("shard") == shard).select("term", "df").toArrow()
            names, df = terms["term"].to_numpy().view(np.uint64), terms["df"].to_numpy()
            order = np.argsort(names)
            known = Statistics(n, length, names[order], df[order])
        index = build([(r.item_id, *parts_of_item(r.asDict())) for r in rows], statistics=known)
        if index:
            yield index


def contaminated(docs: DataFrame, items: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(doc_id, item_id, score, question_overlap, answer_overlap, full) of documents that know an item."""
    spark = docs.sparkSession
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))

    def search(shared) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64())
            names = ["doc_id", "item_id", "score", "question_overlap", "answer_overlap"]
            for whole in batches:
                for batch in slices(whole, "text", BATCH_BYTES):
                    ids = batch.column("doc_id").to_pylist()
                    rows = [(ids[t], int(shared.value.items[i]), *rest) for t, i, *rest in hits(shared.value, batch.column("text"))]
                    if rows:
                        yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

        return texts.mapInArrow(worker.lean(run, "powers"), HITS)

    parts = [search(spark.sparkContext.broadcast(index)) for index in indexes(items, shard_words)]
    found = reduce(DataFrame.unionByName, parts, spark.createDataFrame([], HITS))
    return found.withColumn("full", F.col("answer_overlap") >= OVERLAP)


def clean(docs: DataFrame, items: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    """The rows of ``docs`` that know no item, with their columns."""

    def keep(docs: DataFrame, shared) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for batch in slices(whole, "text", BATCH_BYTES):
                    stays = np.ones(batch.num_rows, bool)
                    stays[[t for t, *_ in hits(shared.value, batch.column("text").fill_null(""))]] = False
                    yield batch.filter(pa.array(stays))

        return docs.mapInArrow(worker.lean(run, "powers"), docs.schema)

    for index in indexes(items, shard_words):
        docs = keep(docs, docs.sparkSession.sparkContext.broadcast(index))
    return docs
