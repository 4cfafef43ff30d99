"""Near-duplicate documents by MinHash signatures, banding and components.

A document is its set of distinct word shingles, each a 64-bit hash. Each function of a universal
family (multiply and add modulo 2^64) takes the least value over a set; two sets have the same
least value with the probability of their Jaccard similarity. Minima are grouped into bands, and
documents that agree on a whole band meet under its key. There are as many bands as make a linked
pair miss all of them with a probability of ``MISS`` at most, worst case at the limit itself.

What meets is verified twice. Signatures first: one byte of each minimum is kept, and pairs whose
agreement is ``SLACK`` standard deviations under what a link has go; so do pairs whose sizes, or
the parities of the tokens dealt to ``PARITIES`` bits, differ by more than a link can. Then the
whole sets: only pairs that are similar enough by exact count are links. Components are found by alternating large
and small stars.

No group is expanded into pairs: under each key the others are compared with the least of them.
Similarity is not transitive, so keys under which several components then stand are open. Their
documents get finer bands (``FINE`` minima each, again as many as ``MISS`` asks for), under which
only documents near the limit still meet; there they are compared with three of them in turn, and only what then still lies in different components under one fine
key is compared pairwise, within the join, by sizes, signatures and parities. Those comparisons grow with the square of a group only where
very many documents are just below the limit to each other and not linked.

Documents with equal sets are one class throughout, however many they are. Nulls, empty texts and
texts without words have no shingles and are linked with nothing. A null id sorts above all others
when a component is named. Repeated rows are members of one class. An empty table gives no rows.
Only the id and text columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bpe import slices
from tidemark.llm.components import components
from tidemark.llm.jaccard import prints, shingles
from tidemark.llm.tables import kept
from tidemark.llm.words import mixed

SHINGLE = 3
SIMILAR = (85, 100)
ROWS, FINE = 4, 16
MISS = 1e-10
SIGNATURE = 128
PARITIES = 1024
SLACK = 6.5
STAR = 256  # sets compared with one set in one group
BATCH_BYTES = 2 << 20
SEED = 12
Limit = tuple[int, int]


def n_bands(rows: int, similar: Limit = SIMILAR) -> int:
    """Bands of ``rows`` minima so that a pair at the limit misses all of them with ``MISS`` at most."""
    same = (similar[0] / similar[1]) ** rows
    return math.ceil(math.log(MISS) / math.log1p(-same)) if same < 1 else 1


def least_agreement(similar: Limit = SIMILAR, n: int = SIGNATURE) -> int:
    """Of ``n`` minima, how many agree at least in a linked pair, but for ``SLACK`` deviations."""
    t = similar[0] / similar[1]
    return max(0, math.floor(n * t - SLACK * math.sqrt(n * t * (1 - t))))


def minima(hashes: np.ndarray, starts: np.ndarray, n: int, seed: int = SEED) -> np.ndarray:
    """(sets, n): the least value of each of ``n`` hash functions over each set.

    Sets lie one after the other in ``hashes``; none is empty.
    """
    rng = np.random.default_rng(seed)
    factors = rng.integers(0, 1 << 64, n, np.uint64) | np.uint64(1)
    addends = rng.integers(0, 1 << 64, n, np.uint64)
    out = np.zeros((len(starts), n), np.uint32)
    if not len(starts):
        return out
    values = np.empty_like(hashes)
    for i in range(n):
        np.multiply(hashes, factors[i], out=values)
        np.add(values, addends[i], out=values)
        out[:, i] = np.minimum.reduceat(values, starts) >> np.uint64(32)
    return out


def band_keys(least: np.ndarray, rows: int) -> np.ndarray:
    """(sets, bands): a key of each band's minima and number."""
    n, k = least.shape
    parts = least.astype(np.uint64).reshape(n, k // rows, rows)
    keys = np.broadcast_to(np.arange(1, k // rows + 1, dtype=np.uint64), (n, k // rows))
    for j in range(rows):
        keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, j])
    return keys.view(np.int64)


def parities(hashes: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """(sets, longs): the parity of the tokens that each of ``PARITIES`` bits gets."""
    place = ((hashes >> np.uint64(20)) % np.uint64(PARITIES)).astype(np.int64)
    odd = np.bincount(owner * PARITIES + place, minlength=n * PARITIES).astype(np.uint8) & 1
    return np.packbits(odd.reshape(n, PARITIES), axis=1).view(np.int64)


def _lists(values: np.ndarray, has: np.ndarray) -> pa.ListArray:
    """One row of ``values`` for each row that ``has`` one, an empty list for the others."""
    ends = np.cumsum(np.where(has, values.shape[1], 0))
    return pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(values.reshape(-1)))


def signed(texts: DataFrame, size: int = SHINGLE, similar: Limit = SIMILAR) -> DataFrame:
    """(doc_id, n_shingles, a, b, signature, parities, bands): fingerprints of each document's set.

    ``signature`` holds a byte of each of the first ``SIGNATURE`` minima, eight to a long.
    """
    bands = n_bands(ROWS, similar)
    n_minima = max(SIGNATURE, bands * ROWS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", BATCH_BYTES):
                h, t = shingles(batch.column("text"), size)
                n, a, b = prints(h, t, batch.num_rows)
                has = n > 0
                least = minima(h, (np.cumsum(n) - n)[has], n_minima)
                low = np.ascontiguousarray(least[:, :SIGNATURE].astype(np.uint8)).view(np.int64)
                columns = [
                    batch.column("doc_id"), pa.array(n.astype(np.int64)), pa.array(a.view(np.int64)), pa.array(b.view(np.int64)),
                    _lists(low, has), _lists(parities(h, t, batch.num_rows)[has], has), _lists(band_keys(least[:, : bands * ROWS], ROWS), has),
                ]
                yield pa.record_batch(columns, ["doc_id", "n_shingles", "a", "b", "signature", "parities", "bands"])

    schema = "doc_id long, n_shingles long, a long, b long, signature array<long>, parities array<long>, bands array<long>"
    return texts.mapInArrow(run, schema)


def agreement(x: Column, y: Column) -> Column:
    """How many bytes two signatures have in common."""

    def differing(four: Column) -> Column:
        marks = ((four.bitwiseAND(F.lit(0x7F7F7F7F)) + F.lit(0x7F7F7F7F)).bitwiseOR(four)).bitwiseAND(F.lit(0x80808080))
        return F.bit_count(marks)

    apart = []
    for k in range(SIGNATURE // 8):
        both = F.get(x, F.lit(k)).bitwiseXOR(F.get(y, F.lit(k)))
        apart += [differing(both.bitwiseAND(F.lit(0xFFFFFFFF))), differing(F.shiftrightunsigned(both, 32))]
    return F.lit(SIGNATURE) - reduce(lambda p, q: p + q, apart)


def may_link(similar: Limit, x: str, y: str) -> Column:
    """Whether sizes and signatures of two sides allow a link."""
    num, den = similar
    n, m = F.col(f"{x}.n"), F.col(f"{y}.n")
    alike = agreement(F.col(f"{x}.signature"), F.col(f"{y}.signature"))
    bits = [F.get(F.col(f"{x}.parities"), F.lit(k)).bitwiseXOR(F.get(F.col(f"{y}.parities"), F.lit(k))) for k in range(PARITIES // 64)]
    apart = reduce(lambda p, q: p + q, [F.bit_count(b) for b in bits])
    near = apart <= F.floor((den - num) * (n + m) / (den + num))
    return (den * F.least(n, m) >= num * F.greatest(n, m)) & near & (alike >= least_agreement(similar))


#: Which document of a key the others are compared with, round by round.
HUBS = ("of the least component", "of the greatest", "drawn by hash")


def starred(entries: DataFrame, facts: DataFrame, similar: Limit, which: str = HUBS[0]) -> DataFrame:
    """Pairs (a, b) of the documents under each key with one of them.

    Documents that are known to be in one component with it are left out. ``entries``: (key, node,
    n, label), stored; ``facts``: (node, n, signature, parities), stored.
    """
    num, den = similar
    one = F.struct("label", "node", "n")
    hub = {HUBS[0]: F.min(one), HUBS[1]: F.max(one), HUBS[2]: F.min_by(one, F.xxhash64("key", "node"))}[which]
    hubs = entries.groupBy("key").agg(hub.alias("hub"), F.min("label").alias("low"), F.max("label").alias("high"))
    hubs = hubs.where("low < high").select("key", "hub.*").toDF("key", "hub_label", "b", "m")
    near = (F.col("label") != F.col("hub_label")) & (den * F.least("n", "m") >= num * F.greatest("n", "m"))
    hubs = kept(hubs, "hubs")
    pairs = kept(entries.join(hubs, "key").where(near).select(F.col("node").alias("a"), "b").distinct(), "star-pairs")
    x, y = facts.alias("x"), facts.alias("y")
    met = pairs.join(x, F.col("a") == F.col("x.node")).join(y, F.col("b") == F.col("y.node"))
    return met.where(may_link(similar, "x", "y")).select("a", "b")


def sets_of(texts: DataFrame, chosen: DataFrame, size: int) -> DataFrame:
    """(node, data): the sorted shingle hashes of the chosen (node, rep) classes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", BATCH_BYTES):
                h, t = shingles(batch.column("text"), size)
                n, a, _ = prints(h, t, batch.num_rows)
                nodes = batch.column("node").to_numpy()
                ends = np.cumsum(n)
                mine = np.flatnonzero(a.view(np.int64) == nodes)
                sets = [h[ends[k] - n[k] : ends[k]].tobytes() for k in mine]
                yield pa.record_batch([pa.array(nodes[mine]), pa.array(sets, pa.binary())], ["node", "data"])

    # an id may stand for several texts; those of another class than the one asked for are dropped
    found = texts.hint("merge").join(chosen, F.col("doc_id").eqNullSafe(F.col("rep"))).select("node", "text").distinct()
    return found.mapInArrow(run, "node long, data binary")


def verified(pairs: DataFrame, sets: DataFrame, similar: Limit = SIMILAR) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough.

    Each set ``b`` travels once to every ``STAR`` of its others, which stream past it.
    """
    num, den = similar
    groups = kept(pairs.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / STAR).alias("salts")), "star-sizes")
    salted = pairs.join(groups, "b").select("a", "b", F.pmod(F.xxhash64("a"), "salts").alias("salt"))
    others = sets.join(salted, F.col("node") == F.col("a")).select("b", "salt", "a", "data", F.lit(False).alias("is_hub"))
    salts = groups.select("b", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"))
    hubs = sets.join(salts, F.col("node") == F.col("b")).select("b", "salt", F.col("b").alias("a"), "data", F.lit(True).alias("is_hub"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub = np.zeros(0, np.uint64)
        for batch in batches:
            links = []
            for at, (data, is_hub) in enumerate(zip(batch.column("data"), batch.column("is_hub").to_pylist())):
                own = np.frombuffer(data.as_buffer(), np.uint64)
                if is_hub:
                    hub = own.copy()
                    continue
                place = np.minimum(np.searchsorted(hub, own), len(hub) - 1)
                inter = int((hub[place] == own).sum())
                if den * inter >= num * (len(hub) + len(own) - inter):
                    links.append(at)
            yield batch.select(["a", "b"]).take(pa.array(links, pa.int64()))

    rows = others.unionByName(hubs).repartition("b", "salt").sortWithinPartitions("b", "salt", F.desc("is_hub"))
    return rows.select("a", "b", "data", "is_hub").mapInArrow(run, "a long, b long")


def fine_entries(sets: DataFrame, nodes: DataFrame, similar: Limit) -> DataFrame:
    """(node, key): the fine bands of the given nodes."""
    bands = n_bands(FINE, similar)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "data", BATCH_BYTES):
                parts = [np.frombuffer(d, np.uint64) for d in batch.column("data").to_pylist()]
                n = np.array([len(p) for p in parts], np.int64)
                hashes = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
                keys = band_keys(minima(hashes, np.cumsum(n) - n, bands * FINE, SEED + 1), FINE)
                yield pa.record_batch([batch.column("node"), _lists(keys, np.ones(len(n), bool))], ["node", "keys"])

    mine = sets.join(nodes, "node", "left_semi").mapInArrow(run, "node long, keys array<long>")
    return mine.select("node", F.explode("keys").alias("key"))


def _relabelled(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Components of what ``labels`` and more ``links`` join."""
    ends = labels.select(F.col("node").alias("a"), F.col("label").alias("b"))
    return kept(components(ends.unionByName(links)), "labels")


def _open(entries: DataFrame, labels: DataFrame) -> DataFrame:
    """The entries of keys under which several components stand, with their ``label``."""
    marked = kept(entries.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")), "marked")
    low, high = F.min("label").alias("low"), F.max("label").alias("high")
    keys = marked.groupBy("key").agg(low, high).where("low < high").select("key")
    return kept(marked.join(kept(keys, "open-keys"), "key", "left_semi"), "open-entries")


def links_between(facts: DataFrame, entries: DataFrame, sets: DataFrame, similar: Limit) -> tuple[DataFrame, DataFrame]:
    """(links, labels): verified links that tell all components of the nodes of ``entries``."""
    alone = entries.withColumn("label", F.col("node"))
    links = kept(verified(kept(starred(alone, facts, similar), "star-candidates"), sets, similar), "links")
    labels = kept(components(links), "labels")
    opened = _open(entries, labels)
    nodes = kept(opened.select("node").distinct(), "open-nodes")
    if nodes.isEmpty():
        return links, labels
    fine = fine_entries(sets, nodes, similar).join(facts.select("node", "n"), "node")
    fine = _open(kept(fine.select("key", "node", "n"), "fine-entries"), labels)
    for which in HUBS:
        more = kept(verified(kept(starred(fine, facts, similar, which), "fine-candidates"), sets, similar), "fine-links")
        if more.isEmpty():
            continue
        links, labels = links.unionByName(more), _relabelled(labels, more)
        fine = _open(fine.drop("label"), labels)
    left = kept(fine.join(facts.drop("n"), "node"), "left-entries")
    x, y = left.alias("x"), left.alias("y")
    cross = x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.label") > F.col("y.label")) & may_link(similar, "x", "y"))
    pairs = kept(cross.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct(), "cross-candidates")
    last = kept(verified(pairs, sets, similar), "cross-links")
    return links.unionByName(last).distinct(), _relabelled(labels, last)


def similar_documents(docs: DataFrame, size: int = SHINGLE, similar: Limit = SIMILAR) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, links): every document with the component of its links.

    ``kept`` is true for the document that names its component. ``links`` is the number of verified
    links that its class took part in (those needed to tell the components, not all there are).
    """
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    known = kept(signed(texts, size, similar), "signed")
    classes = known.where("n_shingles > 0").groupBy("a", "b", "n_shingles").agg(F.min("doc_id").alias("rep"))
    classes = kept(classes, "set-classes")
    # ids are part of the key, so a group of very many copies is spread over the tasks
    mine = [known["a"] == classes["a"], known["b"] == classes["b"], known["doc_id"].eqNullSafe(classes["rep"])]
    facts = known.join(classes.select("a", "b", "rep"), mine).select(
        known["a"].alias("node"), "rep", F.col("n_shingles").alias("n"), "signature", "parities", "bands"
    )
    facts = kept(facts.dropDuplicates(["node"]), "facts")
    entries = kept(facts.select(F.explode("bands").alias("key"), "node", "n"), "entries")
    shared = entries.groupBy("key").agg(F.count(F.lit(1)).alias("met")).where("met > 1").select("key")
    entries = kept(entries.join(kept(shared, "shared-keys"), "key", "left_semi"), "met-entries")
    chosen = entries.select("node").distinct().join(facts.select("node", "rep"), "node")
    sets = kept(sets_of(texts, kept(chosen, "chosen"), size), "sets")
    links, labels = links_between(facts.select("node", "n", "signature", "parities"), entries, sets, similar)
    ends = links.select(F.col("a").alias("node")).unionByName(links.select(F.col("b").alias("node")))
    degrees = ends.groupBy("node").agg(F.count(F.lit(1)).alias("links"))
    placed = classes.withColumnRenamed("a", "node").join(labels, "node", "left").join(degrees, "node", "left")
    placed = placed.select("node", "b", "n_shingles", "rep", F.coalesce("label", "node").alias("label"), F.coalesce("links", F.lit(0)).alias("links"))
    placed = kept(placed, "placed")
    names = kept(placed.groupBy("label").agg(F.min("rep").alias("component_id")), "names")
    member = placed.join(names, "label").select(F.col("node").alias("a"), "b", "n_shingles", "component_id", "links")
    whole = known.select("doc_id", "n_shingles", "a", "b").join(kept(member, "members"), ["a", "b", "n_shingles"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return whole.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
        F.coalesce("links", F.lit(0)).cast("long").alias("links"),
    )
