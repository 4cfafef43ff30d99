"""N-gram Jaccard join by parity sketches.

A document is its set of distinct word shingles, each a 64-bit hash. Hashes are dealt by value
over the parts of a size band's partition, and XOR-ed into the part's 64 bits; further bits, as
many as the size asks for, hold the parity of the tokens dealt to each. Each differing token changes one part at most and
flips one parity bit at most, so the number of differing parts and the bits' Hamming distance are
lower bounds of the symmetric difference, which for linked sets is at most (1 - t) / (1 + t) of the
sizes' sum.

Pigeonhole join: with more parts than that bound, linked documents have an equal part. A document
leaves out the parts with fewest tokens, as many whole count classes as the bound allows; what
remains of it and of any linked one still has an equal part. Bands hold sizes [2^k, 2^(k+1)); a
document near a band's end is dealt by the next band's partition too.

Documents of one part are compared in stars around the least of them (already within a task, so a
part that a third of all rows share sends one row a task on), first by sizes and parity bits, and
verified on whole sets. Links
alone are not enough there, since similarity is not transitive, and a part has few tokens, so
documents that merely share passages have equal parts too. Instead of being compared pairwise, the
documents that met in some part get fine sketches. Each is the XOR of the tokens that a hash
function of its own puts into a range, so wide that a linked pair differs in none of them with the
probability ``SURVIVES``, and there are as many as make such a pair miss all of them with ``MISS``
at most. Documents far below the limit hardly ever have one in common. Under a fine sketch documents of different components are compared in stars, and only those
still apart after that pairwise, within the join, by sizes and by one to two parity bits a token. Documents with equal sets are
one class throughout.

Nulls, empty texts and texts without words have no shingles and are linked with nothing. A null id
sorts above all others when a component is named. Repeated rows are members of one class. An empty
table gives no rows. Only the id and text columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import worker
from tidemark.llm.bpe import slices
from tidemark.llm.components import components
from tidemark.llm.tables import free_names, kept
from tidemark.llm.words import mixed, words

SHINGLE = 4
SIMILAR = (85, 100)
LOAD = 5.0  # tokens a part at a band's upper end
SURVIVES, MISS = 0.25, 1e-10
STAR = 256  # sets compared with one set in one group
BATCH_BYTES = 1 << 20
WORDS = ("w0", "w1", "w2", "w3")
STEP = np.uint64(0xA0761D6478BD642F)


def shingles(column: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, text numbers): the distinct word shingles of each text, sorted within it.

    A text of fewer words has its whole sequence as its one shingle.
    """
    found = words(column, lower=True)
    first, last = found.first[:-1], found.first[1:]
    text = found.text_of()
    place = np.arange(len(text))
    left = last[text] - place
    at = place[(left >= size) | (place == first[text])]
    hashes = np.zeros(len(at), np.uint64)
    with np.errstate(over="ignore"):
        for j in range(size):
            inside = left[at] > j
            word = found.hashes[np.minimum(at + j, len(place) - 1)] if len(place) else hashes
            hashes = np.where(inside, mixed(hashes * STEP + word + np.uint64(j + 1)), hashes)
    text = text[at]
    order = np.lexsort((hashes, text))
    hashes, text = hashes[order], text[order]
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    return hashes[fresh], text[fresh]


def prints(hashes: np.ndarray, text: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(size, a, b) of each text's set; equal for equal sets."""
    size = np.bincount(text, minlength=n)
    ends = np.concatenate([[0], np.cumsum(size)])
    out = []
    for seed in (1, 2):
        running = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum(mixed(hashes ^ np.uint64(seed * 0x5851F42D4C957F2D)), out=running[1:])
        out.append(mixed(running[ends[1:]] - running[ends[:-1]] + np.uint64(seed)))
    return size, out[0], out[1]


def most_different(sizes: np.ndarray, similar: tuple[int, int] = SIMILAR) -> np.ndarray:
    """The largest symmetric difference that linked sets whose sizes add up to ``sizes`` can have."""
    num, den = similar
    return (den - num) * sizes // (den + num)


def part_keys(
    hashes: np.ndarray, text: np.ndarray, size: np.ndarray, similar: tuple[int, int] = SIMILAR
) -> tuple[np.ndarray, np.ndarray]:
    """(keys, text numbers): the part sketches under which each text is looked for."""
    num, den = similar
    keys, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    band = np.frexp(np.maximum(size, 1))[1] - 1
    for up in (0, 1):
        # in the next band only sizes that a linked set there can have
        here = size > 0
        if up:
            here &= size * den >= num * (np.int64(2) << band)
        if not here.any():
            continue
        chosen = here[text]
        h, t = hashes[chosen], text[chosen]
        b = band + up
        top = (np.int64(2) << b) - 1
        parts = np.maximum(np.ceil((top + 1) / LOAD).astype(np.int64), most_different(2 * top, similar) + 1)
        part = ((h >> np.uint64(32)) * parts[t].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
        begins = np.ones(len(h), bool)
        begins[1:] = (t[1:] != t[:-1]) | (part[1:] != part[:-1])
        at = np.flatnonzero(begins)
        sums, counts = np.bitwise_xor.reduceat(h, at), np.diff(np.append(at, len(h)))
        owner, part = t[at], part[at]
        # whole count classes are left out, from empty parts up, while an equal part must remain
        bound = np.minimum(most_different(size + size * den // num, similar), most_different(2 * top, similar))
        classes = np.bincount(owner * 66 + np.minimum(counts, 65), minlength=len(size) * 66).reshape(-1, 66)
        classes[:, 0] = parts - np.bincount(owner, minlength=len(size))
        spare = parts - bound - 1
        out = (np.cumsum(classes, axis=1)[:, :65] <= spare[:, None]).sum(axis=1) - 1
        stays = counts > out[owner]
        for k in np.flatnonzero(here & (out < 0)):  # so many empty parts that these count as well
            empty = np.setdiff1d(np.arange(parts[k]), part[owner == k])
            sums, owner = np.concatenate([sums, np.zeros(len(empty), np.uint64)]), np.concatenate([owner, np.full(len(empty), k)])
            part, stays = np.concatenate([part, empty]), np.concatenate([stays, np.ones(len(empty), bool)])
        sums, owner, part = sums[stays], owner[stays], part[stays]
        place = (b[owner].astype(np.uint64) << np.uint64(48)) + part.astype(np.uint64)
        keys.append(mixed(sums ^ mixed(place)))
        owners.append(owner)
    return np.concatenate(keys), np.concatenate(owners)


def stars(keys: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, node, hub): a mask of one entry per key, and links of the others to its least node."""
    order = np.lexsort((nodes, keys))
    k, v = keys[order], nodes[order]
    begins = np.ones(len(k), bool)
    begins[1:] = k[1:] != k[:-1]
    hub = v[begins][np.cumsum(begins) - 1] if len(k) else v
    other = hub != v
    first = np.zeros(len(keys), bool)
    first[order[begins]] = True
    links = np.unique(np.column_stack([v[other], hub[other]]), axis=0)
    return first, links[:, 0], links[:, 1]


BLOBS = "bucket int, keys binary, nodes binary"


def starred(keys: np.ndarray, nodes: np.ndarray) -> tuple:
    """One entry a key, and the links of the others."""
    first, a, b = stars(keys, nodes)
    return keys[first], nodes[first], a, b


def _dealt(rows: DataFrame, column: str, per_batch, reduced, buckets: int) -> DataFrame:
    """Entries (key, node) sent to the task that owns the key's range; a row holds many entries.

    Keys are hashes, so the ranges are even. ``column`` is what sizes a batch. Entries are
    ``reduced`` within a batch; links that come of it travel as bucket -1 - (any bucket).
    """

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, column, BATCH_BYTES)):
            keys, nodes, a, b = reduced(*per_batch(batch))
            owner = ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)
            order = np.argsort(owner, kind="stable")
            keys, nodes, owner = keys[order], nodes[order], owner[order]
            at = np.flatnonzero(np.append(True, owner[1:] != owner[:-1])) if len(owner) else np.zeros(0, int)
            ends = np.append(at[1:], len(owner))
            rows = [(int(owner[i]), keys[i:j].tobytes(), nodes[i:j].tobytes()) for i, j in zip(at, ends)]
            if len(a):
                rows.append((-1 - int(mixed(a[:1])[0] % np.uint64(buckets)), a.tobytes(), b.tobytes()))
            if rows:
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), (pa.int32(), pa.binary(), pa.binary()))], ["bucket", "keys", "nodes"])

    sent = rows.mapInArrow(worker.lean(deal, "powers"), BLOBS)
    return sent.repartitionById(buckets, F.when(F.col("bucket") < 0, -1 - F.col("bucket")).otherwise(F.col("bucket")))


def _gather(batches: Iterator[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(keys, nodes, linked nodes, their hubs) of one task."""
    held: dict[bool, list[tuple[bytes, bytes]]] = {True: [], False: []}
    for batch in batches:
        for bucket, keys, nodes in zip(*(batch.column(c).to_pylist() for c in ("bucket", "keys", "nodes"))):
            held[bucket < 0].append((keys, nodes))
    out = []
    for links in (False, True):
        for k in (0, 1):
            out.append(np.frombuffer(b"".join(pair[k] for pair in held[links]), np.uint64))
    return tuple(out)


def _pairs(a: np.ndarray, b: np.ndarray, names: tuple[str, str]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], list(names))


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    keys, nodes, a, b = _gather(batches)
    _, c, d = stars(keys, nodes)
    links = np.unique(np.column_stack([np.concatenate([a, c]), np.concatenate([b, d])]), axis=0)
    yield _pairs(np.ascontiguousarray(links[:, 0]), np.ascontiguousarray(links[:, 1]), ("a", "b"))


def sizes(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(doc_id, n_shingles, a, b): the size and fingerprints of each document's set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", BATCH_BYTES):
                h, t = shingles(batch.column("text"), size)
                n, a, b = prints(h, t, batch.num_rows)
                yield pa.record_batch(
                    [batch.column("doc_id"), pa.array(n.astype(np.int64)), pa.array(a.view(np.int64)), pa.array(b.view(np.int64))],
                    ["doc_id", "n_shingles", "a", "b"],
                )

    return docs.mapInArrow(worker.lean(run, "powers"), "doc_id long, n_shingles long, a long, b long")


def _of_texts(size: int, similar: tuple[int, int]):
    def run(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        h, t = shingles(batch.column("text"), size)
        n, a, _ = prints(h, t, batch.num_rows)
        keys, owner = part_keys(h, t, n, similar)
        return keys, a[owner]

    return run


def _set_arrays(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, sizes): stored sets one after the other."""
    sets = [np.frombuffer(s, np.uint64) for s in column.to_pylist()]
    return np.concatenate(sets) if sets else np.zeros(0, np.uint64), np.array([len(s) for s in sets], np.int64)


def fine_keys(h: np.ndarray, n: np.ndarray, similar: tuple[int, int] = SIMILAR) -> tuple[np.ndarray, np.ndarray]:
    """(keys, set numbers): the fine sketches of sets that lie one after the other in ``h``.

    Linked sets of at most one token that differs have equal parts already, but are not left out.
    """
    num, den = similar
    count = math.ceil(math.log(MISS) / math.log1p(-SURVIVES))
    band = np.frexp(np.maximum(n, 1))[1] - 1
    keys, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for up in (0, 1):
        here = n > 0
        if up:
            here &= n * den >= num * (np.int64(2) << band)
        mine = np.flatnonzero(here)
        if not len(mine):
            continue
        tokens, m = h[np.repeat(here, n)], n[mine]
        starts = np.cumsum(m) - m
        b = band[mine] + up
        differ = np.maximum(1, most_different(2 * ((np.int64(2) << b) - 1), similar))
        share = -np.expm1(math.log(SURVIVES) / differ)  # of all tokens, so that (1 - share)^differ survive
        limit = np.repeat((share * 2.0**32).astype(np.uint64), m)
        for j in range(count):
            value = mixed(tokens ^ np.uint64((j + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
            inside = np.where((value >> np.uint64(32)) < limit, value, np.uint64(0))
            sketch = np.bitwise_xor.reduceat(inside, starts)
            place = (b.astype(np.uint64) << np.uint64(48)) + np.uint64(j)
            some = sketch != 0  # sets without a token there have the rest of the sketches
            keys.append(mixed(sketch ^ mixed(place))[some])
            owners.append(mine[some])
    return np.concatenate(keys), np.concatenate(owners)


def _sets(docs: DataFrame, chosen: DataFrame, size: int) -> DataFrame:
    """(node, n, set, bits, parity, w0..w3): the sorted hashes of the chosen classes and their parity bits.

    ``bits`` are as many as the size band asks for, ``parity`` holds the same as numbers, w0..w3 are 256.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", BATCH_BYTES):
                h, t = shingles(batch.column("text"), size)
                n, a, _ = prints(h, t, batch.num_rows)
                nodes = batch.column("node").to_numpy()
                ends = np.concatenate([[0], np.cumsum(n)])
                mine = np.flatnonzero(a.view(np.int64) == nodes)
                sets = [h[ends[k] : ends[k + 1]] for k in mine]
                odd = [np.bincount((s & np.uint64(255)).astype(np.int64), minlength=256) & 1 for s in sets]
                bits = np.packbits(np.array(odd, np.uint8).reshape(-1, 256), axis=1).view("<i8")
                whole_bits = [parity_bits(s) for s in sets]
                numbers = pa.array([np.frombuffer(b, "<i8") for b in whole_bits], pa.list_(pa.int64()))
                yield pa.record_batch(
                    [pa.array(nodes[mine]), pa.array(n[mine].astype(np.int64)), pa.array([s.tobytes() for s in sets], pa.binary()), pa.array(whole_bits, pa.binary()), numbers, *[pa.array(np.ascontiguousarray(bits[:, k])) for k in range(4)]],
                    ["node", "n", "set", "bits", "parity", *WORDS],
                )

    texts = docs.hint("merge").join(chosen, F.col("doc_id").eqNullSafe(F.col("rep"))).select("doc_id", "node", "text").distinct()
    return texts.select("node", "text").mapInArrow(worker.lean(run, "powers"), "node long, n long, set binary, bits binary, parity array<long>, " + ", ".join(f"{w} long" for w in WORDS))


def parity_bits(tokens: np.ndarray) -> bytes:
    """The parity of the tokens dealt to each of two to four bits a token."""
    bits = 1 << max(6, len(tokens).bit_length() + 1)
    place = ((tokens >> np.uint64(16)) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits(np.bincount(place, minlength=bits).astype(np.uint8) & 1, bitorder="little").tobytes()


def apart(x: bytes, y: bytes) -> int:
    """In how many bits two sketches differ; the longer one is folded, as parities add up."""
    a, b = int.from_bytes(x, "little"), int.from_bytes(y, "little")
    n, m = 8 * len(x), 8 * len(y)
    while n > m:
        n //= 2
        a = (a >> n) ^ (a & ((1 << n) - 1))
    while m > n:
        m //= 2
        b = (b >> m) ^ (b & ((1 << m) - 1))
    return (a ^ b).bit_count()


def plausible(pairs: DataFrame, sets: DataFrame, similar: tuple[int, int] = SIMILAR) -> DataFrame:
    """The pairs (a, b) that sizes and parity bits don't rule out; no whole set is moved."""
    num, den = similar

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m, x, y = (batch.column(c).to_pylist() for c in ("n", "m", "x", "y"))
            keep = [
                den * min(p, q) >= num * max(p, q) and apart(v, w) <= (den - num) * (p + q) // (den + num)
                for p, q, v, w in zip(n, m, x, y)
            ]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = sets.select(F.col("node").alias("a"), "n", F.col("bits").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("n").alias("m"), F.col("bits").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "n", "m", "x", "y").mapInArrow(run, "a long, b long")


def verified(pairs: DataFrame, sets: DataFrame, similar: tuple[int, int] = SIMILAR) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough.

    Sets are compared in groups of one set with ``STAR`` others at most, however many there are.
    """
    num, den = similar
    groups = kept(pairs.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / STAR).alias("salts")), "star-sizes")
    salted = pairs.join(groups, "b").select("a", "b", F.pmod(F.xxhash64("a"), "salts").alias("salt"))
    whole = sets.select("node", "set").hint("merge")
    others = whole.join(salted, F.col("node") == F.col("a")).select("a", "b", "salt", "set")
    salts = groups.select("b", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"))
    hubs = whole.join(salts, F.col("node") == F.col("b")).select(F.col("b").alias("a"), "b", "salt", "set")

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        is_hub = (frame["a"] == frame["b"]).to_numpy()
        hub = np.frombuffer(frame["set"][is_hub].iloc[0], np.uint64)
        frame = frame[~is_hub]
        keep = np.zeros(len(frame), bool)
        for k, data in enumerate(frame["set"]):
            other = np.frombuffer(data, np.uint64)
            at = np.minimum(np.searchsorted(hub, other), len(hub) - 1)
            inter = int((hub[at] == other).sum())
            keep[k] = den * inter >= num * (len(hub) + len(other) - inter)
        return frame[keep][["a", "b"]]

    return others.unionByName(hubs).groupBy("b", "salt").applyInPandas(compare, "a long, b long")


def similar_documents(docs: DataFrame, size: int = SHINGLE, similar: tuple[int, int] = SIMILAR) -> DataFrame:
    """(doc_id, n_shingles, component_id, links): every document with the component of its links.

    Sets are of ``size`` words in a row; those at least ``similar`` (as a fraction) are linked.
    ``links`` is the number of verified links that its class took part in (those needed to tell
    the components, not all there are).
    """
    return _placed(docs, size, similar).drop("a", "b")


def keep_one(docs: DataFrame, size: int = SHINGLE, similar: tuple[int, int] = SIMILAR) -> DataFrame:
    """One row of each component (that of its least id) and all that have no shingles, with their columns."""
    placed = _placed(docs, size, similar)
    stay = placed.where("n_shingles > 0 and doc_id <=> component_id").groupBy("component_id").agg(F.min(F.struct("a", "b")).alias("s"))
    names = free_names(docs, "n", "a", "b", "id", "no_id")
    n_name, a_name, b_name, id_name, none_name = names

    def keyed(id_column: str) -> dict[str, Column]:
        return {id_name: F.coalesce(F.col(id_column), F.lit(0)), none_name: F.col(id_column).isNull()}

    keys = [id_name, none_name, a_name, b_name]
    stay = stay.withColumns({**keyed("component_id"), a_name: F.col("s.a"), b_name: F.col("s.b")})
    stay = kept(stay.select(*keys), "stays")

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", BATCH_BYTES):
                h, t = shingles(batch.column("text").fill_null(""), size)
                n, a, b = prints(h, t, batch.num_rows)
                yield pa.record_batch([*batch.columns, pa.array(n), pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], [*batch.schema.names, n_name, a_name, b_name])

    more = [T.StructField(c, T.LongType()) for c in (n_name, a_name, b_name)]
    marked = docs.mapInArrow(worker.lean(mark, "powers"), T.StructType([*docs.schema.fields, *more])).withColumns(keyed("doc_id"))
    # joined and told apart by the same columns: rows are shuffled once
    one = marked.where(F.col(n_name) > 0).join(stay, keys, "left_semi").dropDuplicates(keys)
    return one.select(*docs.columns).unionByName(marked.where(F.col(n_name) == 0).select(*docs.columns))


def _placed(docs: DataFrame, size: int, similar: tuple[int, int]) -> DataFrame:
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    known = kept(sizes(texts, size), "set-sizes")
    classes = kept(
        known.where("n_shingles > 0").groupBy("a", "b", "n_shingles").agg(F.min("doc_id").alias("rep")), "set-classes"
    )
    dealt = _dealt(texts, "text", _of_texts(size, similar), starred, buckets)
    links = kept(dealt.mapInArrow(worker.lean(_linked), "a long, b long").distinct(), "candidate-links")
    nodes = links.select(F.col("a").alias("node")).unionByName(links.select(F.col("b").alias("node"))).distinct()
    chosen = classes.join(nodes, F.col("a") == F.col("node")).select("node", "rep").distinct()
    sets = kept(_sets(texts, kept(chosen, "chosen"), size), "sets")
    found = kept(verified(kept(plausible(links, sets, similar), "plausible"), sets, similar), "links")
    labels = kept(components(found), "labels")
    fine = _fine_members(sets, labels, similar)
    for which in (*HUBS, "all"):
        pairs = _cross_links(fine, sets, similar) if which == "all" else _fine_links(fine, similar, which)
        candidates = kept(plausible(kept(pairs, "more-candidates"), sets, similar), "plausible")
        new = kept(verified(candidates, sets, similar), "more-links")
        if new.isEmpty():
            continue
        found = found.unionByName(new)
        ends = labels.select(F.col("node").alias("a"), F.col("label").alias("b"))
        labels = kept(components(ends.unionByName(new)), "labels")
        if which != "all":
            fine = _still_open(fine, labels)
    ends = found.select(F.col("a").alias("node")).unionByName(found.select(F.col("b").alias("node")))
    degrees = ends.groupBy("node").agg(F.count(F.lit(1)).alias("links"))
    placed = classes.join(labels, F.col("a") == F.col("node"), "left").join(degrees, "node", "left")
    placed = kept(placed.select("a", "b", "n_shingles", "rep", F.coalesce("label", "a").alias("label"), F.coalesce("links", F.lit(0)).alias("links")), "placed")
    names = kept(placed.groupBy("label").agg(F.min("rep").alias("component_id")), "names")
    member = kept(placed.join(names, "label").select("a", "b", "n_shingles", "component_id", "links"), "members")
    return known.join(member, ["a", "b", "n_shingles"], "left").select(
        "doc_id",
        "n_shingles",
        "a",
        "b",
        F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.coalesce("links", F.lit(0)).cast("long").alias("links"),
    )


def _still_open(members: DataFrame, labels: DataFrame) -> DataFrame:
    """The members under keys that still hold several components, by their labels of now."""
    names = labels.withColumnRenamed("label", "now")
    now = kept(members.join(names, "node", "left").withColumn("label", F.coalesce("now", "node")).drop("now"), "relabelled")
    still = now.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high")
    return kept(now.join(kept(still.select("key"), "still-open-keys"), "key", "left_semi"), "still-open")


def _fine_members(sets: DataFrame, labels: DataFrame, similar: tuple[int, int]) -> DataFrame:
    """(key, n, node, label, w0..w3): documents under the fine sketches that hold several components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, "set", BATCH_BYTES)):
            keys, owner = fine_keys(*_set_arrays(batch.column("set")), similar)
            yield pa.record_batch([pa.array(keys.view(np.int64)), batch.column("node").take(pa.array(owner))], ["key", "node"])

    entries = kept(sets.select("node", "set").mapInArrow(worker.lean(run), "key long, node long"), "fine-entries")
    shared = entries.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high")
    met = kept(entries.join(kept(shared.select("key"), "shared-keys"), "key", "left_semi"), "met-entries")
    facts = sets.select("node", "n", *WORDS)
    return _still_open(met.join(facts, "node").select("key", "n", "node", *WORDS, F.lit(None).cast("long").alias("label")), labels)


def _may_link(x: str, y: str, similar: tuple[int, int] = SIMILAR) -> Column:
    """Whether sizes and parity bits of two documents of different components allow a link."""
    num, den = similar
    of = lambda side, name: F.col(f"{side}.{name}")
    apart = sum((F.bit_count(of(x, w).bitwiseXOR(of(y, w))) for w in WORDS), F.lit(0))
    n, m = of(x, "n"), of(y, "n")
    return (
        (of(x, "label") != of(y, "label"))
        & (den * F.least(n, m) >= num * F.greatest(n, m))
        & (apart <= F.floor((den - num) * (n + m) / (den + num)))
    )


def _pair(x: str, y: str) -> list[Column]:
    ends = F.col(f"{x}.node"), F.col(f"{y}.node")
    return [F.greatest(*ends).alias("a"), F.least(*ends).alias("b")]


#: Which document of a fine sketch the others are compared with, round by round.
HUBS = ("of the least component", "of the greatest", "drawn by hash")


def _fine_links(members: DataFrame, similar: tuple[int, int], which: str) -> DataFrame:
    """Each document with one of those under its fine sketch."""
    facts = F.struct("label", "node", "n", *WORDS)
    hub = {HUBS[0]: F.min(facts), HUBS[1]: F.max(facts), HUBS[2]: F.min_by(facts, F.xxhash64("key", "node"))}[which]
    hubs = kept(members.groupBy("key").agg(hub.alias("hub")).select("key", "hub.*"), "hubs")
    pairs = members.alias("x").join(hubs.alias("y"), (F.col("x.key") == F.col("y.key")) & _may_link("x", "y", similar))
    return pairs.select(*_pair("x", "y")).distinct()


def _folded(bits: Column) -> Column:
    """Parity bits dealt to half as many places."""
    half = F.floor(F.size(bits) / 2).cast("int")
    return F.zip_with(F.slice(bits, 1, half), F.slice(bits, half + 1, half), lambda a, b: a.bitwiseXOR(b))


def _parted(x: Column, y: Column) -> Column:
    """In how many parity bits two sketches of the same band or of neighbouring ones differ."""

    def differ(a: Column, b: Column) -> Column:
        return F.aggregate(F.zip_with(a, b, lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda n, m: n + m)

    n, m = F.size(x), F.size(y)
    one = F.when(n == m, differ(x, y)).when(n == 2 * m, differ(_folded(x), y)).when(m == 2 * n, differ(x, _folded(y)))
    return one.otherwise(F.lit(0))


def _cross_links(members: DataFrame, sets: DataFrame, similar: tuple[int, int]) -> DataFrame:
    """All pairs of different components left under a fine sketch that sizes and bits can't rule out.

    256 bits say little of sets of many hundred tokens, and documents that share half of their
    tokens meet under some key. So the join has one to two bits a token besides, and what leaves
    it are the pairs near the limit.
    """
    num, den = similar
    own = sets.select("node", F.when(F.size("parity") > 1, _folded(F.col("parity"))).otherwise(F.col("parity")).alias("parity"))
    members = kept(members.join(own.dropDuplicates(["node"]), "node"), "cross-members")
    n = F.col("x.n") + F.col("y.n")
    near = (
        (F.col("x.key") == F.col("y.key")) & (F.col("x.node") > F.col("y.node")) & _may_link("x", "y", similar)
        & (_parted(F.col("x.parity"), F.col("y.parity")) <= F.floor((den - num) * n / (den + num)))
    )
    return members.alias("x").join(members.alias("y"), near).select(*_pair("x", "y")).distinct()
