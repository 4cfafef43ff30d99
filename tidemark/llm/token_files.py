"""Token files: ids of documents in patched frame-of-reference blocks.

A file holds the ids of its documents one after the other in blocks of ``BLOCK``. A block stores
its minimum, the differences to it packed at the bit width that ``PERCENTILE`` of them need, and
the ids that need more as an exception list (place, id). The footer indexes every block's start,
every document's id and first id, so a reader can seek. Layout, little-endian:

    magic "TMPF" + version            8 bytes
    block: minimum u32, width u8, 0 u8, exceptions u16, packed 16 * width bytes,
           places u8 * exceptions, ids u32 * exceptions
    footer: block starts u64 * (blocks + 1), doc ids i64 * docs, doc has id u8 * docs,
            first ids u64 * (docs + 1)
    tail: blocks u64, docs u64, footer start u64, magic

Tasks write under names of their own attempt; the manifest, one row per file of a task that ended
well, says which files count, so a lost executor leaves an unlisted file and nothing else.

Nulls: a null text is empty, so the document holds the end id alone; null ids sort first and come
back null. Equal ids are ordered by text hash; repeated rows are written each. An empty table gives
a manifest without rows.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.bpe import coder_of, slices
from tidemark.llm.tables import kept

BLOCK = 128
PERCENTILE = 0.9
END_ID = 1
MAGIC = b"TMPF\x01\0\0\0"
HEAD = 8
GROUP = 4096  # blocks that are packed or unpacked together
MANIFEST = "part int, path string, n_docs long, n_ids long, n_blocks long, n_bytes long"


def _widths(top: np.ndarray) -> np.ndarray:
    """Bits that each value needs."""
    return np.searchsorted(np.left_shift(np.uint64(1), np.arange(33, dtype=np.uint64)), top, "right")


def pack(ids: np.ndarray, percentile: float = PERCENTILE) -> tuple[bytes, np.ndarray]:
    """The blocks of some ids and the size of each; ids fill whole blocks but the last."""
    n = -(-len(ids) // BLOCK)
    low = np.zeros((n, BLOCK), np.uint64)
    low.reshape(-1)[: len(ids)] = ids
    low.reshape(-1)[len(ids) :] = ids[-1] if len(ids) else 0
    least = low.min(axis=1)
    low -= least[:, None]
    kth = min(BLOCK - 1, max(0, int(np.ceil(percentile * BLOCK)) - 1))
    width = _widths(np.partition(low, kth, axis=1)[:, kth])
    over = (low >> width[:, None].astype(np.uint64)) != 0
    rows, places = np.nonzero(over)
    exact = (low[rows, places] + least[rows]).astype("<u4")
    low[over] = 0
    n_over = over.sum(axis=1)
    sizes = HEAD + width * (BLOCK // 8) + 5 * n_over
    starts = np.concatenate([[0], np.cumsum(sizes)])
    out = np.zeros(starts[-1], np.uint8)
    head = np.zeros(n, [("least", "<u4"), ("width", "u1"), ("pad", "u1"), ("over", "<u2")])
    head["least"], head["width"], head["over"] = least, width, n_over
    out[starts[:-1, None] + np.arange(HEAD)] = head.view(np.uint8).reshape(n, HEAD)
    for w in np.unique(width[width > 0]).tolist():
        mine = np.flatnonzero(width == w)
        values, words = np.ascontiguousarray(low[mine].T), np.zeros((2 * w, len(mine)), np.uint64)
        for i in range(BLOCK):
            word, shift = divmod(i * w, 64)
            words[word] |= values[i] << np.uint64(shift)
            if shift + w > 64:
                words[word + 1] |= values[i] >> np.uint64(64 - shift)
        packed = np.ascontiguousarray(words.T).astype("<u8").view(np.uint8)
        out[starts[mine][:, None] + HEAD + np.arange(16 * w)] = packed
    rank = np.arange(len(rows)) - np.repeat(np.cumsum(n_over) - n_over, n_over)
    at = starts[rows] + HEAD + 16 * width[rows]
    out[at + rank] = places
    out[(at + n_over[rows] + 4 * rank)[:, None] + np.arange(4)] = exact.view(np.uint8).reshape(-1, 4)
    return out.tobytes(), sizes


def unpack(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The ids of whole blocks that begin at ``starts`` in ``data`` (bytes)."""
    n = len(starts)
    head = data[starts[:, None] + np.arange(HEAD)].reshape(-1).view(
        [("least", "<u4"), ("width", "u1"), ("pad", "u1"), ("over", "<u2")]
    )
    width, n_over = head["width"].astype(np.int64), head["over"].astype(np.int64)
    out = np.zeros((n, BLOCK), np.uint32)
    for w in np.unique(width[width > 0]).tolist():
        mine = np.flatnonzero(width == w)
        packed = data[starts[mine][:, None] + HEAD + np.arange(16 * w)]
        words = np.ascontiguousarray(np.ascontiguousarray(packed).view("<u8").T)
        values, mask = np.empty((BLOCK, len(mine)), np.uint32), np.uint64((1 << w) - 1)
        for i in range(BLOCK):
            word, shift = divmod(i * w, 64)
            value = words[word] >> np.uint64(shift)
            if shift + w > 64:
                value = value | (words[word + 1] << np.uint64(64 - shift))
            values[i] = value & mask
        out[mine] = values.T
    out += head["least"][:, None]
    rows = np.repeat(np.arange(n), n_over)
    rank = np.arange(len(rows)) - np.repeat(np.cumsum(n_over) - n_over, n_over)
    at = starts[rows] + HEAD + 16 * width[rows]
    exact = data[(at + n_over[rows] + 4 * rank)[:, None] + np.arange(4)]
    out[rows, data[at + rank]] = np.ascontiguousarray(exact).view("<u4").reshape(-1)
    return out.reshape(-1)


#: Names that the store's own reader has for what Spark names otherwise.
SCHEMES = {"s3a": "s3", "s3n": "s3"}


def _store(folder: str):
    """(file system, path) of a folder; raises where its kind of store can't be written from a task."""
    from pyarrow import fs

    scheme, mark, rest = folder.partition("://")
    try:
        return fs.FileSystem.from_uri(f"{SCHEMES.get(scheme, scheme)}{mark}{rest}")
    except (pa.ArrowInvalid, OSError) as error:
        raise ValueError(f"token files can't be kept under {folder}: {error}") from error


class Writer:
    """One file, written front to back; memory holds ``GROUP`` blocks and 17 bytes a document."""

    def __init__(self, stream):
        self.stream, self.at = stream, len(MAGIC)
        stream.write(MAGIC)
        self.parts, self.waiting, self.n_ids = [], 0, 0
        self.sizes, self.doc_ids, self.lengths = [], [], []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.doc_ids.append(doc_id)
        self.lengths.append(len(ids))
        self.parts.append(ids)
        self.waiting += len(ids)
        self.n_ids += len(ids)
        if self.waiting >= BLOCK * GROUP:
            self._flush(self.waiting // BLOCK * BLOCK)

    def _flush(self, n: int) -> None:
        ids = np.concatenate(self.parts) if self.parts else np.zeros(0, np.uint32)
        data, sizes = pack(ids[:n])
        self.stream.write(data)
        self.at += len(data)
        self.sizes.append(sizes)
        self.parts, self.waiting = [ids[n:]], len(ids) - n

    def close(self) -> tuple[int, int]:
        """(blocks, bytes) of the file."""
        self._flush(self.waiting)
        sizes = np.concatenate(self.sizes)
        blocks = np.concatenate([[0], np.cumsum(sizes)]).astype("<u8") + np.uint64(len(MAGIC))
        firsts = np.concatenate([[0], np.cumsum(self.lengths)]).astype("<u8")
        ids = np.array([0 if d is None else d for d in self.doc_ids], "<i8")
        has = np.array([d is not None for d in self.doc_ids], np.uint8)
        footer = b"".join(x.tobytes() for x in (blocks, ids, has, firsts))
        tail = struct.pack("<QQQ", len(sizes), len(ids), self.at) + MAGIC
        self.stream.write(footer + tail)
        self.stream.close()
        return len(sizes), self.at + len(footer) + len(tail)


class Reader:
    """Reads a file's index, then runs of documents by seeking to their blocks."""

    def __init__(self, file):
        self.file, size = file, file.size()
        n, docs, at, magic = struct.unpack("<QQQ8s", file.read_at(32, size - 32))
        if magic != MAGIC:
            raise ValueError("not a token file")
        footer = file.read_at(size - 32 - at, at)
        cut = np.cumsum([0, 8 * (n + 1), 8 * docs, docs, 8 * (docs + 1)])
        kinds = ("<u8", "<i8", np.uint8, "<u8")
        parts = [np.frombuffer(footer[a:b], k) for a, b, k in zip(cut, cut[1:], kinds)]
        self.blocks, self.doc_ids, self.has_id, self.firsts = parts

    def ids(self, first: int, last: int) -> np.ndarray:
        """Ids [first, last) of the file."""
        if first >= last:
            return np.zeros(0, np.uint32)
        a, b = first // BLOCK, -(-last // BLOCK)
        begin, end = int(self.blocks[a]), int(self.blocks[b])
        data = np.frombuffer(self.file.read_at(end - begin, begin), np.uint8)
        ids = unpack(data, (self.blocks[a:b] - self.blocks[a]).astype(np.int64))
        return ids[first - a * BLOCK : last - a * BLOCK]

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(doc id, first id, ids) of each document, some ``GROUP`` blocks at a time."""
        at, most = 0, BLOCK * GROUP
        firsts = self.firsts.astype(np.int64)
        while at < len(self.doc_ids):
            to = max(at + 1, int(np.searchsorted(firsts, firsts[at] + most, "right")) - 1)
            ids = self.ids(firsts[at], firsts[to])
            for k in range(at, to):
                part = ids[firsts[k] - firsts[at] : firsts[k + 1] - firsts[at]]
                yield (int(self.doc_ids[k]) if self.has_id[k] else None), int(firsts[k]), part
            at = to


def write(docs: DataFrame, tokenizer: str, folder: str, end_id: int = END_ID) -> DataFrame:
    """Write (doc_id, text) as token files in ascending id order; the stored manifest.

    Rows go to files by ranges of id, then text hash, so no id is a file of its own making; a file
    is as large as the shuffle's partitions are set to be.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        coder, writer, path = coder_of(tokenizer), None, ""
        store, root = _store(folder)
        part = TaskContext.get().partitionId()
        end = np.array([end_id], np.uint32)
        for whole in batches:
            for batch in slices(whole, "text"):
                if writer is None:
                    store.create_dir(root)
                    path = f"{root}/{part:06d}-{uuid.uuid4().hex}.tok"
                    writer = Writer(store.open_output_stream(path))
                texts = batch.column("text").cast(pa.binary()).to_pylist()
                for doc_id, ids in zip(batch.column("doc_id").to_pylist(), coder.encode(texts)):
                    writer.add(doc_id, np.concatenate([ids, end]))
        if writer is not None:
            n_blocks, n_bytes = writer.close()
            values = (part, path.rsplit("/", 1)[1], len(writer.doc_ids), writer.n_ids, n_blocks, n_bytes)
            kinds = (pa.int32(), pa.string(), *[pa.int64()] * 4)
            names = [x.split()[0] for x in MANIFEST.split(", ")]
            yield pa.record_batch([pa.array([v], k) for v, k in zip(values, kinds)], names)

    _store(folder)  # fails now rather than in the last stage
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    ordered = rows.withColumn("_tie", F.xxhash64("text")).repartitionByRange("doc_id", "_tie")
    written = ordered.sortWithinPartitions("doc_id", "_tie").select("doc_id", "text").mapInArrow(run, MANIFEST)
    return kept(written, "token-manifest")


def read(manifest: DataFrame, folder: str, digest: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids): the documents of a manifest's files.

    ``start`` counts the ids of all documents before it, over all files. With ``digest`` the ids
    are replaced by ``ids_crc32``, their CRC as little-endian unsigned 32-bit integers.
    """
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.select("path", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base"))
    last, kind = ("ids_crc32", "long") if digest else ("ids", "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _store(folder)
        names = ["doc_id", "start", "n_tokens", last]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64() if digest else pa.binary()]
        for batch in batches:
            for path, base in zip(batch.column("path").to_pylist(), batch.column("base").to_pylist()):
                rows, held = [], 0
                with store.open_input_file(f"{root}/{path}") as file:
                    for doc_id, first, ids in Reader(file).documents():
                        data = ids.astype("<u4").tobytes()
                        rows.append((doc_id, base + first, len(ids), zlib.crc32(data) if digest else data))
                        held += len(data)
                        if held > 16 << 20:
                            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                            rows, held = [], 0
                if rows:
                    yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    spread = files.repartition(manifest.count() or 1, "path")
    return spread.mapInArrow(run, f"doc_id long, start long, n_tokens long, {last} {kind}")
