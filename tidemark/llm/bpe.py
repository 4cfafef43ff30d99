"""BPE encoding and decoding with a public tokenizer.

A tokenizer whose pre-tokenizer drops white space codes each run between ASCII white space on its
own, so a task keeps the codes of the runs it has met and looks further ones up; the library codes
only new runs, many of them in one text with a mark between them. Other tokenizers code whole texts
by the library.

Long unsplit text (``LONG`` characters or more, or a run of ``UNSPLIT`` without white space) is
coded by tree concatenation: the text is halved until its parts are short, the parts are coded in
parallel as rows of their own, and neighbours are joined up the tree, all joins of a level in
parallel. At a join the text around it is coded again in a growing window until the window's codes
agree with both sides' (same place, same id, several in a row), and is spliced there; a window that
has grown over both sides is the code itself. Adjacent codes that agree with a longer coding on both sides stay valid, because whether
a sequence is the code of its text hangs on neighbouring pairs only.

Ids travel as bytes, little-endian unsigned 32-bit, so no row holds an array object per id.

Nulls: a null text is empty and has no ids; null ids decode to an empty text; the document id may
be null. Repeated rows are coded each. Only the named columns are read.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from functools import cached_property, lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import worker
from tidemark.llm.tables import kept

UNSPLIT = 8192
LONG = 65_536
PART = 8192
AGREE = 4
MARK = "\x01"
MARKED = 2048  # runs coded in one text
CACHED_RUNS = 400_000
BATCH_BYTES = 8 << 20
CODED = "doc_id long, n_tokens long, ids binary"


def load(path: str):
    """The tokenizer of a file, without padding and truncation."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_padding()
    tokenizer.no_truncation()
    return tokenizer


class Coder:
    """Encodes and decodes whole texts in one task."""

    def __init__(self, path: str, cached: int = CACHED_RUNS):
        import json

        self.path, self.cached = path, cached
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        text = json.dumps([spec["pre_tokenizer"]])
        self.by_run = '"invert": true' in text and '"Removed"' in text and "[^\\\\s" in text
        self.lowers = self.by_run and '"Lowercase"' in json.dumps(spec["normalizer"])
        ids = {**spec["model"]["vocab"], **{t["content"]: t["id"] for t in spec["added_tokens"]}}
        self.kind = np.uint16 if max(ids.values()) < 1 << 16 else np.uint32
        # two generations: what a text asked for lately is in the newer one
        self.seen: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.words = {i: w.encode() for w, i in ids.items()} if spec["decoder"] is None else None

    @cached_property
    def tokenizer(self):
        return load(self.path)

    @cached_property
    def mark(self) -> int | None:
        """The id that the mark always has, if it is one id, however it is surrounded."""
        ids = self.tokenizer.encode(f"a {MARK} . {MARK} 1", add_special_tokens=False).ids
        alone = self.tokenizer.encode(MARK, add_special_tokens=False).ids
        return alone[0] if len(alone) == 1 and ids.count(alone[0]) == 2 else None

    def _code(self, texts: list[bytes]) -> list[bytes]:
        whole = [t.decode("utf-8", "replace") for t in texts]
        coded = self.tokenizer.encode_batch_fast(whole, add_special_tokens=False)
        return [np.array(c.ids, self.kind).tobytes() for c in coded]

    def _code_runs(self, runs: list[bytes]) -> list[bytes]:
        """As ``_code``, for runs without white space: many of them are coded as one text."""
        if self.mark is None or any(MARK.encode() in r for r in runs):
            return self._code(runs)
        out: list[bytes] = []
        groups = [runs[k : k + MARKED] for k in range(0, len(runs), MARKED)]
        joined = [f" {MARK} ".join([r.decode("utf-8", "replace") for r in g]) for g in groups]
        for group, coded in zip(groups, self.tokenizer.encode_batch_fast(joined, add_special_tokens=False)):
            ids = np.array(coded.ids, self.kind)
            ends = np.flatnonzero(ids == self.mark)
            if len(ends) != len(group) - 1:
                out += self._code(group)
                continue
            data, size = ids.tobytes(), ids.itemsize
            cuts = [0, *((ends + 1) * size).tolist()]
            stops = [*(ends * size).tolist(), len(data)]
            out += [data[i:j] for i, j in zip(cuts, stops)]
        return out

    def _learn(self, runs: set[bytes]) -> None:
        """Code the runs; a last stop or comma after a letter is a piece of its own."""
        older = self.older
        for r in runs & older.keys():
            self.seen[r] = older[r]
        runs = runs - older.keys()
        tails = [r for r in runs if len(r) > 1 and r[-1] in b".," and r[-2:-1].isalpha()]
        new = list((runs.difference(tails) | {r[:-1] for r in tails} | {b".", b","}) - self.seen.keys())
        self.seen.update(zip(new, self._code_runs(new)))
        for r in tails:
            self.seen[r] = self.seen[r[:-1]] + self.seen[r[-1:]]

    def encode(self, texts: list[bytes | None]) -> Iterator[np.ndarray]:
        """The ids of each text, as unsigned 32-bit integers."""
        if not self.by_run:
            for text in texts:
                yield np.frombuffer(self._code([text or b""])[0], self.kind).astype("<u4")
            return
        for start in range(0, len(texts), 256):
            if 2 * len(self.seen) > self.cached:
                self.seen, self.older = {}, self.seen
            runs = []
            for text in texts[start : start + 256]:
                text = text or b""
                # the library looks for special tokens before it lowers case
                runs.append((text.lower() if self.lowers and b"<|" not in text else text).split())
            new = set().union(*runs) - self.seen.keys()
            if new:
                self._learn(new)
            seen = self.seen
            for parts in runs:
                yield np.frombuffer(b"".join(map(seen.__getitem__, parts)), self.kind).astype("<u4")
            for run in [r for r in new if len(r) > 64]:
                del seen[run]

    def decode(self, ids: np.ndarray) -> bytes:
        """The library's text of ids; without a decoder it joins the tokens by spaces."""
        if self.words is None:
            return self.tokenizer.decode(ids.tolist(), skip_special_tokens=False).encode()
        return b" ".join(map(self.words.__getitem__, ids.tolist()))


@lru_cache(maxsize=2)
def coder_of(path: str) -> Coder:
    """The process's coder of a tokenizer: a worker's later tasks know the runs of its earlier ones."""
    return Coder(path)


worker.cache("coder", coder_of.cache_clear)


def slices(batch: pa.RecordBatch, column: str, most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows whose ``column`` holds about ``most`` bytes, or one longer row."""
    ends = np.cumsum(pa.compute.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + most, "right")))
        yield batch.slice(at, to - at)
        at = to


def _encoder(path: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = coder_of(path)
        for whole in batches:
            for batch in slices(whole, "text"):
                texts = batch.column("text").cast(pa.binary()).to_pylist()
                coded = list(coder.encode(texts))
                yield pa.record_batch(
                    [
                        batch.column("doc_id"),
                        pa.array([len(c) for c in coded], pa.int64()),
                        pa.array([c.tobytes() for c in coded], pa.binary()),
                    ],
                    ["doc_id", "n_tokens", "ids"],
                )

    return worker.lean(run, "coder")


def parts_of(text: str, part: int) -> list[tuple[int, str]]:
    """(first character, part): a text halved until its parts have ``part`` characters at most.

    As many parts as a power of two, so that neighbours pair up on every level.
    """
    count = 1
    while count * part < len(text):
        count *= 2
    cuts = [len(text) * k // count for k in range(count + 1)]
    return [(a, text[a:b]) for a, b in zip(cuts, cuts[1:])]


#: A part's codes: rows (first character, past the last character, id).
def located(tokenizer, text: str, first: int) -> np.ndarray:
    coded = tokenizer.encode(text, add_special_tokens=False)
    spans = np.array(coded.offsets, np.int64).reshape(-1, 2) + first
    return np.column_stack([spans, np.array(coded.ids, np.int64)])


def _meet(side: np.ndarray, window: np.ndarray, low: int, high: int, agree: int) -> tuple[int, int] | None:
    """Where ``agree`` codes in a row within [low, high) are the same in both."""
    w = np.flatnonzero((window[:, 0] >= low) & (window[:, 1] <= high))
    s = np.flatnonzero((side[:, 0] >= low) & (side[:, 1] <= high))
    places: dict[tuple, list[int]] = {}
    for i in s[: len(s) - agree + 1].tolist():
        places.setdefault(tuple(side[i]), []).append(i)
    for j in w[: len(w) - agree + 1].tolist():
        for i in places.get(tuple(window[j]), ()):
            if np.array_equal(side[i : i + agree], window[j : j + agree]):
                return i, j
    return None


def join(tokenizer, text: str, first: int, left: np.ndarray, cut: int, right: np.ndarray, agree: int = AGREE) -> np.ndarray:
    """The codes of two neighbouring parts as one; ``text`` is both, ``first`` its place."""
    low, high, reach = first, first + len(text), 32
    while True:
        a, b = max(low, cut - reach), min(high, cut + reach)
        window = located(tokenizer, text[a - low : b - low], a)
        start = (0, 0) if a == low else _meet(left, window, a, cut, agree)
        end = (len(right), len(window)) if b == high else _meet(right, window, cut, b, agree)
        if start and end:
            return np.concatenate([left[: start[0]], window[start[1] : end[1]], right[end[0] :]])
        reach *= 2


TREE = "doc_id long, copies long, digest binary, n int, at int, place long, part string, codes binary"


def _encode_long(long: DataFrame, path: str, part: int) -> DataFrame:
    """(doc_id, n_tokens, ids) of long texts, by tree concatenation; one join of two parts a row."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                parts = parts_of(row["text"], part)
                rest = {k: [row[k]] * len(parts) for k in ("doc_id", "copies", "digest")}
                places, texts = zip(*parts)
                yield pa.RecordBatch.from_pydict(
                    {**rest, "n": [len(parts)] * len(parts), "at": list(range(len(parts))), "place": places, "part": texts},
                    schema=pa.schema([
                        ("doc_id", pa.int64()), ("copies", pa.int64()), ("digest", pa.binary()), ("n", pa.int32()),
                        ("at", pa.int32()), ("place", pa.int64()), ("part", pa.string()),
                    ]),
                )

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = coder_of(path).tokenizer
        for whole in batches:
            for batch in slices(whole, "part"):
                pairs = zip(batch.column("part").to_pylist(), batch.column("place").to_pylist())
                codes = [located(tokenizer, text, place).tobytes() for text, place in pairs]
                yield pa.record_batch([*batch.columns, pa.array(codes, pa.binary())], [*batch.schema.names, "codes"])

    def up(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("at")
        if len(frame) == 2:
            a, b = frame.itertuples(index=False)
            text = a.part + b.part
            codes = [np.frombuffer(x.codes, np.int64).reshape(-1, 3) for x in (a, b)]
            whole = join(coder_of(path).tokenizer, text, a.place, codes[0], b.place, codes[1])
            frame = frame.iloc[:1].assign(part=text, codes=np.ascontiguousarray(whole).tobytes())
        return frame.assign(n=frame["n"] // 2, at=frame["at"] // 2)[[x.split()[0] for x in TREE.split(", ")]]

    def ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.frombuffer(c, np.int64).reshape(-1, 3)[:, 2].astype("<u4") for c in batch.column("codes").to_pylist()]
            columns = [pa.array([len(f) for f in found], pa.int64()), pa.array([f.tobytes() for f in found], pa.binary())]
            yield pa.record_batch([batch.column("doc_id"), batch.column("copies"), *columns], ["doc_id", "copies", "n_tokens", "ids"])

    distinct = long.withColumn("digest", F.unhex(F.sha2("text", 256))).groupBy("doc_id", "digest").agg(
        F.first("text").alias("text"), F.count(F.lit(1)).alias("copies")
    )
    parts = distinct.select("doc_id", "copies", "digest", "text").mapInArrow(cut, TREE.removesuffix(", codes binary"))
    parts = parts.repartition("doc_id", "digest", "at").mapInArrow(code, TREE)
    tree, whole = kept(parts, "parts"), None
    most = tree.agg(F.max("n")).first()[0] or 1
    for _ in range(most.bit_length() - 1):
        done = tree.where("n = 1")
        whole = done if whole is None else whole.unionByName(done)
        joins = tree.where("n > 1").groupBy("doc_id", "copies", "digest", F.expr("at div 2"))
        tree = kept(joins.applyInPandas(up, TREE), "joined")
    whole = tree if whole is None else whole.unionByName(tree)
    found = whole.select("doc_id", "copies", "codes").mapInArrow(ids, "doc_id long, copies long, n_tokens long, ids binary")
    return found.select("doc_id", "n_tokens", "ids", F.explode(F.expr("array_repeat(0, int(copies))"))).drop("col")


def encode(docs: DataFrame, path: str, unsplit: int = UNSPLIT, long: int = LONG, part: int = PART) -> DataFrame:
    """(doc_id, n_tokens, ids): the whole texts of (doc_id, text) coded by the tokenizer at ``path``."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    run = (F.length("text") >= unsplit) & F.col("text").rlike(r"[^ \t\n\r\x0B\f]{%d}" % unsplit)
    is_long = (F.length("text") >= long) | run
    short = rows.where(~is_long).mapInArrow(_encoder(path), CODED)
    return short.unionByName(_encode_long(rows.where(is_long), path, min(part, unsplit)))


def decode(coded: DataFrame, path: str) -> DataFrame:
    """``coded`` with the decoded ``text`` of its ``ids``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = coder_of(path)
        for whole in batches:
            for batch in slices(whole, "ids", BATCH_BYTES // 2):
                texts = [
                    coder.decode(np.frombuffer(ids or b"", "<u4")) for ids in batch.column("ids").to_pylist()
                ]
                text = pa.array(texts, pa.binary()).cast(pa.string())
                yield pa.record_batch([*batch.columns, text], [*batch.schema.names, "text"])

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in coded.schema.fields)
    return coded.mapInArrow(run, f"{kept}, text string")
