"""Language identification by interpolated Kneser-Ney character models.

One model per language, all of order ``ORDER``, fitted on a bounded sample of labelled texts
(``sample_chars`` characters a language in expectation, whole texts chosen by hash). Grams are
kept as sorted arrays of 64-bit hashes with one log-probability per language, contexts as sorted
arrays with the languages' back-off weights, so a task scores a batch with a few binary searches.
The model's size is bounded by the sample, not by the corpus; it is the only thing broadcast.

A text is lower-cased, every run of other characters than letters is one space. It gets the
language of the lowest cross-entropy per character (ties: the first name). Rejection is
calibrated on a part of the sample kept out of the fit: a text is rejected when its
cross-entropy lies further above its language's mean than ``SLACK`` times what all but
``REJECTED`` of those texts reach, in deviations that allow for the text's length, and is nearer
to that of evenly drawn letters than to the mean. A text of two known languages stays.

Nulls: a null text, or one without letters, is ``und`` with score 0 and not accepted. Labels that
are null are not learned from. Without any labelled text everything is ``und``. Repeated rows are
judged each. Only the named columns are read.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import worker
from tidemark.llm.bpe import slices

ORDER = 5
SAMPLE_CHARS = 1_500_000
CALIBRATION = 0.25
REJECTED = 0.001
SLACK = 2.0
BATCH_BYTES = 1 << 18  # a task holds some 100 to 300 bytes for each of them
NONE = "und"


def _constants() -> np.ndarray:
    with np.errstate(over="ignore"):
        x = np.arange(1, ORDER + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        return x | np.uint64(1)


C = _constants()
_LETTER: list[np.ndarray] = []


def letter_table() -> np.ndarray:
    """Whether each code point is a letter; made once a process."""
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(i).isalpha() for i in range(sys.maxunicode + 1)), bool))
    return _LETTER[0]


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(29))


def codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(characters, ends, text numbers): normalised texts one after the other.

    Each begins with ``ORDER - 1`` spaces as padding; ``ends`` are the places of the others.
    """
    pad = "\0" * (ORDER - 1)
    lowered = [t.lower() for t in texts]
    whole = np.frombuffer("".join(pad + t for t in lowered).encode("utf-32-le", "surrogatepass"), "<u4")
    of = np.repeat(np.arange(len(texts)), [len(t) + len(pad) for t in lowered])
    padding = np.ones(len(whole), bool)
    if len(pad) < len(whole):
        padding[len(pad) :] = of[len(pad) :] != of[: -len(pad)]
    letter = letter_table()[whole]
    keep = letter | padding
    keep[1:] |= letter[:-1]
    chars = np.where(letter, whole, 32)[keep].astype(np.uint64)
    ends = np.flatnonzero(~padding[keep])
    return chars, ends, of[keep][ends]


def _find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(table):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return at, table[at] == keys


@dataclass
class Model:
    langs: list[str]
    grams: list[np.ndarray] = field(default_factory=list)
    logp: list[np.ndarray] = field(default_factory=list)
    contexts: list[np.ndarray] = field(default_factory=list)
    backoff: list[np.ndarray] = field(default_factory=list)
    base: float = 0.0
    mean: np.ndarray | None = None
    between: np.ndarray | None = None
    within: np.ndarray | None = None
    limit: float = np.inf

    def char_logs(self, chars: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Natural log-probability of each character after its context, by language."""
        out = np.zeros((len(ends), len(self.langs)), np.float32)
        hashes = [chars[ends] * C[0]]
        for j in range(1, ORDER):
            hashes.append(hashes[-1] + chars[ends - j] * C[j])
        left = np.arange(len(ends))
        for n in range(ORDER, 0, -1):
            keys = hashes[n - 1][left]
            at, hit = _find(self.grams[n - 1], mixed(keys))
            out[left[hit]] += self.logp[n - 1][at[hit]]
            left, keys = left[~hit], keys[~hit]
            if not len(left):
                return out
            at, hit = _find(self.contexts[n - 1], mixed(keys - chars[ends[left]] * C[0]))
            out[left[hit]] += self.backoff[n - 1][at[hit]]
        out[left] += self.base
        return out

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(letters, cross-entropies, variances) of texts; bits a character, by language."""
        chars, ends, of = codes(texts)
        logs = self.char_logs(chars, ends) / -np.log(2)
        n = np.bincount(of, minlength=len(texts))
        letters = np.bincount(of, weights=chars[ends] != 32, minlength=len(texts))
        sums, squares = (np.zeros((len(texts), len(self.langs))) for _ in range(2))
        for k in range(len(self.langs)):
            sums[:, k] = np.bincount(of, weights=logs[:, k], minlength=len(texts))
            squares[:, k] = np.bincount(of, weights=logs[:, k] ** 2, minlength=len(texts))
        some = np.maximum(n, 1)[:, None]
        return letters, sums / some, np.maximum(squares / some - (sums / some) ** 2, 0), n

    def deviations(self, entropy: np.ndarray, n: np.ndarray, lang: np.ndarray) -> np.ndarray:
        """How far above its language's mean each text lies."""
        spread = np.sqrt(self.between[lang] + self.within[lang] / np.maximum(n, 1))
        return (entropy - self.mean[lang]) / np.maximum(spread, 1e-6)

    def judge(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """(language, score, cross-entropy, accepted) of each text."""
        if not self.langs:
            none = np.zeros(len(texts))
            return [NONE] * len(texts), none, none, none.astype(bool)
        letters, entropy, _, n = self.entropies(texts)
        best = entropy.argmin(axis=1)
        least = entropy[np.arange(len(texts)), best]
        weight = np.exp2(-np.minimum(n, 30)[:, None] * np.minimum(entropy - least[:, None], 30))
        score = 1 / weight.sum(axis=1)
        halfway = (self.mean[best] - self.base / np.log(2)) / 2
        far = (self.deviations(least, n, best) > self.limit) & (least > halfway)
        accepted = (letters > 0) & ~far
        names = [self.langs[b] if some else NONE for b, some in zip(best, letters > 0)]
        return names, np.where(letters > 0, score, 0.0), least, accepted


def _level(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(gram hash, context hash) of rows of characters, last one last."""
    n = grams.shape[1]
    last = grams[:, ::-1].astype(np.uint64)
    context = (last[:, 1:] * C[1:n]).sum(axis=1, dtype=np.uint64)
    return mixed(context + last[:, 0] * C[0]), mixed(context)


def _estimate(grams: np.ndarray, counts: np.ndarray) -> list[tuple]:
    """Per order from 1 up: (grams, discounted shares, context hashes, back-off weights) of a language."""
    levels = []
    for n in range(ORDER, 0, -1):
        _, context = _level(grams)
        ones, twos = (counts == 1).sum(), (counts == 2).sum()
        discount = ones / (ones + 2 * twos) if ones and twos else 0.5
        names, where, kinds = np.unique(context, return_inverse=True, return_counts=True)
        total = np.bincount(where, weights=counts)
        share = (counts - discount) / total[where]
        levels.append((grams, share, names, discount * kinds / total))
        # the next order down counts how many characters each shorter gram has been seen after
        grams, counts = np.unique(grams[:, 1:], axis=0, return_counts=True)
    return levels[::-1]


def fit(counts: dict[str, tuple[np.ndarray, np.ndarray]]) -> Model:
    """A model from each language's grams of full order (rows of characters) and their counts."""
    model = Model(sorted(counts))
    if not counts:
        return model
    levels = {lang: _estimate(*counts[lang]) for lang in model.langs}
    alphabet = len(np.unique(np.concatenate([v[0][:, -1] for v in counts.values()])))
    model.base = float(-np.log(alphabet + 1))
    lower = None
    for n in range(ORDER):
        grams = np.unique(np.concatenate([levels[lang][n][0] for lang in model.langs]), axis=0)
        gram, context = _level(grams)
        names = np.unique(context)
        p, back = (np.zeros((len(x), len(model.langs))) for x in (grams, names))
        back += 1
        for k, lang in enumerate(model.langs):
            own, share, seen, weight = levels[lang][n]
            back[np.searchsorted(names, seen), k] = weight
            order = np.argsort(gram)
            p[order[np.searchsorted(gram, _level(own)[0], sorter=order)], k] = share
        if lower is None:
            below = np.full((len(grams), len(model.langs)), np.exp(model.base))
        else:
            at, _ = _find(lower[0], _level(grams[:, 1:])[0])
            below = lower[1][at]
        p += back[np.searchsorted(names, context)] * below
        order = np.argsort(gram)
        lower = gram[order], p[order]
        model.grams.append(gram[order])
        model.logp.append(np.log(p[order]).astype(np.float32))
        model.contexts.append(names)
        model.backoff.append(np.log(back).astype(np.float32))
    return model


def sample(labelled: DataFrame, chars: int = SAMPLE_CHARS) -> DataFrame:
    """(text, lang, kept_out): distinct labelled texts, about ``chars`` characters a language, by hash.

    A text counts once, however many copies it has. The text that hashes lowest in its language is
    always drawn and never kept out, so each language is learned.
    """
    rows = labelled.select("text", "lang").where("text is not null and lang is not null")
    rows = rows.withColumn("h", F.xxhash64("text", F.lit(11)))
    texts = rows.groupBy("lang", "h").agg(F.max(F.length("text")).alias("n"))
    sizes = texts.groupBy("lang").agg(F.sum("n").alias("n"), F.min("h").alias("least")).collect()  # a row a language
    share, first = F.lit(0.0), F.lit(False)
    for row in sizes:
        mine = F.col("lang") == row.lang
        share = F.when(mine, min(1.0, chars / max(row.n, 1))).otherwise(share)
        first = F.when(mine, F.col("h") == row.least).otherwise(first)
    place = F.pmod("h", F.lit(1_000_003)) / 1_000_003
    again = F.pmod(F.xxhash64("text", F.lit(12)), F.lit(1_000_003)) / 1_000_003
    drawn = rows.where((place < share) | first).dropDuplicates(["lang", "h"])
    return drawn.select("text", "lang", ((again < CALIBRATION) & ~first).alias("kept_out"))


def train(labelled: DataFrame, chars: int = SAMPLE_CHARS) -> Model:
    """Fit and calibrate on a bounded sample of (text, lang) rows."""
    drawn = sample(labelled, chars)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", BATCH_BYTES):
                held: dict[str, list[str]] = {}
                for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
                    held.setdefault(lang, []).append(text)
                for lang, texts in held.items():
                    letters, ends, _ = codes(texts)
                    rows = letters[ends[:, None] - np.arange(ORDER - 1, -1, -1)].astype("<u4")
                    _, first, n = np.unique(_level(rows)[0], return_index=True, return_counts=True)
                    grams = [row.tobytes() for row in rows[first]]
                    yield pa.record_batch(
                        [pa.array([lang] * len(n)), pa.array(grams, pa.binary()), pa.array(n, pa.int64())], ["lang", "gram", "n"]
                    )

    fitted = drawn.where("not kept_out").select("text", "lang").mapInArrow(worker.lean(count), "lang string, gram binary, n long")
    table = fitted.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    counts = {}
    langs = np.array(table["lang"].to_pylist(), object)
    grams = np.frombuffer(b"".join(table["gram"].to_pylist()), "<u4").reshape(-1, ORDER)
    numbers = table["n"].to_numpy()
    for lang in sorted(set(langs.tolist())):
        mine = langs == lang
        counts[lang] = grams[mine], numbers[mine]
    model = fit(counts)
    if model.langs:
        calibrate(model, drawn.where("kept_out"), drawn)
    return model


def calibrate(model: Model, kept_out: DataFrame, every: DataFrame) -> None:
    """Set each language's mean and deviations, and the limit, from labelled texts."""
    shared = kept_out.sparkSession.sparkContext.broadcast(model)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", BATCH_BYTES):
                _, entropy, variance, n = shared.value.entropies(batch.column("text").to_pylist())
                lang = np.array([shared.value.langs.index(x) if x in shared.value.langs else -1 for x in batch.column("lang").to_pylist()])
                at = np.arange(len(n))
                use = (lang >= 0) & (n > 0)
                yield pa.record_batch(
                    [pa.array(x[use]) for x in (lang.astype(np.int64), n.astype(np.int64), entropy[at, lang], variance[at, lang])],
                    ["lang", "n", "entropy", "variance"],
                )

    schema = "lang long, n long, entropy double, variance double"
    got = kept_out.mapInArrow(worker.lean(measure), schema).toPandas()
    if not len(got):  # too few texts to keep any out
        got = every.mapInArrow(worker.lean(measure), schema).toPandas()
    shared.destroy()  # workers that live on give its memory back
    model.mean, model.between, model.within = (np.zeros(len(model.langs)) for _ in range(3))
    for k in range(len(model.langs)):
        mine = got[got.lang == k] if (got.lang == k).any() else got
        weight = mine.n / mine.n.sum()
        model.mean[k] = (mine.entropy * weight).sum()
        model.within[k] = (mine.variance * weight).sum()
        long = mine[mine.n >= 200] if (mine.n >= 200).sum() > 1 else mine
        model.between[k] = max(1e-3, long.entropy.var(ddof=0))
    off = model.deviations(got.entropy.to_numpy(), got.n.to_numpy(), got.lang.to_numpy())
    model.limit = max(4.0, float(np.quantile(off, 1 - REJECTED))) * SLACK


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score, cross_entropy, accepted) of (doc_id, text) rows."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "lang_pred", "score", "cross_entropy", "accepted"]
        for whole in batches:
            for batch in slices(whole, "text", BATCH_BYTES):
                texts = [t or "" for t in batch.column("text").to_pylist()]
                lang, score, entropy, accepted = shared.value.judge(texts)
                yield pa.record_batch([batch.column("doc_id"), pa.array(lang, pa.string()), *map(pa.array, (score, entropy, accepted))], names)

    schema = "doc_id long, lang_pred string, score double, cross_entropy double, accepted boolean"
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(worker.lean(run), schema)


def keep_accepted(docs: DataFrame, model: Model) -> DataFrame:
    """The rows whose text is accepted, with their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", BATCH_BYTES):
                accepted = shared.value.judge([t or "" for t in batch.column("text").to_pylist()])[3]
                yield batch.filter(pa.array(accepted))

    return docs.mapInArrow(worker.lean(run), docs.schema)


def held_out(doc_id: str = "doc_id"):
    """Whether a document belongs to the quarter that is not learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))
