"""Exact deduplication over a persistent digest index.

The index is a Parquet table bucketed and sorted by the 256-bit digest of the normalised text,
one row per distinct text. New rows are reduced to one per digest, compared with the index by a
sort-merge anti-join that reads the index by its buckets, and appended.

Nulls: a null text counts as empty, so all null and empty texts are one group. A null id sorts
below every other id. Ties: rows with equal text and id are all "kept" rows of the group. An
empty input leaves the index as it is and gives no rows. Only the id and text columns named by
the caller are read, so extra columns and their names don't matter. An index that is opened again
keeps the number of buckets it was made with.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import session
from tidemark.llm.tables import free_names, kept
from tidemark.sources import folders

SCHEMA = "digest binary, keep_id long"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def digest(text: Column) -> Column:
    """SHA-256 of a whole text with A-Z lower-cased and nothing else; a null text is empty."""
    plain = F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower())
    return F.unhex(F.sha2(plain, 256))


def digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, digest) of each row."""
    return docs.select(F.col(doc_id).alias("doc_id"), digest(F.col(text)).alias("digest"))


class IndexMismatch(ValueError):
    """An index was made with another number of buckets, or is none."""


class DigestIndex:
    """A table of the digests seen so far, each with the row that stays for it.

    The number of buckets is kept in a small file beside the data (``_buckets``) from the
    table's making on, since rows would be missed if the files were read as other buckets than they are.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None):
        """``buckets``: for a new index, by default as many as the session has shuffle partitions."""
        self.spark, self.path = spark, path
        self.buckets = self._kept_buckets(buckets)
        self.name = "digest_index_" + hashlib.sha256(path.encode()).hexdigest()[:32]
        spark.sql(f"DROP TABLE IF EXISTS {self.name}")  # the name only; the files are the index
        escaped = path.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE {self.name} ({SCHEMA}) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{escaped}'"
        )

    def _kept_buckets(self, asked: int | None) -> int:
        note = f"{self.path}/_buckets"
        if folders.exists(self.spark, note):
            known = int(folders.read(self.spark, note))
            if asked not in (None, known):
                raise IndexMismatch(f"{self.path} has {known} buckets, not {asked}")
            return known
        if folders.exists(self.spark, self.path):
            raise IndexMismatch(f"{self.path} is there, but how many buckets it has {note} does not tell")
        new = asked or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        folders.overwrite(self.spark, note, str(new).encode())
        return new

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def append(self, new: DataFrame) -> None:
        """Add the texts of ``new`` (digest rows) that the index lacks; of equal ones the largest id."""
        best = new.groupBy("digest").agg(F.max("doc_id").alias("keep_id"))
        known = self.rows().select("digest").hint("merge")
        fresh = kept(best.join(known, "digest", "left_anti"), "fresh-digests")
        (
            fresh.repartition(self.buckets, "digest")
            .write.bucketBy(self.buckets, "digest").sortBy("digest")
            .format("parquet").mode("append").saveAsTable(self.name)
        )

    def drop(self) -> None:
        """Forget the table's name; the files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def classes(index: DigestIndex, seen: DataFrame) -> DataFrame:
    """(digest, keep_id, group_size) of the texts of ``seen``; the index is read by its buckets."""
    sizes = seen.groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"))
    return index.rows().hint("merge").join(sizes, "digest")


def members(judged: DataFrame, seen: DataFrame) -> DataFrame:
    """Each row of ``seen`` with the row that stays for its text and the number of equal texts.

    A digest may hold a third of all rows: counts combine before their shuffle, and the join runs
    between two stored tables, where adaptive execution splits a hot digest over many tasks.
    """
    return seen.hint("merge").join(judged, "digest").select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def dedup(docs: DataFrame, batches: Sequence | None = None, path: str | None = None) -> DataFrame:
    """Every row of ``docs`` judged against an index at ``path`` (a fresh one by default).

    ``batches``: conditions that part the rows; each part is appended in that order. With newest
    ids first, the largest id of each text stays whatever the number of batches.
    """
    spark = docs.sparkSession
    index = DigestIndex(spark, path or session.scratch_path(spark, "digest-index"))
    seen = kept(digests(docs), "digests")
    for part in batches or [F.lit(True)]:
        index.append(seen.where(part))
    judged = kept(classes(index, seen), "classes")
    index.drop()  # the name; the files stay
    return members(judged, seen)


def halves(docs: DataFrame) -> list:
    """Two batches by id, the later ids first. Ids alone are read, or only their statistics."""
    low, high = docs.agg(F.min("doc_id"), F.max("doc_id")).first()
    if low is None:
        return [F.lit(True)]
    middle = (low + high) // 2
    late = F.coalesce(F.col("doc_id") > middle, F.lit(False))
    return [late, ~late]


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with their columns; one row where id and text repeat."""
    names = free_names(docs, "id", "no_id", "digest")
    of = lambda key: [F.coalesce(F.col("doc_id"), F.lit(0)), F.col("doc_id").isNull(), key]
    stay = dedup(docs, halves(docs)).where("kept")
    stay = stay.select(*[c.alias(n) for c, n in zip(of(F.unhex("text_sha256")), names)])
    marked = docs.withColumns(dict(zip(names, of(digest(F.col("text"))))))
    # joined and told apart by the same columns: rows are shuffled once
    return marked.join(stay, names, "left_semi").dropDuplicates(names).select(*[marked[c] for c in docs.columns])
