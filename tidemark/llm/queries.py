"""The registered queries of this package."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import session
from tidemark.llm import (
    bpe, centroids, chat, collocations, decontam, exact_dedup, jaccard, langid, minhash, phrases, pii,
    suffix_dedup, token_files,
)
from tidemark.llm.tables import table


def op2_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.similar_documents(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


def op3_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs.where(~langid.held_out()))
    judged = langid.identify(docs, model)
    return judged.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score", "cross_entropy", "accepted")


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = session.scratch_path(spark, "token-files")
    manifest = token_files.write(table(spark, sf_dir, "documents"), tokenizer_path(), folder)
    return token_files.read(manifest, folder, digest=True)


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return exact_dedup.dedup(docs, exact_dedup.halves(docs))


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.chat_format(table(spark, sf_dir, "conversations"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer_path()
    coded = bpe.encode(table(spark, sf_dir, "documents"), path)
    return bpe.decode(coded, path).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.spans(table(spark, sf_dir, "documents"))
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["kind"].isin(*pii.BASE))
    return found.select(
        "doc_id",
        *[of(kind).alias(f"n_{kind}") for kind in pii.BASE],
        F.sha2(pii.listed(base), 256).alias("base_sha256"),
        pii.listed(F.col("spans")).alias("spans"),
    )


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removal(table(spark, sf_dir, "documents"))


def op10_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.removal(table(spark, sf_dir, "documents"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.similar_documents(table(spark, sf_dir, "documents")).drop("links")


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.clusters(table(spark, sf_dir, "embeddings")).drop("n_exact")


QUERIES = {
    "op1_langid": op1_langid,
    "op2_jaccard": op2_jaccard,
    "op3_decontam": op3_decontam,
    "op4_token_files": op4_token_files,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_chat_format": op6_chat_format,
    "op7_bpe": op7_bpe,
    "op8_pii": op8_pii,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_phrases": op10_phrases,
    "op11_collocations": op11_collocations,
    "op12_minhash": op12_minhash,
    "op13_centroids": op13_centroids,
}
