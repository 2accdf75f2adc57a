"""Queries op1 to op10 over the whole tables, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import table
from . import bpe, jaccard, media, mixing, ngram, privacy, quality, secrets, tokenstore, warc


def op1_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trigram perplexity of every document under a model of the whole corpus."""
    docs = table(spark, sf_dir, "documents")
    return ngram.scored(docs, ngram.trained(docs))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every secret in the documents, by its marginal compressed bytes."""
    return secrets.findings(table(spark, sf_dir, "documents"))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's group and number of links by a Jaccard similarity of word 3-gram sets of 0.5 or more."""
    return jaccard.joined(table(spark, sf_dir, "documents"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages as monolithic files, rewritten with a member a record, each read back by its offset."""
    return warc.rewritten(table(spark, sf_dir, "pages"))


def warc_read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the members of op4 hold, without their places, which SQL can't know."""
    return warc.rewritten(table(spark, sf_dir, "pages")).select("page_id", "url", "body_bytes", "body_md5", "error")


def op5_privacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, with personal data generalised and the terms that disclose it."""
    return privacy.sanitised_documents(table(spark, sf_dir, "documents"), counts=True)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Poisson replication of documents to temperature weights of their sources."""
    return mixing.copies(table(spark, sf_dir, "documents"))


def op7_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents' tokens in binary shards; each document's place, by select."""
    return tokenstore.written(table(spark, sf_dir, "documents"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents' tokens by the backtracking encoder, decoded again and compared."""
    return bpe.encoded(table(spark, sf_dir, "documents"))


def op9_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cosine-transform hashes of the PNGs of all embeddings."""
    return media.hashed(media.pictures(table(spark, sf_dir, "embeddings")))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that break no quality rule, with their metrics."""
    return quality.measured(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_lm_score, op2_secrets, op3_jaccard_join, op4_warc, op5_privacy, op6_mixing, op7_token_store, op8_bpe, op9_media, op10_quality, warc_read_back)
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    cols = "doc_id, text, lang, source, n_chars"
    return {
        "op3_jaccard_join": jaccard.sql_links("documents"),
        "op6_mixing": mixing.sql_copies("documents", cols),
        "op10_quality": f"SELECT * EXCLUDE (broken) FROM ({quality.sql_body('documents', cols)}) WHERE broken = ''",
        "warc_read_back": "SELECT page_id, url, strlen(html)::BIGINT AS body_bytes, md5(html) AS body_md5, NULL::VARCHAR AS error FROM pages",
    }
