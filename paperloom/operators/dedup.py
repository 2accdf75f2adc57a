"""First-seen and last-seen deduplication and duplicate reports.

All are windows on the key: one exchange, no self-join, no collection. Every order ends in a unique
column, so the result doesn't depend on partitions. Null and '' keys never group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import normalize_doi, signature


def first_seen(df: DataFrame, key: str, order: list[Column], keep_null: bool = False) -> DataFrame:
    """The first row of each key; null keys are dropped, or count as one key with ``keep_null``."""
    if not keep_null:
        df = df.filter(F.col(key).isNotNull())
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(key).orderBy(*order))).filter("_rn = 1").drop("_rn")


def last_seen(df: DataFrame, key: Column, order: list[Column]) -> DataFrame:
    """The last row of each key that isn't blank."""
    keyed = df.withColumn("_key", key).filter("_key <> ''")
    return keyed.withColumn("_rn", F.row_number().over(Window.partitionBy("_key").orderBy(*[o.desc() for o in order]))).filter("_rn = 1").drop("_rn", "_key")


def _preference(with_doi: bool) -> list[Column]:
    most = [
        F.coalesce("upvote_count", F.lit(0)).desc(),
        F.coalesce("comment_count", F.lit(0)).desc(),
        F.length(F.coalesce("abstract", F.lit(""))).desc(),
        F.col("created_at").desc_nulls_last(),
        F.col("id").asc(),
    ]
    return [(F.coalesce("doi", F.lit("")) != "").cast("int").desc(), *most] if with_doi else most


def _losers(papers: DataFrame, key: Column, method: str, with_doi: bool = False) -> DataFrame:
    keyed = papers.withColumn("_key", key).filter("_key IS NOT NULL AND _key <> ''")
    if with_doi:
        # the abstract is only needed for its length; several distinct DOIs in a group void it
        same = Window.partitionBy("_key")
        other = normalize_doi(F.col("doi"))
        keyed = keyed.filter("_key <> '||'").withColumn("_dois", F.size(F.collect_set(F.when(F.coalesce("doi", F.lit("")) != "", other)).over(same))).filter("_dois <= 1")
    ranked = Window.partitionBy("_key").orderBy(*_preference(with_doi))
    return (
        keyed.withColumn("_rn", F.row_number().over(ranked))
        .withColumn("keep_id", F.first("id").over(ranked))
        .filter("_rn > 1")
        .select("keep_id", F.col("id").alias("remove_id"), F.lit(method).alias("method"), F.col("_key").alias("value"))
    )


def by_doi(papers: DataFrame) -> DataFrame:
    """keep_id, remove_id, method, value for every paper that shares its DOI with a better one."""
    return _losers(papers, normalize_doi(F.col("doi")), "doi")


def by_openalex(papers: DataFrame) -> DataFrame:
    return _losers(papers, F.col("openalex_id"), "openalex_id")


def by_signature(papers: DataFrame) -> DataFrame:
    """By title, first author and year; groups with several DOIs aren't duplicates."""
    return _losers(papers, signature(F.col("title"), F.col("authors"), F.col("published_date")), "signature", with_doi=True)


def scanned(papers: DataFrame, now: Column | None = None, days: int | None = None, most: int | None = None) -> DataFrame:
    """The papers of a duplicate scan: of the last days if given, the newest ones if capped."""
    if days is not None:
        papers = papers.filter(F.col("created_at") >= now - F.expr(f"INTERVAL {int(days)} DAYS"))
    return papers if most is None else papers.orderBy(F.col("created_at").desc_nulls_last(), "id").limit(most)


def sample(losers: DataFrame, papers: DataFrame, most: int = 10) -> DataFrame:
    """A few lines to look at: ids in short and both titles up to 60 characters."""
    title = lambda k: papers.select(F.col("id").alias(f"{k}_id"), F.left("title", F.lit(60)).alias(f"{k}_title"))
    few = losers.orderBy("remove_id").limit(most)
    out = few.join(title("keep"), "keep_id", "left").join(title("remove"), "remove_id", "left")
    return out.select(F.left("keep_id", F.lit(8)).alias("keep"), F.left("remove_id", F.lit(8)).alias("remove"), "method", F.left("value", F.lit(40)).alias("value"), "keep_title", "remove_title")


def report(papers: DataFrame) -> DataFrame:
    """One row a paper to remove, the surest method first (DOI, catalogue id, signature)."""
    every = by_doi(papers).withColumn("_o", F.lit(1)).unionByName(by_openalex(papers).withColumn("_o", F.lit(2))).unionByName(by_signature(papers).withColumn("_o", F.lit(3)))
    return every.withColumn("_rn", F.row_number().over(Window.partitionBy("remove_id").orderBy("_o", "keep_id"))).filter("_rn = 1").drop("_rn", "_o")
