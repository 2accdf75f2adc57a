"""Layered recovery of missing abstracts as staged left joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rules import abstract_problem
from ..functions.text import normalize_doi_prefix, strip_tags
from .dedup import last_seen


def by_lookup_doi(papers: DataFrame, order: list[Column]) -> DataFrame:
    """One paper a normalised DOI, the later replacing the earlier; adds ``ndoi``."""
    return last_seen(papers.withColumn("ndoi", normalize_doi_prefix(F.col("doi"))), F.col("ndoi"), order)


def layered(requests: DataFrame, bulk: DataFrame, registry: DataFrame, repository: DataFrame | None) -> DataFrame:
    """id, ndoi, abstract, source, problem for each request; lookups have ndoi and abstract.

    The bulk answer counts if it is a valid abstract. For the rest the registry's answer (without
    markup) is taken, and the repository's only where the registry had none. What is taken and not
    valid stays with its problem and no abstract.
    """
    j = requests.join(bulk.select("ndoi", F.col("abstract").alias("a1")), "ndoi", "left").join(registry.select("ndoi", strip_tags(F.col("abstract")).alias("a2")), "ndoi", "left")
    j = j.join(repository.select("ndoi", strip_tags(F.col("abstract")).alias("a3")), "ndoi", "left") if repository is not None else j.withColumn("a3", F.lit(None).cast("string"))
    blank = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    first = ~blank("a1") & (abstract_problem(F.col("a1"), F.col("title")) == "")
    taken = F.when(first, F.col("a1")).when(~blank("a2"), F.col("a2")).when(~blank("a3"), F.col("a3"))
    source = F.when(first, "semantic_scholar").when(~blank("a2"), "crossref").when(~blank("a3"), "unpaywall")
    out = j.select("id", "ndoi", "title", taken.alias("taken"), source.alias("source")).withColumn("problem", F.when(F.col("taken").isNotNull(), abstract_problem(F.col("taken"), F.col("title"))))
    return out.select("id", "ndoi", F.when(F.col("problem") == "", F.col("taken")).alias("abstract"), "source", "problem")


def write_back(papers: DataFrame, answers: DataFrame, now: Column) -> DataFrame:
    """Papers with answers filled in, only where the stored abstract is null or shorter than 50."""
    a = answers.filter("abstract IS NOT NULL").select("id", F.col("abstract").alias("new_abstract"), F.col("source").alias("new_source"))
    j = papers.join(a, "id", "left")
    take = F.col("new_abstract").isNotNull() & (F.col("abstract").isNull() | (F.length(F.trim("abstract")) < 50))
    return j.select("id", F.when(take, F.col("new_abstract")).otherwise(F.col("abstract")).alias("abstract"), F.when(take, F.col("new_source")).alias("abstract_source"), F.when(take, now).alias("updated_at"))


def residual(requests: DataFrame, answers: DataFrame) -> DataFrame:
    """Requests that got no abstract."""
    return requests.join(answers.filter("abstract IS NOT NULL").select("id"), "id", "left_anti")
