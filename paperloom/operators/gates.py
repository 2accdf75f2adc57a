"""Selections of papers: scope, tags, abstracts and time windows, all as semi- and anti-joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import recovery_route


def in_scope(papers: DataFrame, paper_disciplines: DataFrame, disciplines: DataFrame) -> DataFrame:
    """Papers with a link to a discipline in scope."""
    links = paper_disciplines.join(disciplines.filter("in_scope"), paper_disciplines["discipline_id"] == disciplines["id"], "left_semi")
    return papers.join(links.select(F.col("paper_id").alias("id")), "id", "left_semi")


def untagged(papers: DataFrame, paper_tags: DataFrame, needs_abstract: bool) -> DataFrame:
    """Papers without any tag; with ``needs_abstract`` only those with one that isn't blank."""
    if needs_abstract:
        papers = papers.filter(F.length(F.trim("abstract")) >= 1)
    return papers.join(paper_tags.select(F.col("paper_id").alias("id")), "id", "left_anti")


def recovery_due(papers: DataFrame, now: Column) -> DataFrame:
    """Papers with a DOI and no abstract that were never tried or are pending for two days."""
    due = F.col("abstract_recovery_state").isNull() | ((F.col("abstract_recovery_state") == "pending") & (F.col("abstract_recovery_last") < now - F.expr("INTERVAL 2 DAYS")))
    return papers.filter(F.col("abstract").isNull() & F.col("doi").isNotNull() & due)


def newest(papers: DataFrame, n: int) -> DataFrame:
    """The n newest, unknown times last, ids break ties."""
    return papers.orderBy(F.col("created_at").desc_nulls_last(), "id").limit(n)


def state_counts(papers: DataFrame) -> DataFrame:
    missing = papers.filter("abstract IS NULL AND doi IS NOT NULL")
    return missing.groupBy(F.coalesce("abstract_recovery_state", F.lit("(null)")).alias("state")).agg(F.count(F.lit(1)).alias("n"))


def next_state(papers: DataFrame, now: Column) -> DataFrame:
    """id, state of papers that still have no abstract: pending for 30 days, then the DOI's route."""
    old = F.coalesce(F.col("created_at") < now - F.expr("INTERVAL 30 DAYS"), F.lit(False))
    return papers.filter("abstract IS NULL").select("id", F.when(old, recovery_route(F.col("doi"))).otherwise("pending").alias("state"))


def transition(papers: DataFrame, now: Column) -> DataFrame:
    """All papers; those without an abstract in their next state, with the time of the attempt."""
    tried = next_state(papers, now).select("id", F.col("state").alias("_s"))
    j = papers.join(tried, "id", "left")
    new = {"abstract_recovery_state": F.coalesce("_s", "abstract_recovery_state"), "abstract_recovery_last": F.when(F.col("_s").isNotNull(), now).otherwise(F.col("abstract_recovery_last"))}
    return j.select(*[new.get(c, F.col(c)).alias(c) for c in papers.columns])


def recovered_now(papers: DataFrame, asked: DataFrame) -> DataFrame:
    """Ids of a batch whose papers have an abstract now."""
    return papers.filter("abstract IS NOT NULL").join(asked.select("id"), "id", "left_semi").select("id")


def of_discipline(rows: DataFrame, slug: str | None, column: str = "discipline") -> DataFrame:
    """Rows of one discipline, or all; a row without a discipline is of none."""
    return rows if slug is None else rows.filter(F.col(column) == slug)


def recent_in_discipline(papers: DataFrame, paper_disciplines: DataFrame, discipline_id: str, now: Column, days: int = 7) -> DataFrame:
    links = paper_disciplines.filter(F.col("discipline_id") == discipline_id).select(F.col("paper_id").alias("id")).distinct()
    return papers.filter(F.col("created_at") >= now - F.expr(f"INTERVAL {int(days)} DAYS")).join(links, "id")


def without_summary(papers: DataFrame, summaries: DataFrame, n: int = 100) -> DataFrame:
    """Papers with an abstract and no summary, the least ids first."""
    return papers.filter("abstract IS NOT NULL").join(summaries.select(F.col("paper_id").alias("id")), "id", "left_anti").orderBy("id").limit(n)


def new_dois(incoming: DataFrame, stored: DataFrame, doi: Column, ordinal: str) -> DataFrame:
    """Records whose normalised DOI is neither stored nor earlier in the batch."""
    from .dedup import first_seen

    keyed = incoming.withColumn("_k", doi).filter("_k <> ''")
    known = stored.select(doi.alias("_k")).filter("_k <> ''").distinct()
    return first_seen(keyed.join(known, "_k", "left_anti"), "_k", [F.col(ordinal)]).drop("_k")
