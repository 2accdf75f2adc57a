"""Links from papers to disciplines, tags and journals by dimension joins.

Dimensions are joined without hints: the planner broadcasts what its statistics show to be small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def link_concepts(papers: DataFrame, concepts: DataFrame, targets: DataFrame, kind: str) -> DataFrame:
    """paper_id, target_id for every concept that maps to a known discipline or tag (slug, id), once each."""
    wanted = concepts.filter(F.col("kind") == kind).select("concept_id", "slug").join(targets, "slug").select("concept_id", F.col("id").alias("target_id"))
    return papers.select(F.col("id").alias("paper_id"), F.explode("concept_ids").alias("concept_id")).join(wanted, "concept_id").select("paper_id", "target_id").distinct()


def link_categories(papers: DataFrame, prefixes: DataFrame, disciplines: DataFrame) -> DataFrame:
    """paper_id, discipline_id by the part of each category before its first point."""
    wanted = prefixes.join(disciplines, prefixes["discipline"] == disciplines["slug"]).select("prefix", F.col("id").alias("discipline_id"))
    exploded = papers.select(F.col("id").alias("paper_id"), F.explode("arxiv_categories").alias("c")).filter("c <> ''")
    return exploded.withColumn("prefix", F.substring_index("c", ".", 1)).join(wanted, "prefix").select("paper_id", "discipline_id").distinct()


def routed_links(papers: DataFrame, concepts: DataFrame, prefixes: DataFrame, disciplines: DataFrame) -> DataFrame:
    """paper_id, discipline_id, source: concepts if there are any, else categories, else the working-paper series."""
    has_concepts = F.size(F.coalesce("concept_ids", F.array().cast("array<string>"))) > 0
    has_categories = F.size(F.coalesce("arxiv_categories", F.array().cast("array<string>"))) > 0
    a = link_concepts(papers.filter(has_concepts), concepts, disciplines.select("slug", "id"), "discipline").select("paper_id", F.col("target_id").alias("discipline_id"), F.lit("openalex").alias("source"))
    b = link_categories(papers.filter(~has_concepts & has_categories), prefixes, disciplines).withColumn("source", F.lit("arxiv"))
    c = papers.filter(~has_concepts & ~has_categories & (F.col("source") == "NBER Working Papers")).select(F.col("id").alias("paper_id")).crossJoin(disciplines.filter("slug = 'economics'").select(F.col("id").alias("discipline_id"))).withColumn("source", F.lit("nber"))
    return a.unionByName(b).unionByName(c)


def journal_discipline(issns: DataFrame, journals: DataFrame) -> DataFrame:
    """Each journal with an ISSN and its discipline: the first configured name that is equal in any case."""
    w = Window.partitionBy("k").orderBy("discipline_ord", "ordinal")
    first = journals.select(F.lower("name").alias("k"), "discipline", "discipline_ord", "ordinal").withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").select("k", "discipline")
    return issns.join(first, F.lower(issns["journal"]) == first["k"], "left").select("issn", "journal", "discipline")


def claim_journal_papers(papers: DataFrame, journals: DataFrame) -> DataFrame:
    """Papers of configured sources under the configured name; the first discipline claims a paper.

    Papers carry source_openalex_id and a discipline_ord of the fetch they came from.
    """
    names = journals.groupBy("source_id").agg(F.max_by("name", F.struct("discipline_ord", "ordinal")).alias("configured"))
    joined = papers.join(names, papers["source_openalex_id"] == names["source_id"], "left").withColumn("source", F.coalesce("configured", "source")).drop("configured", "source_id", "source_openalex_id")
    w = Window.partitionBy("openalex_id").orderBy("discipline_ord", "ordinal")
    return joined.filter("openalex_id IS NOT NULL").withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def journal_totals(journals: DataFrame) -> DataFrame:
    """One row: entries of all disciplines (a journal of two counts in both) and disciplines."""
    per = journals.groupBy("discipline").agg(F.count(F.lit(1)).alias("n"))
    return per.agg(F.sum("n").alias("journals"), F.count(F.lit(1)).alias("disciplines"))
