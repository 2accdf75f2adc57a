"""Normalisers: raw records of each feed to the engine's paper columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rules import valid_paper
from ..functions.text import bare_orcid, blank_to_null, iso_date, one_line, orcid_or_null, rebuild_text, strip, strip_tags

AUTHORS = "array<struct<name:string,affiliation:string,orcid:string,openalex_id:string>>"
AUTHORS_MOST = 10
CONCEPT_SCORE = 0.5


def _list(c: Column, kind: str) -> Column:
    return F.coalesce(c, F.array().cast(kind))


def catalogue(works: DataFrame, strict: bool = True) -> DataFrame:
    """Catalogue works; ``strict`` is the variant by concept, else the one by journal.

    By journal ORCIDs stay unchecked, there are no concepts and the source's id is added.
    """

    def author(a: Column) -> Column:
        orcid = orcid_or_null(a["author"]["orcid"]) if strict else a["author"]["orcid"]
        return F.struct(
            F.coalesce(a["author"]["display_name"], F.lit("")).alias("name"),
            F.coalesce(F.get(a["institutions"], F.lit(0))["display_name"], F.lit("")).alias("affiliation"),
            orcid.alias("orcid"),
            a["author"]["id"].alias("openalex_id"),
        )

    authors = F.coalesce(F.transform(F.slice("authorships", 1, AUTHORS_MOST), author), F.array().cast(AUTHORS))
    concepts = F.transform(F.filter("concepts", lambda c: F.coalesce(c["score"], F.lit(0.0)) >= CONCEPT_SCORE), lambda c: F.replace(F.coalesce(c["id"], F.lit("")), F.lit("https://openalex.org/"), F.lit("")))
    source = F.col("primary_location.source.display_name")
    extra = [F.filter(_list(concepts, "array<string>"), lambda c: c != "").alias("concept_ids")] if strict else [F.regexp_replace("primary_location.source.id", "^https://openalex.org/", "").alias("source_openalex_id")]
    return works.filter("title <> ''").withColumn("_authors", authors).filter(valid_paper(F.col("title"), source, F.col("_authors"), strict)).select(
        "title", F.coalesce(blank_to_null(F.col("abstract")), rebuild_text(F.col("abstract_inverted_index"))).alias("abstract"), F.col("_authors").alias("authors"), source.alias("source"),
        F.col("publication_date").alias("published_date"), F.col("publication_year").alias("published_year"), "doi", F.coalesce(blank_to_null(F.col("doi")), "id").alias("url"),
        blank_to_null(F.col("open_access.oa_url")).alias("pdf_url"), F.col("id").alias("openalex_id"), F.coalesce("cited_by_count", F.lit(0)).alias("citation_count"), *extra,
    )


def feed(entries: DataFrame) -> DataFrame:
    """Working papers of a news feed; entries without author aren't papers."""
    author = F.when(F.coalesce("author", F.lit("")) != "", F.array(F.struct(F.col("author").alias("name"), F.lit("").alias("affiliation"), F.lit(None).cast("string").alias("orcid"), F.lit(None).cast("string").alias("openalex_id")))).otherwise(F.array().cast(AUTHORS))
    return entries.filter("title <> ''").withColumn("_a", author).filter(valid_paper(F.col("title"), F.lit(None).cast("string"), F.col("_a"))).select(
        "title", F.col("summary").alias("abstract"), F.col("_a").alias("authors"), F.lit("NBER Working Papers").alias("source"), F.col("published").alias("published_date"), F.col("link").alias("url"), F.col("link").alias("pdf_url")
    )


def preprints(entries: DataFrame) -> DataFrame:
    """Preprints: the id keeps its version, the PDF is the last link of that type."""
    authors = F.transform(_list(F.col("authors"), "array<struct<name:string,arxiv_affiliation:string>>"), lambda a: F.struct(F.coalesce(a["name"], F.lit("")).alias("name"), blank_to_null(a["arxiv_affiliation"]).alias("affiliation"), F.lit(None).cast("string").alias("orcid"), F.lit(None).cast("string").alias("openalex_id")))
    terms = F.filter(F.transform(_list(F.col("tags"), "array<struct<term:string>>"), lambda t: t["term"]), lambda t: F.coalesce(t, F.lit("")) != "")
    pdfs = F.filter(_list(F.col("links"), "array<struct<type:string,title:string,href:string>>"), lambda x: x["type"] == "application/pdf")
    opened = entries.filter("title <> ''").withColumn("_t", one_line(F.col("title"))).withColumn("_a", authors)
    return opened.filter(valid_paper(F.col("_t"), F.lit(None).cast("string"), F.col("_a"))).select(
        F.col("_t").alias("title"), F.coalesce(one_line(F.col("summary")), F.lit("")).alias("abstract"), F.col("_a").alias("authors"), F.lit("arXiv").alias("source"), F.col("published").alias("published_date"),
        F.col("updated").alias("updated_date"), F.col("link").alias("url"), F.try_element_at(pdfs, F.lit(-1))["href"].alias("pdf_url"),
        F.when(F.col("id") != "", F.try_element_at(F.split("id", "/abs/"), F.lit(-1))).alias("arxiv_id"), F.col("arxiv_doi").alias("doi"), terms.alias("arxiv_categories"),
        F.col("arxiv_primary_category.term").alias("arxiv_primary_category"), one_line(F.col("arxiv_comment")).alias("arxiv_comment"), one_line(F.col("arxiv_journal_ref")).alias("journal_ref"),
    )


def registry(items: DataFrame, journal: Column, fallback: DataFrame | None = None) -> DataFrame:
    """Registry items of a journal; ``fallback`` (doi, abstract) fills missing abstracts.

    The title is a text or the first of a JSON list. Dates fall back from published to print to
    online; without a date, author or DOI an item is no paper.
    """
    title = F.when(F.col("title").startswith("["), F.get(F.from_json("title", "array<string>"), F.lit(0))).otherwise(F.col("title"))
    author = F.transform(_list(F.col("author"), "array<struct<given:string,family:string,ORCID:string,affiliation:array<struct<name:string>>>>"), lambda a: F.struct(
        F.concat_ws(" ", blank_to_null(a["given"]), blank_to_null(a["family"])).alias("name"), blank_to_null(F.get(a["affiliation"], F.lit(0))["name"]).alias("affiliation"),
        bare_orcid(blank_to_null(a["ORCID"])).alias("orcid"), F.lit(None).cast("string").alias("openalex_id")))
    parts = F.coalesce(*[F.get(F.col(f"`{c}`")["date-parts"], F.lit(0)) for c in ("published", "published-print", "published-online")])
    pdf = F.get(F.filter(_list(F.col("link"), "array<struct<`content-type`:string,URL:string>>"), lambda x: x["content-type"] == "application/pdf"), F.lit(0))["URL"]
    out = items.withColumn("_t", title).withColumn("_j", journal).withColumn("_a", F.filter(author, lambda a: a["name"] != "")).withColumn("_d", iso_date(parts))
    out = out.filter((F.col("DOI") != "") & (F.length("_t") >= 20) & (strip(F.lower("_t")) != strip(F.lower("_j"))) & (F.size("_a") > 0) & F.col("_d").isNotNull())
    own = blank_to_null(strip_tags(F.col("abstract")))
    if fallback is not None:
        out = out.join(fallback.select(F.col("doi").alias("_fd"), F.col("abstract").alias("_fa")), F.col("DOI") == F.col("_fd"), "left")
        own = F.coalesce(own, blank_to_null(F.col("_fa")))
    return out.select(
        F.col("_t").alias("title"), own.alias("abstract"), F.col("_a").alias("authors"), F.col("_j").alias("source"), F.col("DOI").alias("doi"), F.concat(F.lit("https://doi.org/"), "DOI").alias("url"), pdf.alias("pdf_url"), F.col("_d").alias("published_date")
    )


def statistics(records: DataFrame, valid: Column, doi: Column, ordinal: str) -> DataFrame:
    """One row of an intake: records processed, invalid ones, those whose DOI came before, and those inserted."""
    from pyspark.sql import Window

    marked = records.select(F.coalesce(valid, F.lit(False)).alias("ok"), doi.alias("k"), F.col(ordinal).alias("o"))
    repeated = (F.coalesce("k", F.lit("")) != "") & (F.row_number().over(Window.partitionBy("k", "ok", F.when(F.coalesce("k", F.lit("")) == "", F.col("o"))).orderBy("o")) > 1)
    m = marked.withColumn("dup", repeated)
    return m.agg(F.count(F.lit(1)).alias("processed"), F.count_if(~F.col("ok")).alias("invalid"), F.count_if(F.col("ok") & F.col("dup")).alias("duplicates"), F.count_if(F.col("ok") & ~F.col("dup")).alias("inserted"))


def union(*feeds: DataFrame) -> DataFrame:
    """All feeds as one table; ``provided`` lists the columns each record's feed has."""
    marked = [f.withColumn("provided", F.array(*[F.lit(c) for c in f.columns])) for f in feeds]
    out = marked[0]
    for f in marked[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
