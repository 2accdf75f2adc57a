"""Views that give the driver's tables the shapes of the engine, the same in Spark and in DuckDB.

Everything derives from arithmetic on the key and from the text; there is no sampling.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table

#: "Now" of all time-dependent queries.
NOW = "2024-02-01 00:00:00"
EPOCH = 1704067200  # 2024-01-01

_PAPERS = [
    ("id", "concat('p', doc_id)", None),
    ("doc_id", "doc_id", None),
    ("title", "CASE WHEN doc_id % 41 = 0 THEN '' WHEN doc_id % 43 = 0 THEN source WHEN doc_id % 11 = 3 THEN concat('<i>', substr(replace(text, chr(10), ' '), 1, 60), '</i>') ELSE substr(replace(text, chr(10), ' '), 1, 60) END", None),
    ("abstract", "CASE WHEN doc_id % 5 = 0 THEN NULL WHEN doc_id % 23 = 1 THEN '' WHEN doc_id % 29 = 2 THEN concat('All rights reserved ', text) ELSE substr(text, CAST(1 + doc_id % 50 AS INT)) END", None),
    ("source", "source", None),
    ("doi", "CASE doc_id % 7 WHEN 0 THEN NULL WHEN 1 THEN concat('10.1000/x', doc_id - doc_id % 6) WHEN 2 THEN concat('10.1000/X', doc_id - doc_id % 6) WHEN 3 THEN concat('https://doi.org/10.1000/x', doc_id - doc_id % 6) WHEN 4 THEN concat('DOI:10.1016/x', doc_id - doc_id % 6) WHEN 5 THEN concat(' doi: 10.1016/x', doc_id - doc_id % 6) ELSE '' END", None),
    ("openalex_id", "CASE WHEN doc_id % 4 = 0 THEN NULL ELSE concat('W', doc_id - doc_id % 3) END", None),
    ("arxiv_id", "CASE WHEN doc_id % 6 = 0 THEN NULL ELSE concat('2401.', doc_id - doc_id % 2, 'v1') END", None),
    ("authors", "CASE WHEN doc_id % 9 = 0 THEN CAST(array() AS array<struct<name:string,affiliation:string,orcid:string,openalex_id:string>>) WHEN doc_id % 31 = 4 THEN array(named_struct('name', ' ', 'affiliation', '', 'orcid', '', 'openalex_id', '')) ELSE array(named_struct('name', concat('Ada ', source, ' '), 'affiliation', 'Lab', 'orcid', concat('0000-000', doc_id % 10), 'openalex_id', concat('A', doc_id)), named_struct('name', 'Bo Li', 'affiliation', '', 'orcid', '', 'openalex_id', '')) END", "CASE WHEN doc_id % 9 = 0 THEN [] WHEN doc_id % 31 = 4 THEN [{'name': ' ', 'affiliation': '', 'orcid': '', 'openalex_id': ''}] ELSE [{'name': concat('Ada ', source, ' '), 'affiliation': 'Lab', 'orcid': concat('0000-000', doc_id % 10), 'openalex_id': concat('A', doc_id)}, {'name': 'Bo Li', 'affiliation': '', 'orcid': '', 'openalex_id': ''}] END"),
    ("published_date", "CASE WHEN doc_id % 10 = 0 THEN NULL ELSE concat(CAST(2020 + doc_id % 3 AS STRING), '-01-02') END", None),
    ("created_at", f"CASE WHEN doc_id % 13 = 0 THEN NULL ELSE timestamp_seconds({EPOCH} - 86400 * 40 + doc_id % 1700 * 3600) END", f"CASE WHEN doc_id % 13 = 0 THEN NULL ELSE make_timestamp(({EPOCH} - 86400 * 40 + doc_id % 1700 * 3600) * 1000000) END"),
    ("upvote_count", "CASE WHEN doc_id % 8 = 0 THEN NULL ELSE doc_id % 5 END", None),
    ("comment_count", "CASE WHEN doc_id % 9 = 0 THEN NULL ELSE doc_id % 3 END", None),
    ("abstract_recovery_state", "CASE doc_id % 20 WHEN 0 THEN NULL WHEN 5 THEN 'pending' WHEN 10 THEN 'free_dead' ELSE 'pending' END", None),
    ("abstract_recovery_last", f"CASE WHEN doc_id % 3 = 0 THEN NULL ELSE timestamp_seconds({EPOCH} + 86400 * 28 + doc_id % 100 * 3600) END", f"CASE WHEN doc_id % 3 = 0 THEN NULL ELSE make_timestamp(({EPOCH} + 86400 * 28 + doc_id % 100 * 3600) * 1000000) END"),
]

#: DuckDB WITH clauses, to be joined by commas.
SQL: dict[str, str] = {
    "papers": f"papers AS (SELECT {', '.join(f'{d or s} AS {n}' for n, s, d in _PAPERS)} FROM documents)",
    "redirects": f"redirects AS (SELECT concat('gone', doc_id) AS old_id, concat('p', doc_id - doc_id % 7) AS new_id, CASE WHEN doc_id % 2 = 0 THEN concat('V', doc_id - doc_id % 3) END AS old_openalex_id, concat('10.2000/y', doc_id - doc_id % 6) AS old_doi, CASE WHEN doc_id % 3 = 0 THEN concat('2301.', doc_id) END AS old_arxiv_id, CASE WHEN doc_id % 19 <> 0 THEN make_timestamp(({EPOCH} + doc_id % 97 * 3600) * 1000000) END AS merged_at FROM documents WHERE doc_id % 5 = 1)",
    "disciplines": "disciplines AS (SELECT concat('d', r_regionkey) AS id, lower(replace(r_name, ' ', '-')) AS slug, r_regionkey AS display_order, r_regionkey % 2 = 0 AS in_scope FROM region)",
    "paper_disciplines": "paper_disciplines AS (SELECT concat('p', doc_id) AS paper_id, concat('d', doc_id % 6) AS discipline_id, 'openalex' AS source FROM documents WHERE doc_id % 4 <> 3)",
    "tags": "tags AS (SELECT concat('t', n_nationkey) AS id, concat('sf', n_nationkey) AS name, CASE WHEN n_nationkey % 6 = 5 THEN 'method' ELSE 'subfield' END AS type FROM nation)",
    "paper_tags": "paper_tags AS (SELECT concat('p', doc_id) AS paper_id, concat('t', doc_id % 25) AS tag_id, 0.5 + quality / 4.0 AS confidence, 'keyword' AS source FROM labels)",
}


def papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").selectExpr(*[f"{s} AS {n}" for n, s, _ in _PAPERS])


def redirects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").filter("doc_id % 5 = 1").selectExpr(
        "concat('gone', doc_id) AS old_id", "concat('p', doc_id - doc_id % 7) AS new_id", "CASE WHEN doc_id % 2 = 0 THEN concat('V', doc_id - doc_id % 3) END AS old_openalex_id",
        "concat('10.2000/y', doc_id - doc_id % 6) AS old_doi", "CASE WHEN doc_id % 3 = 0 THEN concat('2301.', doc_id) END AS old_arxiv_id",
        f"CASE WHEN doc_id % 19 <> 0 THEN timestamp_seconds({EPOCH} + doc_id % 97 * 3600) END AS merged_at",
    )


def disciplines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "region").selectExpr("concat('d', r_regionkey) AS id", "lower(replace(r_name, ' ', '-')) AS slug", "r_regionkey AS display_order", "r_regionkey % 2 = 0 AS in_scope")


def paper_disciplines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").filter("doc_id % 4 <> 3").selectExpr("concat('p', doc_id) AS paper_id", "concat('d', doc_id % 6) AS discipline_id", "'openalex' AS source")


def tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").selectExpr("concat('t', n_nationkey) AS id", "concat('sf', n_nationkey) AS name", "CASE WHEN n_nationkey % 6 = 5 THEN 'method' ELSE 'subfield' END AS type")


def paper_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").selectExpr("concat('p', doc_id) AS paper_id", "concat('t', doc_id % 25) AS tag_id", "0.5D + quality / 4.0D AS confidence", "'keyword' AS source")


def now() -> F.Column:
    return F.lit(NOW).cast("timestamp")


def with_sql(body: str, *views: str) -> str:
    """``body`` with the named views before it."""
    return "WITH " + ",\n".join(SQL[v] for v in views) + "\n" + body
