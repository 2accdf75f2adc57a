"""Queries of the scholarly engine over the driver's tables, each with its DuckDB SQL.

``@query(sql)`` registers a function under its name; ``sql`` is None where SQL can't say it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rules, text
from ..operators import classify, dedup, gates, link, normalize, recover, resolve
from ..session import table
from ..sources import dims, records
from . import sql as D
from . import views as V
from .views import NOW, with_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None) -> Callable:
    def put(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return put


# ---- duplicates

_ORDER = "coalesce(upvote_count, 0) DESC, coalesce(comment_count, 0) DESC, length(coalesce(abstract, '')) DESC, created_at DESC NULLS LAST, id"


def _losers(key: str, method: str, more: str = "", order: str = _ORDER) -> str:
    return f"""SELECT keep_id, id AS remove_id, '{method}' AS method, k AS value FROM (
      SELECT id, k, row_number() OVER (PARTITION BY k ORDER BY {order}) AS rn, first_value(id) OVER (PARTITION BY k ORDER BY {order}) AS keep_id
      FROM (SELECT *, {key} AS k FROM papers) x WHERE k IS NOT NULL AND k <> '' {more}) WHERE rn > 1"""


_BY_DOI = _losers(D.normalize_doi("doi"), "doi")
_BY_OPENALEX = _losers("openalex_id", "openalex_id")
_BY_SIGNATURE = _losers(
    D.signature(), "signature",
    f"AND k <> '||' AND k NOT IN (SELECT {D.signature()} FROM papers WHERE coalesce(doi, '') <> '' GROUP BY 1 HAVING count(DISTINCT {D.normalize_doi('doi')}) > 1)",
    "CASE WHEN coalesce(doi, '') <> '' THEN 1 ELSE 0 END DESC, " + _ORDER,
)


@query(with_sql(_BY_DOI, "papers"))
def duplicates_by_doi(spark, sf_dir):
    return dedup.by_doi(V.papers(spark, sf_dir))


@query(with_sql(_BY_OPENALEX, "papers"))
def duplicates_by_openalex(spark, sf_dir):
    return dedup.by_openalex(V.papers(spark, sf_dir))


@query(with_sql(_BY_SIGNATURE, "papers"))
def duplicates_by_signature(spark, sf_dir):
    return dedup.by_signature(V.papers(spark, sf_dir))


@query(with_sql(f"""SELECT keep_id, remove_id, method, value FROM (SELECT *, row_number() OVER (PARTITION BY remove_id ORDER BY o, keep_id) AS rn
  FROM (SELECT *, 1 AS o FROM ({_BY_DOI}) UNION ALL SELECT *, 2 FROM ({_BY_OPENALEX}) UNION ALL SELECT *, 3 FROM ({_BY_SIGNATURE}))) WHERE rn = 1""", "papers"))  # fmt: skip
def duplicate_report(spark, sf_dir):
    return dedup.report(V.papers(spark, sf_dir))


@query(with_sql("SELECT openalex_id, min(doc_id) AS doc_id FROM papers WHERE openalex_id IS NOT NULL GROUP BY 1", "papers"))
def first_seen_by_openalex(spark, sf_dir):
    return dedup.first_seen(V.papers(spark, sf_dir), "openalex_id", [F.col("doc_id")]).select("openalex_id", "doc_id")


@query(with_sql("SELECT arxiv_id, min(doc_id) AS doc_id FROM papers GROUP BY 1", "papers"))
def first_seen_by_arxiv(spark, sf_dir):
    return dedup.first_seen(V.papers(spark, sf_dir), "arxiv_id", [F.col("doc_id")], keep_null=True).select("arxiv_id", "doc_id")


@query(with_sql(f"SELECT {D.normalize_doi_prefix('doi')} AS ndoi, max(doc_id) AS doc_id FROM papers WHERE {D.normalize_doi_prefix('doi')} <> '' GROUP BY 1", "papers"))
def last_by_lookup_doi(spark, sf_dir):
    return recover.by_lookup_doi(V.papers(spark, sf_dir), [F.col("doc_id")]).select("ndoi", "doc_id")


# ---- scalar functions


@query(with_sql(f"""SELECT id, {D.clean_doi('doi')} AS cleaned, {D.normalize_doi('doi')} AS compared, {D.normalize_doi_prefix('doi')} AS looked_up, {D.stored_doi('doi')} AS stored,
  {D.normalize_title('title')} AS plain_title, {D.last_name('authors')} AS last_name, {D.signature()} AS signature, {D.strip_tags('title')} AS untagged,
  {D.route(D.clean_doi('doi'))} AS route, least(0.9::DOUBLE, 0.5::DOUBLE + (doc_id % 9) * 0.1::DOUBLE) AS score,
  1.0::DOUBLE / (1.0::DOUBLE + exp(-(doc_id % 9)::DOUBLE)) AS probability, regexp_replace(authors[1].orcid, 'https?://orcid\\.org/', '') AS bare_orcid,
  CASE WHEN length(authors[1].orcid) >= 10 THEN authors[1].orcid END AS orcid FROM papers""", "papers"))  # fmt: skip
def text_functions(spark, sf_dir):
    doi = F.col("doi")
    orcid = F.get("authors", F.lit(0))["orcid"]
    return V.papers(spark, sf_dir).select(
        "id", text.clean_doi(doi).alias("cleaned"), text.normalize_doi(doi).alias("compared"), text.normalize_doi_prefix(doi).alias("looked_up"), text.normalize_doi_stored(doi).alias("stored"),
        text.normalize_title(F.col("title")).alias("plain_title"), text.last_name(F.col("authors")).alias("last_name"), text.signature(F.col("title"), F.col("authors"), F.col("published_date")).alias("signature"),
        text.strip_tags(F.col("title")).alias("untagged"), text.recovery_route(text.clean_doi(doi)).alias("route"), text.keyword_score(F.col("doc_id") % 9).alias("score"),
        text.sigmoid((F.col("doc_id") % 9).cast("double")).alias("probability"), text.bare_orcid(orcid).alias("bare_orcid"), text.orcid_or_null(orcid).alias("orcid"),
    )


@query(with_sql(f"SELECT id, {D.valid_paper('title', 'source', 'authors', True)} AS strict, {D.valid_paper('title', 'source', 'authors', False)} AS lenient FROM papers", "papers"))
def valid_papers(spark, sf_dir):
    t, s, a = F.col("title"), F.col("source"), F.col("authors")
    return V.papers(spark, sf_dir).select("id", rules.valid_paper(t, s, a).alias("strict"), rules.valid_paper(t, s, a, strict=False).alias("lenient"))


@query(with_sql(f"SELECT id, {D.abstract_problem('abstract', 'title')} AS problem FROM papers", "papers"))
def abstract_problems(spark, sf_dir):
    return V.papers(spark, sf_dir).select("id", rules.abstract_problem(F.col("abstract"), F.col("title")).alias("problem"))


@query(f"SELECT page_id, {D.strip_tags('html')} AS plain FROM pages")
def strip_markup(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.clean_jats(F.col("html")).alias("plain"))


@query("SELECT doc_id, text AS rebuilt FROM documents WHERE text IS NOT NULL")
def rebuild_text(spark, sf_dir):
    """Whole texts through their inverted indexes, which are made of them by words."""
    docs = table(spark, sf_dir, "documents").filter("text IS NOT NULL")
    return docs.select("doc_id", text.rebuild_text(text.inverted_index(F.col("text"))).alias("rebuilt"))


# ---- selections

_SCOPE = "id IN (SELECT paper_id FROM paper_disciplines pd JOIN disciplines d ON d.id = pd.discipline_id WHERE d.in_scope)"
_DUE = f"CASE WHEN abstract_recovery_state IS NULL THEN true WHEN abstract_recovery_state = 'pending' THEN abstract_recovery_last < TIMESTAMP '{NOW}' - INTERVAL 2 DAY END AND NOT (doi IS NULL OR abstract IS NOT NULL)"


def _scoped(spark, sf_dir):
    return gates.in_scope(V.papers(spark, sf_dir), V.paper_disciplines(spark, sf_dir), V.disciplines(spark, sf_dir))


@query(with_sql(f"SELECT id FROM papers WHERE {_SCOPE}", "papers", "disciplines", "paper_disciplines"))
def papers_in_scope(spark, sf_dir):
    return _scoped(spark, sf_dir).select("id")


@query(with_sql(f"SELECT id FROM papers WHERE {_SCOPE} AND length(trim(abstract)) >= 1 AND NOT EXISTS (SELECT 1 FROM paper_tags t WHERE t.paper_id = papers.id)", "papers", "disciplines", "paper_disciplines", "paper_tags"))
def untagged_with_abstract(spark, sf_dir):
    return gates.untagged(_scoped(spark, sf_dir), V.paper_tags(spark, sf_dir), needs_abstract=True).select("id")


@query(with_sql(f"SELECT id FROM papers WHERE {_SCOPE} AND NOT EXISTS (SELECT 1 FROM paper_tags t WHERE t.paper_id = papers.id)", "papers", "disciplines", "paper_disciplines", "paper_tags"))
def unclassified(spark, sf_dir):
    return gates.untagged(_scoped(spark, sf_dir), V.paper_tags(spark, sf_dir), needs_abstract=False).select("id")


@query(with_sql(f"SELECT id, doi, title FROM papers WHERE {_DUE} AND {_SCOPE} ORDER BY created_at DESC NULLS LAST, id LIMIT 3000", "papers", "disciplines", "paper_disciplines"))
def recovery_selection(spark, sf_dir):
    return gates.newest(gates.recovery_due(_scoped(spark, sf_dir), V.now()), 3000).select("id", "doi", "title")


@query(with_sql(f"SELECT coalesce(abstract_recovery_state, '(null)') AS state, count(*) AS n FROM papers WHERE abstract IS NULL AND doi IS NOT NULL AND {_SCOPE} GROUP BY 1", "papers", "disciplines", "paper_disciplines"))
def recovery_states(spark, sf_dir):
    return gates.state_counts(_scoped(spark, sf_dir))


@query(with_sql(f"SELECT id, CASE WHEN coalesce(created_at < TIMESTAMP '{NOW}' - INTERVAL 30 DAY, false) THEN {D.route('doi')} ELSE 'pending' END AS state FROM papers WHERE abstract IS NULL", "papers"))
def recovery_transition(spark, sf_dir):
    return gates.next_state(V.papers(spark, sf_dir), V.now())


@query(with_sql(f"SELECT id, title FROM papers WHERE created_at >= TIMESTAMP '{NOW}' - INTERVAL 60 DAY AND id IN (SELECT paper_id FROM paper_disciplines WHERE discipline_id = 'd2')", "papers", "paper_disciplines"))
def recent_in_discipline(spark, sf_dir):
    return gates.recent_in_discipline(V.papers(spark, sf_dir), V.paper_disciplines(spark, sf_dir), "d2", V.now(), 60).select("id", "title")


@query(with_sql("SELECT id FROM papers WHERE abstract IS NOT NULL AND id NOT IN (SELECT paper_id FROM paper_tags) ORDER BY id LIMIT 100", "papers", "paper_tags"))
def without_summary(spark, sf_dir):
    return gates.without_summary(V.papers(spark, sf_dir), V.paper_tags(spark, sf_dir)).select("id")


@query(with_sql(f"""SELECT ndoi, min(doc_id) AS doc_id FROM (SELECT doc_id, {D.normalize_doi('doi')} AS ndoi FROM papers WHERE doc_id % 2 = 1)
  WHERE ndoi <> '' AND ndoi NOT IN (SELECT {D.normalize_doi('doi')} FROM papers WHERE doc_id % 4 = 0 AND {D.normalize_doi('doi')} IS NOT NULL) GROUP BY 1""", "papers"))  # fmt: skip
def new_dois(spark, sf_dir):
    p = V.papers(spark, sf_dir)
    return gates.new_dois(p.filter("doc_id % 2 = 1"), p.filter("doc_id % 4 = 0"), text.normalize_doi(F.col("doi")), "doc_id").select(text.normalize_doi(F.col("doi")).alias("ndoi"), "doc_id")


@query(with_sql("SELECT id, slug FROM disciplines ORDER BY display_order", "disciplines"))
def disciplines_in_order(spark, sf_dir):
    return V.disciplines(spark, sf_dir).orderBy("display_order").select("id", "slug")


@query(with_sql("SELECT name, max(id) AS id FROM tags WHERE type = 'subfield' GROUP BY 1", "tags"))
def subfield_tags(spark, sf_dir):
    return V.tags(spark, sf_dir).filter("type = 'subfield'").groupBy("name").agg(F.max("id").alias("id"))


# ---- links

_CONCEPTS = ["C17744445", "C121332964", "C105795698", "C139719470", "C41008148", "C154945302", "C999", "C86803240", "C54355233", "C144133560"]
_CATEGORIES = ["cs.AI", "cs.LG", "astro-ph.CO", "math", "q-fin.ST", "zz.X", "", "hep-th", "stat.ML", "econ.EM"]


def _pick(values: list[str], spark: bool) -> str:
    items = ", ".join(D.quoted(v) for v in values)
    return f"element_at(array({items}), int(%s) + 1)" if spark else f"([{items}])[(%s) + 1]"


def _linked_sql(spark: bool) -> list[str]:
    c, a = _pick(_CONCEPTS, spark), _pick(_CATEGORIES, spark)
    arr = (lambda x: f"array({x})") if spark else (lambda x: f"[{x}]")
    empty = "CAST(array() AS array<string>)" if spark else "[]::VARCHAR[]"
    return [
        "concat('p', doc_id) AS id",
        f"CASE WHEN doc_id % 3 = 0 THEN {arr(c % 'doc_id % 10' + ', ' + c % '(doc_id + 3) % 10')} ELSE {empty} END AS concept_ids",
        f"CASE WHEN doc_id % 3 = 1 OR doc_id % 6 = 0 THEN {arr(a % 'doc_id % 10' + ', ' + a % '(doc_id + 1) % 10')} ELSE {empty} END AS arxiv_categories",
        "CASE WHEN doc_id % 2 = 0 THEN 'NBER Working Papers' ELSE source END AS source",
    ]


_LINKED = f"linked AS (SELECT {', '.join(_linked_sql(False))} FROM documents)"
_SLUGS = "slugs AS (SELECT DISTINCT slug, concat('id-', slug) AS id FROM concepts WHERE slug <> 'sociology')"
_BY_CONCEPT = "SELECT DISTINCT paper_id, s.id AS target_id FROM (SELECT id AS paper_id, unnest(concept_ids) AS concept_id FROM linked {where}) JOIN concepts USING (concept_id) JOIN slugs s USING (slug) WHERE kind = '{kind}'"
_BY_CATEGORY = "SELECT DISTINCT paper_id, s.id AS discipline_id FROM (SELECT id AS paper_id, unnest(arxiv_categories) AS c FROM linked {where}) JOIN arxiv_prefixes ON prefix = string_split(c, '.')[1] JOIN slugs s ON s.slug = discipline"


def _linked(spark, sf_dir):
    return table(spark, sf_dir, "documents").selectExpr(*_linked_sql(True))


def _slugs(spark):
    return dims.dimension(spark, "concepts").filter("slug <> 'sociology'").select("slug", F.concat(F.lit("id-"), "slug").alias("id")).distinct()


@query(f"WITH {D.dimension('concepts')}, {_SLUGS}, {_LINKED} " + _BY_CONCEPT.format(where="", kind="discipline"))
def concept_disciplines(spark, sf_dir):
    return link.link_concepts(_linked(spark, sf_dir), dims.dimension(spark, "concepts"), _slugs(spark), "discipline")


@query(f"WITH {D.dimension('concepts')}, {_SLUGS}, {_LINKED} " + _BY_CONCEPT.format(where="", kind="subfield"))
def concept_tags(spark, sf_dir):
    return link.link_concepts(_linked(spark, sf_dir), dims.dimension(spark, "concepts"), _slugs(spark), "subfield")


@query(f"WITH {D.dimension('concepts')}, {D.dimension('arxiv_prefixes')}, {_SLUGS}, {_LINKED} " + _BY_CATEGORY.format(where=""))
def category_disciplines(spark, sf_dir):
    return link.link_categories(_linked(spark, sf_dir), dims.dimension(spark, "arxiv_prefixes"), _slugs(spark))


@query(f"""WITH {D.dimension('concepts')}, {D.dimension('arxiv_prefixes')}, {_SLUGS}, {_LINKED}
  SELECT paper_id, target_id AS discipline_id, 'openalex' AS source FROM ({_BY_CONCEPT.format(where='WHERE len(concept_ids) > 0', kind='discipline')})
  UNION ALL SELECT *, 'arxiv' FROM ({_BY_CATEGORY.format(where='WHERE len(concept_ids) = 0 AND len(arxiv_categories) > 0')})
  UNION ALL SELECT id, 'id-economics', 'nber' FROM linked WHERE len(concept_ids) = 0 AND len(arxiv_categories) = 0 AND source = 'NBER Working Papers'""")  # fmt: skip
def routed_links(spark, sf_dir):
    return link.routed_links(_linked(spark, sf_dir), dims.dimension(spark, "concepts"), dims.dimension(spark, "arxiv_prefixes"), _slugs(spark))


@query(f"""WITH {D.dimension('journals')}, {D.dimension('journal_issns')}
  SELECT issn, journal, discipline FROM journal_issns LEFT JOIN (SELECT lower(name) AS k, arg_min(discipline, discipline_ord * 1000 + ordinal) AS discipline FROM journals GROUP BY 1) ON lower(journal) = k""")  # fmt: skip
def journal_disciplines(spark, sf_dir):
    return link.journal_discipline(dims.dimension(spark, "journal_issns"), dims.dimension(spark, "journals"))


@query(f"""WITH {D.dimension('journals')}, j AS (SELECT *, row_number() OVER (ORDER BY discipline_ord, ordinal) - 1 AS n FROM journals),
  f AS (SELECT concat('W', doc_id - doc_id % 3) AS openalex_id, doc_id AS ordinal, doc_id % 5 AS discipline_ord, documents.source, source_id FROM documents LEFT JOIN j ON n = doc_id % 300),
  c AS (SELECT source_id, arg_max(name, discipline_ord * 1000 + ordinal) AS configured FROM journals GROUP BY 1)
  SELECT openalex_id, ordinal, discipline_ord, source FROM (SELECT openalex_id, ordinal, discipline_ord, coalesce(configured, source) AS source, row_number() OVER (PARTITION BY openalex_id ORDER BY discipline_ord, ordinal) AS rn
    FROM f LEFT JOIN c USING (source_id)) WHERE rn = 1""")  # fmt: skip
def journal_claims(spark, sf_dir):
    from pyspark.sql import Window

    journals = dims.dimension(spark, "journals")
    j = journals.select((F.row_number().over(Window.orderBy("discipline_ord", "ordinal")) - 1).alias("n"), F.col("source_id").alias("source_openalex_id"))
    d = table(spark, sf_dir, "documents").selectExpr("concat('W', doc_id - doc_id % 3) AS openalex_id", "doc_id AS ordinal", "doc_id % 5 AS discipline_ord", "source", "doc_id % 300 AS m")
    return link.claim_journal_papers(d.join(j, d["m"] == j["n"], "left").drop("m", "n"), journals).select("openalex_id", "ordinal", "discipline_ord", "source")


# ---- entity resolution

_KEYED = f"keyed AS (SELECT concat('q', doc_id) AS id, CASE WHEN doc_id % 4 = 0 THEN concat('V', doc_id - doc_id % 3) END AS openalex_id, CASE WHEN doc_id % 3 <> 0 THEN concat('doi:10.2000/Y', doc_id - doc_id % 6) END AS doi, concat('2301.', doc_id) AS arxiv_id FROM documents)"
_HITS = "red AS (SELECT *, " + D.stored_doi("old_doi") + " AS ndoi FROM redirects), hits AS (" + " UNION ALL ".join(
    f"SELECT k.id AS record_id, r.new_id, r.merged_at, {i} AS priority FROM {{src}} k JOIN red r ON {a} = {b}" for i, (a, b) in enumerate((("k.openalex_id", "r.old_openalex_id"), (D.stored_doi(D.clean_doi("k.doi")), "r.ndoi"), ("k.arxiv_id", "r.old_arxiv_id")), 1)
) + ")"
_WINNER = "SELECT record_id, new_id, conflict FROM (SELECT record_id, new_id, row_number() OVER (PARTITION BY record_id ORDER BY priority, merged_at DESC NULLS FIRST, new_id) AS rn FROM hits) JOIN (SELECT record_id, count(DISTINCT new_id) > 1 AS conflict FROM hits GROUP BY 1) USING (record_id) WHERE rn = 1"


@query(f"WITH {V.SQL['redirects']}, {_KEYED}, {_HITS.format(src='keyed')} {_WINNER}")
def redirect_winners(spark, sf_dir):
    k = table(spark, sf_dir, "documents").selectExpr("concat('q', doc_id) AS id", "CASE WHEN doc_id % 4 = 0 THEN concat('V', doc_id - doc_id % 3) END AS openalex_id", "CASE WHEN doc_id % 3 <> 0 THEN concat('doi:10.2000/Y', doc_id - doc_id % 6) END AS doi", "concat('2301.', doc_id) AS arxiv_id")
    return resolve.redirect_winner(k, V.redirects(spark, sf_dir))


_LIVE = "live AS (SELECT a.id, coalesce(p.id, r.new_id) AS live_id FROM (SELECT DISTINCT paper_id AS id FROM batch WHERE paper_id <> '') a LEFT JOIN papers p ON p.id = a.id LEFT JOIN (SELECT old_id, new_id FROM (SELECT *, row_number() OVER (PARTITION BY old_id ORDER BY merged_at DESC, new_id DESC) AS rn FROM redirects) WHERE rn = 1) r ON r.old_id = a.id)"
_BATCH = "batch AS (SELECT doc_id AS ordinal, CASE WHEN doc_id % 9 = 0 THEN NULL WHEN doc_id % 3 = 1 THEN concat('gone', doc_id) WHEN doc_id % 11 = 0 THEN 'nobody' ELSE concat('p', doc_id - doc_id % 7) END AS paper_id, concat('t', doc_id % 2) AS tag_id, (doc_id % 10) / 10.0::DOUBLE AS confidence FROM documents)"


def _batch(spark, sf_dir):
    return table(spark, sf_dir, "documents").selectExpr("doc_id AS ordinal", "CASE WHEN doc_id % 9 = 0 THEN NULL WHEN doc_id % 3 = 1 THEN concat('gone', doc_id) WHEN doc_id % 11 = 0 THEN 'nobody' ELSE concat('p', doc_id - doc_id % 7) END AS paper_id", "concat('t', doc_id % 2) AS tag_id", "(doc_id % 10) / 10.0D AS confidence")


@query(with_sql("SELECT id, live_id FROM live", "papers", "redirects").replace("\nSELECT id", f", {_BATCH}, {_LIVE}\nSELECT id"))
def resolved_ids(spark, sf_dir):
    return resolve.resolve_ids(_batch(spark, sf_dir).select(F.col("paper_id").alias("id")), V.papers(spark, sf_dir), V.redirects(spark, sf_dir))


@query(with_sql("SELECT ordinal, paper_id, tag_id, confidence, was_moved FROM (SELECT *, row_number() OVER (PARTITION BY paper_id, tag_id ORDER BY was_moved, ordinal) AS rn FROM (SELECT ordinal, live_id AS paper_id, tag_id, confidence, live_id <> paper_id AS was_moved FROM batch JOIN live ON live.id = batch.paper_id WHERE live_id IS NOT NULL)) WHERE rn = 1", "papers", "redirects").replace("\nSELECT ordinal", f", {_BATCH}, {_LIVE}\nSELECT ordinal"))
def resolved_rows(spark, sf_dir):
    return resolve.resolve_rows(_batch(spark, sf_dir), V.papers(spark, sf_dir), V.redirects(spark, sf_dir), ["paper_id", "tag_id"], "ordinal")


_NEW_TAGS = "fresh AS (SELECT concat('p', doc_id) AS paper_id, concat('t', doc_id % 25) AS tag_id, 0.9::DOUBLE AS confidence, 'embedding' AS source FROM documents WHERE doc_id % 2 = 0)"


def _new_tags(spark, sf_dir):
    return table(spark, sf_dir, "documents").filter("doc_id % 2 = 0").selectExpr("concat('p', doc_id) AS paper_id", "concat('t', doc_id % 25) AS tag_id", "0.9D AS confidence", "'embedding' AS source")


@query(f"WITH {V.SQL['paper_tags']}, {_NEW_TAGS} SELECT * FROM fresh UNION ALL SELECT * FROM paper_tags WHERE (paper_id, tag_id) NOT IN (SELECT paper_id, tag_id FROM fresh)")
def tag_upsert(spark, sf_dir):
    return resolve.keyed_overwrite(V.paper_tags(spark, sf_dir), _new_tags(spark, sf_dir), ["paper_id", "tag_id"])


@query(f"WITH {V.SQL['paper_tags']}, {_NEW_TAGS} SELECT * FROM paper_tags UNION ALL SELECT * FROM fresh WHERE (paper_id, tag_id) NOT IN (SELECT paper_id, tag_id FROM paper_tags)")
def tag_insert(spark, sf_dir):
    return resolve.insert_absent(V.paper_tags(spark, sf_dir), _new_tags(spark, sf_dir), ["paper_id", "tag_id"], [F.col("confidence")])


_RANK = "SELECT o_custkey AS paper_id, CAST(o_orderdate AS DATE) AS ranking_date, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END AS discipline_id, max(o_totalprice) AS score FROM orders WHERE {w} GROUP BY 1, 2, 3"


@query(f"WITH a AS ({_RANK.format(w='o_orderkey % 3 <> 0')}), b AS ({_RANK.format(w='o_orderkey % 3 <> 1')}) SELECT * FROM b UNION ALL SELECT * FROM a WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.paper_id = a.paper_id AND b.ranking_date = a.ranking_date AND b.discipline_id = a.discipline_id)")
def ranking_upsert(spark, sf_dir):
    def side(w: str) -> DataFrame:
        o = table(spark, sf_dir, "orders").filter(w)
        return o.groupBy(F.col("o_custkey").alias("paper_id"), F.to_date("o_orderdate").alias("ranking_date"), F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("discipline_id")).agg(F.max("o_totalprice").alias("score"))

    return resolve.keyed_overwrite(side("o_orderkey % 3 <> 0"), side("o_orderkey % 3 <> 1"), ["paper_id", "ranking_date", "discipline_id"])


_STORED_COLS = [
    "concat('p', doc_id) AS id", "CASE WHEN doc_id % 8 = 0 THEN NULL ELSE concat('W', doc_id) END AS openalex_id", "concat('10.3000/', doc_id) AS doi",
    "concat('2402.', doc_id) AS arxiv_id", "CASE WHEN doc_id % 6 = 0 THEN '' ELSE text END AS abstract", "concat('Title ', doc_id, ' of ', source) AS title", "doc_id AS citation_count",
]
#: Of odd documents: those ending in 1, 3, 5 meet a paper, in 7 a redirect by one of its keys, in 9 nothing.
_IN_COLS = [
    "CASE WHEN doc_id % 10 < 7 THEN CASE WHEN doc_id % 5 = 1 THEN NULL ELSE concat('W', doc_id - 1) END WHEN doc_id % 10 = 9 THEN concat('Z', doc_id) WHEN doc_id % 3 = 0 THEN concat('V', doc_id - 1 - (doc_id - 1) % 3) END AS openalex_id",
    "CASE WHEN doc_id % 10 < 7 THEN concat('https://doi.org/10.3000/', doc_id - 1) WHEN doc_id % 10 = 7 AND doc_id % 3 = 2 THEN concat(' doi:10.2000/Y', doc_id - 1 - (doc_id - 1) % 6) END AS doi",
    "CASE WHEN doc_id % 10 < 7 THEN concat('2402.', doc_id) WHEN doc_id % 10 = 7 AND doc_id % 3 = 1 THEN concat('2301.', doc_id - 1) END AS arxiv_id",
]
_IN_FIRST = ["concat('n', doc_id) AS id", *_IN_COLS, "CASE WHEN doc_id % 3 = 0 THEN '' ELSE text END AS abstract", "CASE WHEN doc_id % 7 = 0 THEN NULL ELSE concat('Newer title of ', lang) END AS title", "doc_id AS citation_count", "doc_id AS ord"]
_IN_AGAIN = ["concat('m', doc_id) AS id", *_IN_COLS, "CASE WHEN doc_id % 4 = 1 THEN NULL ELSE concat('again ', text) END AS abstract", "concat('Newest title of ', lang) AS title", "doc_id + 5 AS citation_count", "doc_id + 1000000000 AS ord"]
_UP_COLS = ["openalex_id", "doi", "arxiv_id", "abstract", "title", "citation_count"]
_PICK = "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {k} ORDER BY ord {way}) AS n FROM mw WHERE {w}) WHERE n = 1"


@query(f"""WITH {V.SQL['redirects']}, stored AS (SELECT {', '.join(_STORED_COLS)} FROM documents WHERE doc_id % 2 = 0),
  inc AS (SELECT {', '.join(_IN_FIRST)} FROM documents WHERE doc_id % 2 = 1 UNION ALL SELECT {', '.join(_IN_AGAIN)} FROM documents WHERE doc_id % 10 IN (3, 7, 9)),
  rec AS (SELECT * REPLACE ({D.clean_doi('doi')} AS doi) FROM inc), {_HITS.format(src='rec')}, won AS ({_WINNER}),
  m AS (SELECT i.*, coalesce((SELECT min(s.id) FROM stored s WHERE s.openalex_id = i.openalex_id), (SELECT min(s.id) FROM stored s WHERE {D.stored_doi('s.doi')} = {D.stored_doi('i.doi')}), (SELECT min(s.id) FROM stored s WHERE s.arxiv_id = i.arxiv_id)) AS mid FROM rec i),
  mw AS (SELECT m.*, new_id AS win FROM m LEFT JOIN won ON record_id = m.id),
  u AS ({_PICK.format(k='mid', w='mid IS NOT NULL', way='DESC')}), ua AS ({_PICK.format(k='mid', w="mid IS NOT NULL AND abstract <> ''", way='DESC')}),
  f AS ({_PICK.format(k='win', w="mid IS NULL AND win IS NOT NULL AND abstract <> ''", way='')}),
  i AS ({_PICK.format(k='openalex_id', w='mid IS NULL AND win IS NULL', way='')}), il AS ({_PICK.format(k='openalex_id', w='mid IS NULL AND win IS NULL', way='DESC')}), ia AS ({_PICK.format(k='openalex_id', w="mid IS NULL AND win IS NULL AND abstract <> ''", way='DESC')})
  SELECT s.id, {', '.join(f'CASE WHEN u.id IS NULL THEN s.{c} ELSE u.{c} END AS {c}' for c in _UP_COLS if c != 'abstract')}, coalesce(ua.abstract, nullif(s.abstract, ''), f.abstract) AS abstract
  FROM stored s LEFT JOIN u ON u.mid = s.id LEFT JOIN ua ON ua.mid = s.id LEFT JOIN f ON f.win = s.id
  UNION ALL SELECT i.id, {', '.join(f'il.{c}' for c in _UP_COLS if c != 'abstract')}, ia.abstract FROM i JOIN il USING (openalex_id) LEFT JOIN ia USING (openalex_id)""")  # fmt: skip
def paper_upsert(spark, sf_dir):
    """A batch of which some meet papers, some winners of merges (also gone ones), some nothing; many come twice."""
    d = table(spark, sf_dir, "documents")
    incoming = d.filter("doc_id % 2 = 1").selectExpr(*_IN_FIRST).unionByName(d.filter("doc_id % 10 IN (3, 7, 9)").selectExpr(*_IN_AGAIN))
    out = resolve.upsert(d.filter("doc_id % 2 = 0").selectExpr(*_STORED_COLS), incoming, V.redirects(spark, sf_dir), _UP_COLS, "ord")
    return out.withColumn("abstract", text.blank_to_null(F.col("abstract")))


@query(None)
def paper_upsert_in_order(spark, sf_dir):
    """Records with different keys that meet each other and redirects; a test compares with a sequential version."""
    d = table(spark, sf_dir, "documents")
    keys = ["CASE WHEN doc_id % 5 = 1 THEN NULL ELSE concat('W', doc_id - doc_id % 4) END AS openalex_id", "CASE WHEN doc_id % 3 = 1 THEN concat('10.2000/y', doc_id - doc_id % 6) ELSE concat('10.3000/', doc_id - doc_id % 6) END AS doi", "concat('2402.', doc_id - doc_id % 9) AS arxiv_id"]
    incoming = d.filter("doc_id % 2 = 1").selectExpr(_IN_FIRST[0], *keys, *_IN_FIRST[4:])
    return resolve.upsert(d.filter("doc_id % 2 = 0").selectExpr(*_STORED_COLS), incoming, V.redirects(spark, sf_dir), _UP_COLS, "ord")


# ---- classification

_WORDS = [
    (1, "The", "common", 0), (2, "of", "common", 0), (3, "of", "common", 0), (4, "und", "german", 1), (5, "die", "german", 1), (6, "der", "german", 1), (7, "tion", "syllables", 2), (8, "ment", "syllables", 2),
    (9, "de la", "phrases", 3), (10, "in the", "phrases", 3), (11, "é", "accents", 4), (12, "à", "accents", 4), (13, "ción", "accents", 4), (14, "que", "romance", 5), (15, "La", "romance", 5), (16, "el-la", "romance", 5),
]
_KW = "kw AS (SELECT * FROM (VALUES " + ", ".join(f"({i}, {D.quoted(k)}, {D.quoted(s)}, {o})" for i, k, s, o in _WORDS) + ") t(entry_id, keyword, slug, slug_ord))"
_BODY = "lower(concat_ws(' ', coalesce(title, ''), coalesce(abstract, ''), coalesce(source, '')))"
_KEYWORD_SQL = f"""kd AS (SELECT id AS paper_id, {_BODY} AS body FROM papers),
  tok AS (SELECT DISTINCT paper_id, unnest(regexp_extract_all(body, '{D.W}+')) AS tok FROM kd),
  one AS (SELECT paper_id, entry_id FROM tok JOIN (SELECT entry_id, unnest([lower(keyword), lower(keyword) || 's', lower(keyword) || 'es']) AS tok FROM kw WHERE regexp_full_match(lower(keyword), '{D.W}+')) USING (tok)),
  long AS (SELECT entry_id, lower(keyword) AS k, regexp_extract(lower(keyword), '^{D.W}+') AS tok FROM kw WHERE NOT regexp_full_match(lower(keyword), '{D.W}+')),
  many AS (SELECT paper_id, entry_id FROM tok JOIN long USING (tok) JOIN kd USING (paper_id)
    WHERE CASE WHEN contains(body, k) THEN regexp_matches(body, '(^|[^\\p{{L}}\\p{{N}}_])' || regexp_escape(k) || '(e?s)?($|[^\\p{{L}}\\p{{N}}_])') ELSE false END),
  hits AS (SELECT paper_id, slug, slug_ord, count(*) AS n FROM (SELECT DISTINCT * FROM (SELECT * FROM one UNION ALL SELECT * FROM many)) JOIN kw USING (entry_id) GROUP BY 1, 2, 3 HAVING count(*) >= 2),
  kl AS (SELECT * FROM (SELECT paper_id, slug, least(0.9::DOUBLE, 0.5::DOUBLE + n * 0.1::DOUBLE) AS confidence, row_number() OVER (PARTITION BY paper_id ORDER BY least(0.9::DOUBLE, 0.5::DOUBLE + n * 0.1::DOUBLE) DESC, slug_ord) AS rank FROM hits) WHERE rank <= 3)"""


def _keywords(spark):
    return spark.createDataFrame(_WORDS, "entry_id int, keyword string, slug string, slug_ord int")


@query(f"WITH {V.SQL['papers']}, {_KW}, {_KEYWORD_SQL} SELECT * FROM kl")
def keyword_classify(spark, sf_dir):
    return classify.keyword_labels(V.papers(spark, sf_dir), _keywords(spark)).withColumn("rank", F.col("rank").cast("bigint"))


_TITLED = "concat(ks[1 + doc_id % len(ks)], ' and ', ks[1 + (doc_id + 1) % len(ks)], CASE WHEN doc_id % 3 = 0 THEN concat('s with ', ks[1 + (doc_id + 2) % len(ks)]) ELSE ' in use' END)"


@query(f"""WITH {D.dimension('subfield_keywords')}, kw AS (SELECT * FROM subfield_keywords), per AS (SELECT slug_ord AS so, list(keyword ORDER BY entry_id) AS ks FROM kw GROUP BY 1),
  papers AS (SELECT concat('p', doc_id) AS id, {_TITLED} AS title, text AS abstract, source FROM documents JOIN per ON so = doc_id % (SELECT max(slug_ord) + 1 FROM kw)), {_KEYWORD_SQL} SELECT * FROM kl""")  # fmt: skip
def subfield_classify(spark, sf_dir):
    """The whole dictionary of subfields over whole texts, under titles that hold keywords of one subfield each."""
    kw = dims.dimension(spark, "subfield_keywords")
    per = kw.groupBy(F.col("slug_ord").alias("so")).agg(F.transform(F.array_sort(F.collect_list(F.struct("entry_id", "keyword"))), lambda x: x["keyword"]).alias("ks"))
    n = kw.agg(F.max("slug_ord") + 1).first()[0]
    titled = _TITLED.replace("len(", "size(")
    for k in ("doc_id % ", "(doc_id + 1) % ", "(doc_id + 2) % "):
        titled = titled.replace(f"ks[1 + {k}size(ks)]", f"ks[int({k}size(ks))]")
    papers = table(spark, sf_dir, "documents").join(F.broadcast(per), F.expr(f"so = doc_id % {n}")).selectExpr("concat('p', doc_id) AS id", f"{titled} AS title", "text AS abstract", "source")
    return classify.keyword_labels(papers, kw).withColumn("rank", F.col("rank").cast("bigint"))


_CENTROID_SQL = """per_axis AS (SELECT label, i, avg(embedding[i]::DOUBLE) AS m FROM embeddings, unnest(range(1, 65)) t(i) GROUP BY 1, 2),
  mean AS (SELECT label, list(m ORDER BY i) AS v FROM per_axis GROUP BY 1), mid AS (SELECT label, list_transform(v, lambda x: x / sqrt(list_inner_product(v, v))) AS c FROM mean),
  cut AS (SELECT label, 0.2 + label / 100.0 AS cutoff FROM mean WHERE label % 2 = 0),
  sims AS (SELECT vec_id, mid.label AS slug, coalesce(cutoff, 0.3) AS cutoff, round(list_inner_product(embedding::DOUBLE[], c) / sqrt(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[])), 9) AS score FROM embeddings, mid LEFT JOIN cut USING (label)),
  cl AS (SELECT * FROM (SELECT vec_id, slug, score, row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, slug) AS rank FROM sims WHERE score >= cutoff) WHERE rank <= 3)"""


def _centroid_labels(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    middles = classify.centroids(e)
    cutoffs = e.select("label").distinct().filter("label % 2 = 0").selectExpr("label", "0.2D + label / 100.0D AS cutoff")
    return classify.centroid_labels(e, middles, cutoffs)


@query(f"WITH {_CENTROID_SQL} SELECT vec_id, slug, round(score, 6) AS score, rank FROM cl")
def centroid_classify(spark, sf_dir):
    return _centroid_labels(spark, sf_dir).select("vec_id", "slug", F.round("score", 6).alias("score"), F.col("rank").cast("bigint").alias("rank"))


@query(f"""WITH {V.SQL['papers']}, {_KW}, {_KEYWORD_SQL}, {_CENTROID_SQL}, names AS (SELECT slug, row_number() OVER (ORDER BY slug) - 1 AS n FROM (SELECT DISTINCT slug FROM kw)),
  emb AS (SELECT concat('p', vec_id) AS paper_id, names.slug, score AS confidence, rank FROM cl JOIN names ON n = cl.slug % 6),
  b AS (SELECT paper_id, slug, confidence, rank, 0 AS o FROM kl UNION ALL SELECT *, 1 FROM emb),
  once AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY paper_id, slug ORDER BY o, rank) AS a FROM b) WHERE a = 1),
  cut3 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY paper_id ORDER BY o, rank) AS c FROM once) WHERE c <= 3)
  SELECT paper_id, concat('tag-', slug) AS tag_id, round(confidence, 6) AS confidence, CASE WHEN o = 0 THEN 'keyword' ELSE 'embedding' END AS source FROM cut3 WHERE slug <> 'german'""")  # fmt: skip
def hybrid_classify(spark, sf_dir):
    from pyspark.sql import Window

    by_keyword = classify.keyword_labels(V.papers(spark, sf_dir), _keywords(spark))
    names = _keywords(spark).select("slug").distinct().select((F.row_number().over(Window.orderBy("slug")) - 1).alias("n"), F.col("slug").alias("name"))
    emb = _centroid_labels(spark, sf_dir)
    by_centroid = emb.join(names, F.expr("slug % 6 = n")).select(F.concat(F.lit("p"), "vec_id").alias("paper_id"), F.col("name").alias("slug"), F.col("score").alias("confidence"), "rank")
    tags = names.filter("name <> 'german'").select("name", F.concat(F.lit("tag-"), "name").alias("id"))
    return classify.hybrid_labels(by_keyword, by_centroid, tags).withColumn("confidence", F.round("confidence", 6))


@query("""WITH p AS (SELECT vec_id AS id, list_transform(embedding, lambda x: 1.0::DOUBLE / (1.0::DOUBLE + exp(-8.0::DOUBLE * x::DOUBLE))) AS p FROM embeddings),
  e AS (SELECT id, unnest(p) AS score, unnest(range(0, len(p))) AS label, list_max(p) AS best, list_position(p, list_max(p)) - 1 AS first FROM p)
  SELECT id, label, round(score, 9) AS score FROM e WHERE score >= 0.9::DOUBLE OR (best < 0.9::DOUBLE AND label = first)""")  # fmt: skip
def score_classify(spark, sf_dir):
    p = F.transform("embedding", lambda x: text.sigmoid(F.lit(8.0) * x.cast("double")))
    out = classify.score_labels(table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), p.alias("p")), 0.9)
    return out.select("id", F.col("label").cast("bigint").alias("label"), F.round("score", 9).alias("score"))


_EXT = ["concat('p', p_partkey % 500) AS paper_id", "CASE p_partkey % 4 WHEN 0 THEN 's2_field' WHEN 1 THEN 's2_field_fine' WHEN 2 THEN 'openalex_keyword' ELSE 'other' END AS source", "CASE WHEN p_partkey % 13 = 0 THEN ' ' WHEN p_partkey % 3 = 0 THEN upper(p_name) ELSE concat(p_name, ' ') END AS label_name"]
_EXT_SQL = f"""ext AS (SELECT {', '.join(_EXT)} FROM part), r AS (SELECT paper_id, CASE source WHEN 's2_field' THEN 0 WHEN 's2_field_fine' THEN 1 ELSE 2 END AS r, {D.strip('label_name')} AS name, lower({D.strip('label_name')}) AS low FROM ext WHERE source <> 'other'),
  o AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY paper_id, low ORDER BY r, name) AS rn FROM r WHERE name <> '') WHERE rn = 1),
  ek AS (SELECT paper_id, string_agg(name, ', ' ORDER BY r, low) AS keywords FROM o GROUP BY 1)"""


def _external(spark, sf_dir):
    return classify.external_keywords(table(spark, sf_dir, "part").selectExpr(*_EXT), dims.KEYWORD_SOURCES)


@query(f"WITH {_EXT_SQL} SELECT * FROM ek")
def external_keywords(spark, sf_dir):
    return _external(spark, sf_dir)


@query(f"WITH {V.SQL['papers']}, {_EXT_SQL} SELECT id, concat(title, CASE WHEN source <> '' THEN ' | journal: ' || source ELSE '' END, CASE WHEN keywords <> '' THEN ' | keywords: ' || keywords ELSE '' END) AS seg FROM papers LEFT JOIN ek ON paper_id = id")
def model_input(spark, sf_dir):
    return classify.model_input(V.papers(spark, sf_dir), _external(spark, sf_dir))


# ---- abstract recovery

_LAYERS = """req AS (SELECT id, doc_id, concat('10.4000/', doc_id) AS ndoi, title FROM papers WHERE abstract IS NULL),
  l1 AS (SELECT concat('10.4000/', doc_id) AS ndoi, text AS abstract FROM documents WHERE doc_id % 3 <> 0),
  l2 AS (SELECT concat('10.4000/', page_id * 2) AS ndoi, CASE WHEN page_id % 5 = 0 THEN '' ELSE html END AS abstract FROM pages),
  l3 AS (SELECT concat('10.4000/', item_id * 5) AS ndoi, concat('<p>', text, '</p>') AS abstract FROM benchmark)"""


def _layers(spark, sf_dir):
    p = V.papers(spark, sf_dir)
    req = p.filter("abstract IS NULL").selectExpr("id", "doc_id", "concat('10.4000/', doc_id) AS ndoi", "title")
    l1 = table(spark, sf_dir, "documents").filter("doc_id % 3 <> 0").selectExpr("concat('10.4000/', doc_id) AS ndoi", "text AS abstract")
    l2 = table(spark, sf_dir, "pages").selectExpr("concat('10.4000/', page_id * 2) AS ndoi", "CASE WHEN page_id % 5 = 0 THEN '' ELSE html END AS abstract")
    l3 = table(spark, sf_dir, "benchmark").selectExpr("concat('10.4000/', item_id * 5) AS ndoi", "concat('<p>', text, '</p>') AS abstract")
    return req, recover.layered(req, l1, l2, l3)


_ANSWERS = f"""{_LAYERS}, j AS (SELECT id, ndoi, title, l1.abstract AS a1, {D.strip_tags('l2.abstract')} AS a2, {D.strip_tags('l3.abstract')} AS a3 FROM req LEFT JOIN l1 USING (ndoi) LEFT JOIN l2 USING (ndoi) LEFT JOIN l3 USING (ndoi)),
  t AS (SELECT *, CASE WHEN coalesce(a1, '') <> '' AND {D.abstract_problem('a1', 'title')} = '' THEN 1 WHEN coalesce(a2, '') <> '' THEN 2 WHEN coalesce(a3, '') <> '' THEN 3 END AS layer FROM j),
  u AS (SELECT *, CASE layer WHEN 1 THEN a1 WHEN 2 THEN a2 WHEN 3 THEN a3 END AS taken FROM t),
  answers AS (SELECT id, ndoi, CASE layer WHEN 1 THEN 'semantic_scholar' WHEN 2 THEN 'crossref' WHEN 3 THEN 'unpaywall' END AS source, CASE WHEN taken IS NOT NULL THEN {D.abstract_problem('taken', 'title')} END AS problem, taken FROM u)"""


@query(f"WITH {V.SQL['papers']}, {_ANSWERS} SELECT id, ndoi, source, problem, CASE WHEN problem = '' THEN taken END AS abstract FROM answers")
def layered_recovery(spark, sf_dir):
    return _layers(spark, sf_dir)[1]


@query(f"WITH {V.SQL['papers']}, {_ANSWERS} SELECT id, ndoi FROM req WHERE id NOT IN (SELECT id FROM answers WHERE problem = '')")
def recovery_residual(spark, sf_dir):
    req, answers = _layers(spark, sf_dir)
    return recover.residual(req, answers).select("id", "ndoi")


@query(f"WITH {V.SQL['papers']}, {_ANSWERS} SELECT p.id, coalesce(CASE WHEN problem = '' THEN taken END, p.abstract) AS abstract, CASE WHEN problem = '' THEN a.source END AS abstract_source, CASE WHEN problem = '' THEN TIMESTAMP '{NOW}' END AS updated_at FROM papers p LEFT JOIN answers a ON a.id = p.id")
def recovery_write_back(spark, sf_dir):
    return recover.write_back(V.papers(spark, sf_dir), _layers(spark, sf_dir)[1], V.now())


@query(f"WITH {V.SQL['papers']}, {_ANSWERS} SELECT coalesce(source, '(none)') AS source, count(*) FILTER (WHERE problem = '') AS recovered, count(*) FILTER (WHERE problem <> '') AS invalid, count(*) AS n FROM answers GROUP BY 1")
def recovery_statistics(spark, sf_dir):
    a = _layers(spark, sf_dir)[1]
    return a.groupBy(F.coalesce("source", F.lit("(none)")).alias("source")).agg(F.count_if(F.col("problem") == "").alias("recovered"), F.count_if(F.col("problem") != "").alias("invalid"), F.count(F.lit(1)).alias("n"))


# ---- normalisers of raw records


@query(f"""WITH {V.SQL['papers']} SELECT title, CASE WHEN doc_id % 3 = 0 THEN 'two words' ELSE nullif(abstract, '') END AS abstract, [x.name for x in authors] AS names, source, 2024::INT AS published_year,
    doi, coalesce(nullif(doi, ''), concat('https://openalex.org/W', doc_id)) AS url, CASE WHEN doc_id % 2 = 0 THEN 'https://x.org/a.pdf' END AS pdf_url, concat('https://openalex.org/W', doc_id) AS openalex_id, (doc_id % 4)::INT AS citation_count,
    CASE WHEN doc_id % 2 = 0 THEN ['C1'] ELSE ['C1', 'C2'] END AS concept_ids FROM papers WHERE {D.valid_paper('title', 'source', 'authors', True)} AND title <> ''""")  # fmt: skip
def catalogue_records(spark, sf_dir):
    p = V.papers(spark, sf_dir)
    raw = p.select(F.to_json(F.struct(
        F.expr("concat('https://openalex.org/W', doc_id)").alias("id"), "doi", "title", F.lit(2024).alias("publication_year"), F.expr("CASE WHEN doc_id % 4 <> 0 THEN doc_id % 4 END").alias("cited_by_count"),
        F.expr("CASE WHEN doc_id % 3 <> 0 THEN abstract END").alias("abstract"), F.expr("CASE WHEN doc_id % 3 = 0 THEN map('words', array(1), 'two', array(0)) END").alias("abstract_inverted_index"),
        F.transform("authors", lambda a: F.struct(F.struct(a["name"].alias("display_name"), a["orcid"].alias("orcid"), a["openalex_id"].alias("id")).alias("author"), F.array(F.struct(a["affiliation"].alias("display_name"))).alias("institutions"))).alias("authorships"),
        F.struct(F.expr("CASE WHEN doc_id % 2 = 0 THEN 'https://x.org/a.pdf' END").alias("oa_url")).alias("open_access"), F.struct(F.struct(F.col("source").alias("display_name")).alias("source")).alias("primary_location"),
        F.array(F.struct(F.lit("https://openalex.org/C1").alias("id"), F.lit(0.5).alias("score")), F.struct(F.lit("https://openalex.org/C2").alias("id"), F.expr("CASE WHEN doc_id % 2 = 0 THEN 0.4D ELSE 0.8D END").alias("score"))).alias("concepts"),
    )).alias("value"))
    out = normalize.catalogue(records.parse(raw, "catalogue"))
    return out.select("title", "abstract", F.transform("authors", lambda a: a["name"]).alias("names"), "source", "published_year", "doi", "url", "pdf_url", "openalex_id", "citation_count", "concept_ids")


@query(f"""WITH {V.SQL['papers']} SELECT {D.strip("replace(concat(title, chr(10)), chr(10), ' ')")} AS title, {D.strip("replace(coalesce(abstract, ''), chr(10), ' ')")} AS abstract, concat(doc_id, 'v', doc_id % 2) AS arxiv_id, 'arXiv' AS source,
    CASE WHEN doc_id % 3 = 0 THEN 'b.pdf' ELSE 'a.pdf' END AS pdf_url, ['cs.AI'] AS arxiv_categories, 'cs.AI' AS arxiv_primary_category, nullif(doi, '') AS doi FROM papers
    WHERE title <> '' AND {D.valid_paper(D.strip("replace(concat(title, chr(10)), chr(10), ' ')"), 'NULL::VARCHAR', 'authors', True)}""")  # fmt: skip
def preprint_records(spark, sf_dir):
    raw = V.papers(spark, sf_dir).select(F.to_json(F.struct(
        F.expr("concat('http://arxiv.org/abs/', doc_id, 'v', doc_id % 2)").alias("id"), F.expr("CASE WHEN title <> '' THEN concat(title, chr(10)) ELSE '' END").alias("title"), F.col("abstract").alias("summary"), F.transform("authors", lambda a: F.struct(a["name"].alias("name"))).alias("authors"),
        F.expr("filter(array(named_struct('type', 'application/pdf', 'href', 'a.pdf'), named_struct('type', 'text/html', 'href', 'h'), named_struct('type', CASE WHEN doc_id % 3 = 0 THEN 'application/pdf' ELSE 'x' END, 'href', 'b.pdf')), x -> true)").alias("links"),
        F.expr("array(named_struct('term', 'cs.AI'), named_struct('term', ''))").alias("tags"), F.expr("named_struct('term', 'cs.AI')").alias("arxiv_primary_category"), F.nullif(F.col("doi"), F.lit("")).alias("arxiv_doi"),
    )).alias("value"))
    return normalize.preprints(records.parse(raw, "preprints")).select("title", "abstract", "arxiv_id", "source", "pdf_url", "arxiv_categories", "arxiv_primary_category", "doi")


@query(f"""WITH {V.SQL['papers']}, r AS (SELECT *, CASE WHEN doc_id % 5 = 0 THEN NULL ELSE concat('10.5000/', doc_id) END AS d, CASE WHEN doc_id % 6 = 0 THEN '2024-03-01' WHEN doc_id % 6 = 1 THEN '2023-01-01' WHEN doc_id % 6 = 2 THEN NULL ELSE '2022-12-31' END AS dt FROM papers)
  SELECT title, nullif({D.strip_tags("concat('<jats:p>', coalesce(abstract, ''), '</jats:p>')")}, '') AS abstract, CASE WHEN doc_id % 7 = 0 THEN 'Ada' ELSE 'Ada Li' END AS first_author, source, d AS doi, concat('https://doi.org/', d) AS url, 'one.pdf' AS pdf_url, dt AS published_date
  FROM r WHERE d IS NOT NULL AND dt IS NOT NULL AND length(title) >= 20 AND {D.strip('lower(title)')} <> {D.strip('lower(source)')} AND doc_id % 9 <> 0""")  # fmt: skip
def registry_records(spark, sf_dir):
    date = "named_struct('date-parts', array(%s))"
    p = V.papers(spark, sf_dir)
    raw = p.select("source", F.to_json(F.struct(
        F.expr("CASE WHEN doc_id % 5 = 0 THEN NULL ELSE concat('10.5000/', doc_id) END").alias("DOI"), F.array("title").alias("title"), F.expr("concat('<jats:p>', coalesce(abstract, ''), '</jats:p>')").alias("abstract"),
        F.expr("CASE WHEN doc_id % 9 = 0 THEN array(named_struct('given', '', 'family', '')) ELSE array(named_struct('given', 'Ada', 'family', CASE WHEN doc_id % 7 = 0 THEN NULL ELSE 'Li' END)) END").alias("author"),
        F.expr(f"CASE WHEN doc_id % 6 = 0 THEN {date % 'array(2024, 3)'} WHEN doc_id % 6 = 2 THEN {date % 'array(int(NULL))'} END").alias("published"), F.expr(f"CASE WHEN doc_id % 6 = 1 THEN {date % 'array(2023)'} END").alias("published-print"),
        F.expr(f"CASE WHEN doc_id % 6 > 2 THEN {date % 'array(2022, 12, 31)'} END").alias("published-online"), F.expr("array(named_struct('content-type', 'text/html', 'URL', 'x'), named_struct('content-type', 'application/pdf', 'URL', 'one.pdf'), named_struct('content-type', 'application/pdf', 'URL', 'two.pdf'))").alias("link"),
    )).alias("value"))
    out = normalize.registry(records.parse(raw.withColumnRenamed("source", "journal"), "registry"), F.col("journal"))
    return out.select("title", "abstract", F.get("authors", F.lit(0))["name"].alias("first_author"), "source", "doi", "url", "pdf_url", "published_date")


@query(f"""WITH {V.SQL['papers']} SELECT title, abstract, 'NBER Working Papers' AS source, concat('http://n/', doc_id) AS url, concat('http://n/', doc_id) AS pdf_url FROM papers
  WHERE doc_id % 4 <> 0 AND title <> '' AND {D.valid_paper('title', 'NULL::VARCHAR', "[{'name': 'Ada'}]", True)}""")  # fmt: skip
def feed_records(spark, sf_dir):
    raw = V.papers(spark, sf_dir).selectExpr("title", "CASE WHEN doc_id % 4 = 0 THEN '' ELSE 'Ada' END AS author", "abstract AS summary", "published_date AS published", "concat('http://n/', doc_id) AS link")
    return normalize.feed(raw).select("title", "abstract", "source", "url", "pdf_url")


@query(f"""SELECT category, event_id FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY category) AS f FROM (SELECT event_type AS category, event_id, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id) AS rn FROM events) WHERE rn <= 50) WHERE f = 1""")
def newest_per_category(spark, sf_dir):
    e = table(spark, sf_dir, "events").selectExpr("event_type AS category", "event_type AS category_ord", "event_id AS id", "ts AS published")
    return records.per_category(e).select("category", F.col("id").alias("event_id"))


@query(f"SELECT event_type, count(*) AS n FROM events WHERE ts >= TIMESTAMP '{NOW}' - INTERVAL 7 DAY GROUP BY 1")
def recent_events(spark, sf_dir):
    return table(spark, sf_dir, "events").filter(F.col("ts") >= V.now() - F.expr("INTERVAL 7 DAYS")).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


