"""Queries of intake, run reports and keyed writes, beside those of ``queries``."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import classify, dedup, gates, link, normalize, resolve
from ..session import table
from ..sources import dims, records
from . import sql as D
from . import views as V
from .queries import _ANSWERS, _CENTROID_SQL, _KEYWORD_SQL, _KW, _centroid_labels, _keywords, _layers, query
from .views import NOW, with_sql

# ---- readers of whole answers


@query("""WITH e AS (SELECT page_id, i FROM pages, unnest(range(1, 61)) t(i))
  SELECT page_id, concat('Working paper ', i, ' of the series ', page_id, ' & others') AS title, concat('Text of ', i) AS abstract, CASE WHEN i % 2 = 0 THEN 'Ada Li' ELSE 'Bo' END AS author,
    concat('https://n.example/', page_id, '/', i) AS url, '2024-01-02' AS published_date FROM e WHERE i <= 50 AND i % 7 <> 0""")  # fmt: skip
def rss_records(spark, sf_dir):
    """A feed of 60 entries a page, of which the first 50 count; those without an author are no papers."""
    item = """concat('<item><title>Working paper ', i, ' of the series ', page_id, ' &amp; others</title>', CASE WHEN i % 7 = 0 THEN '' WHEN i % 2 = 0 THEN '<dc:creator>Ada Li</dc:creator>' ELSE '<author>Bo</author>' END,
      '<description>Text of ', i, '</description><pubDate>2024-01-02</pubDate><link>https://n.example/', page_id, '/', i, '</link></item>')"""
    feeds = table(spark, sf_dir, "pages").selectExpr("page_id", f"""concat('<rss xmlns:dc="http://purl.org/dc/elements/1.1/"><channel><title>New</title>', array_join(transform(sequence(1, 60), i -> {item}), ''), '</channel></rss>') AS value""")
    out = records.rss(feeds).withColumn("page", F.col("page_id"))
    # the series is told by the link, as a normalised paper has no column for it
    papers = normalize.feed(out)
    return papers.select(F.split("url", "/")[3].cast("bigint").alias("page_id"), "title", "abstract", F.get("authors", F.lit(0))["name"].alias("author"), "url", "published_date")


@query("""SELECT concat('Preprint ', doc_id, ' about tests of readers') AS title, concat('Summary ', doc_id) AS abstract, concat(doc_id, 'v', 1 + doc_id % 2) AS arxiv_id, ['Ada Li', 'Bo'] AS names, [NULL, 'Lab'] AS affiliations,
    concat('http://arxiv.org/abs/', doc_id, 'v', 1 + doc_id % 2) AS url, CASE WHEN doc_id % 4 <> 0 THEN concat('http://arxiv.org/pdf/', doc_id) END AS pdf_url, ['cs.AI', 'stat.ML'] AS arxiv_categories, 'cs.AI' AS arxiv_primary_category,
    CASE WHEN doc_id % 3 = 0 THEN concat('10.48550/', doc_id) END AS doi, 'cs' AS category FROM documents""")  # fmt: skip
def atom_records(spark, sf_dir):
    """An Atom answer of one entry a document."""
    xml = """concat('<feed xmlns="http://www.w3.org/2005/Atom" xmlns:arxiv="http://arxiv.org/schemas/atom"><entry><id>http://arxiv.org/abs/', doc_id, 'v', 1 + doc_id % 2, '</id><title>Preprint ', doc_id, chr(10), 'about tests of readers</title>',
      '<summary>Summary ', doc_id, chr(10), '</summary><published>2024-01-02T00:00:00Z</published><updated>2024-01-03T00:00:00Z</updated><author><name>Ada Li</name></author><author><name>Bo</name><arxiv:affiliation>Lab</arxiv:affiliation></author>',
      '<link href="http://arxiv.org/abs/', doc_id, 'v', 1 + doc_id % 2, '" rel="alternate" type="text/html"/>', CASE WHEN doc_id % 4 <> 0 THEN concat('<link title="pdf" href="http://arxiv.org/pdf/', doc_id, '" rel="related" type="application/pdf"/>') ELSE '' END,
      '<arxiv:primary_category term="cs.AI"/><category term="cs.AI"/><category term="stat.ML"/>', CASE WHEN doc_id % 3 = 0 THEN concat('<arxiv:doi>10.48550/', doc_id, '</arxiv:doi>') ELSE '' END, '</entry></feed>')"""
    answers = table(spark, sf_dir, "documents").selectExpr("'cs' AS category", f"{xml} AS value")
    out = normalize.preprints(records.atom(answers))
    return out.select("title", "abstract", "arxiv_id", F.transform("authors", lambda a: a["name"]).alias("names"), F.transform("authors", lambda a: a["affiliation"]).alias("affiliations"), "url", "pdf_url", "arxiv_categories", "arxiv_primary_category", "doi", F.lit("cs").alias("category"))


@query("""SELECT concat('10.6000/', doc_id) AS doi, concat('A registered title of document ', doc_id) AS title, CASE WHEN doc_id % 3 = 0 THEN nullif(text, '') WHEN doc_id % 4 <> 0 THEN concat('Looked up ', doc_id) END AS abstract
  FROM (SELECT doc_id, trim(regexp_replace(text, '<[^>]+>', '', 'g'), ' ' || chr(9) || chr(10) || chr(13) || chr(12) || chr(11)) AS text FROM documents WHERE doc_id % 10 <> 7)""")  # fmt: skip
def registry_answers(spark, sf_dir):
    """Envelopes of two items, of which one is broken, and answers that are errors; missing abstracts come from a lookup."""
    d = table(spark, sf_dir, "documents")
    item = F.struct(F.expr("concat('10.6000/', doc_id)").alias("DOI"), F.expr("array(concat('A registered title of document ', doc_id))").alias("title"), F.expr("CASE WHEN doc_id % 3 = 0 THEN text END").alias("abstract"),
        F.expr("array(named_struct('given', 'Ada', 'family', 'Li'))").alias("author"), F.expr("named_struct('date-parts', array(array(2024, 1)))").alias("published"))
    none = F.struct(F.lit("10.6000/none").alias("DOI"), F.expr("array('Short')").alias("title"), F.lit(None).cast("string").alias("abstract"), F.expr("array(named_struct('given', 'Ada', 'family', 'Li'))").alias("author"), F.expr("named_struct('date-parts', array(array(2024, 1)))").alias("published"))
    whole = F.to_json(F.struct(F.struct(F.array(none, item).alias("items")).alias("message")))
    answers = d.select(F.lit("A Journal").alias("journal"), F.when(F.col("doc_id") % 10 == 7, F.lit("Resource not found.")).otherwise(whole).alias("value"))
    lookup = d.filter("doc_id % 4 <> 0").selectExpr("concat('10.6000/', doc_id) AS doi", "concat('Looked up ', doc_id) AS abstract")
    return normalize.registry(records.envelope(answers), F.col("journal"), fallback=lookup).select("doi", "title", "abstract")


@query("SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 'empty' ELSE 'malformed' END AS reason FROM documents WHERE doc_id % 4 < 2")
def rejected_lines(spark, sf_dir):
    lines = table(spark, sf_dir, "documents").selectExpr("doc_id", "CASE doc_id % 4 WHEN 0 THEN NULL WHEN 1 THEN concat('{\"title\": ', doc_id) ELSE concat('{\"title\": \"', doc_id, '\"}') END AS value")
    return records.rejected(lines, "feed").select("doc_id", "reason")


_WORKS = """works AS (SELECT doc_id, concat('https://openalex.org/W', doc_id) AS id, concat('A catalogued title of document ', doc_id) AS title, concat('https://openalex.org/S', doc_id % 9) AS sid, CASE WHEN doc_id % 6 = 0 THEN NULL ELSE 'Journal of Tests' END AS source,
    strftime(DATE '2024-02-01' - (doc_id % 40)::INT, '%Y-%m-%d') AS published, (doc_id % 50)::INT AS cited, concat('C', doc_id % 4) AS c1, concat('C', doc_id % 5) AS c2 FROM documents)"""


def _works(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select(
        F.expr("concat('https://openalex.org/W', doc_id)").alias("id"), F.expr("concat('A catalogued title of document ', doc_id)").alias("title"), F.expr("date_format(DATE '2024-02-01' - int(doc_id % 40), 'yyyy-MM-dd')").alias("publication_date"), F.lit(2024).alias("publication_year"),
        F.expr("int(doc_id % 50)").alias("cited_by_count"), F.lit("").alias("abstract"), F.lit(None).cast("map<string,array<int>>").alias("abstract_inverted_index"), F.lit(None).cast("string").alias("doi"),
        F.expr("array(named_struct('author', named_struct('display_name', 'Ada Li', 'orcid', 'x', 'id', 'A1'), 'institutions', array(named_struct('display_name', 'Lab'))))").alias("authorships"), F.expr("named_struct('oa_url', cast(NULL AS string))").alias("open_access"),
        F.expr("named_struct('source', named_struct('display_name', CASE WHEN doc_id % 6 = 0 THEN NULL ELSE 'Journal of Tests' END, 'id', concat('https://openalex.org/S', doc_id % 9)))").alias("primary_location"),
        F.expr("array(named_struct('id', concat('https://openalex.org/C', doc_id % 4), 'score', 0.9D), named_struct('id', concat('https://openalex.org/C', doc_id % 5), 'score', 0.2D))").alias("concepts"),
    )


@query(f"WITH {_WORKS} SELECT id AS openalex_id, title, source, replace(sid, 'https://openalex.org/', '') AS source_openalex_id, ['x'] AS orcids FROM works WHERE sid IN ('https://openalex.org/S2', 'https://openalex.org/S5') AND published >= '2024-01-05' AND published <= '2024-01-28'")
def journal_records(spark, sf_dir):
    """Works of two sources in a date range, by the variant for journals: ORCIDs stay unchecked."""
    out = normalize.catalogue(records.of_sources(_works(spark, sf_dir), ["S2", "S5"], "2024-01-05", "2024-01-28"), strict=False)
    return out.select("openalex_id", "title", "source", "source_openalex_id", F.transform("authors", lambda a: a["orcid"]).alias("orcids"))


@query(f"WITH {_WORKS} SELECT id FROM works WHERE sid IN ('https://openalex.org/S2', 'https://openalex.org/S5') AND published >= '2024-01-05' ORDER BY published DESC, id LIMIT 20")
def newest_of_sources(spark, sf_dir):
    return records.of_sources(_works(spark, sf_dir), ["S2", "S5"], "2024-01-05", None, 20).select("id")


@query(f"""WITH {_WORKS}, e AS (SELECT DISTINCT id, cited, list_position(['C3', 'C1', 'C4'], c) - 1 AS o FROM (SELECT id, cited, published, c1 AS c FROM works UNION ALL SELECT id, cited, published, c2 FROM works) WHERE published >= '2024-01-25' AND c IN ('C3', 'C1', 'C4')),
  r AS (SELECT *, row_number() OVER (PARTITION BY o ORDER BY cited DESC, id) AS n FROM e) SELECT id, min(o)::INT AS concept_ord FROM r WHERE n <= 30 GROUP BY 1""")  # fmt: skip
def recent_by_concepts(spark, sf_dir):
    return records.by_concepts(_works(spark, sf_dir), ["C3", "C1", "C4"], V.now(), 7, 30).select("id", "concept_ord")


@query("""SELECT concat('T', doc_id) AS title, CASE WHEN doc_id % 2 = 0 THEN concat('W', doc_id) END AS openalex_id, CASE WHEN doc_id % 2 = 1 THEN concat(doc_id, 'v1') END AS arxiv_id, CASE WHEN doc_id % 2 = 0 THEN ['title', 'openalex_id'] ELSE ['title', 'arxiv_id'] END AS provided FROM documents""")
def union_of_sources(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return normalize.union(d.filter("doc_id % 2 = 0").selectExpr("concat('T', doc_id) AS title", "concat('W', doc_id) AS openalex_id"), d.filter("doc_id % 2 = 1").selectExpr("concat('T', doc_id) AS title", "concat(doc_id, 'v1') AS arxiv_id"))


# ---- keyed writes and states

_SUMMARY = "SELECT concat('p', doc_id) AS paper_id, concat('m', doc_id % {m}) AS llm_model, concat('{w} ', lang) AS key_finding, text AS contribution FROM documents WHERE doc_id % {k} = 0"


@query(f"WITH a AS ({_SUMMARY.format(m=2, w='old', k=2)}), b AS ({_SUMMARY.format(m=3, w='new', k=3)}) SELECT * FROM b UNION ALL SELECT * FROM a WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.paper_id = a.paper_id AND b.llm_model = a.llm_model)")
def summary_upsert(spark, sf_dir):
    table(spark, sf_dir, "documents").createOrReplaceTempView("summary_documents")
    side = lambda **x: spark.sql(_SUMMARY.format(**x).replace("FROM documents", "FROM summary_documents"))
    return resolve.keyed_overwrite(side(m=2, w="old", k=2), side(m=3, w="new", k=3), ["paper_id", "llm_model"])


@query(with_sql("SELECT id, CASE WHEN doc_id % 4 = 1 THEN NULL WHEN doc_id % 4 = 3 THEN doc_id % 10 ELSE doc_id END AS latest_rank, CASE WHEN doc_id % 2 = 1 THEN doc_id / 2.0::DOUBLE ELSE 0.0::DOUBLE END AS latest_score FROM papers", "papers"))
def rank_update(spark, sf_dir):
    p = V.papers(spark, sf_dir).selectExpr("id", "doc_id AS latest_rank", "0.0D AS latest_score", "doc_id")
    new = p.filter("doc_id % 2 = 1").selectExpr("id", "CASE WHEN doc_id % 4 = 3 THEN doc_id % 10 END AS latest_rank", "doc_id / 2.0D AS latest_score")
    return resolve.keyed_update(p.drop("doc_id"), new, "id", ["latest_rank", "latest_score"])


_OLD = f"coalesce(created_at < TIMESTAMP '{NOW}' - INTERVAL 30 DAY, false)"


@query(with_sql(f"""SELECT id, CASE WHEN abstract IS NOT NULL THEN abstract_recovery_state WHEN {_OLD} THEN {D.route('doi')} ELSE 'pending' END AS abstract_recovery_state,
  CASE WHEN abstract IS NULL THEN TIMESTAMP '{NOW}' ELSE abstract_recovery_last END AS abstract_recovery_last FROM papers""", "papers"))  # fmt: skip
def recovery_states_after(spark, sf_dir):
    return gates.transition(V.papers(spark, sf_dir), V.now()).select("id", "abstract_recovery_state", "abstract_recovery_last")


@query(f"WITH {V.SQL['papers']}, {_ANSWERS} SELECT id FROM answers WHERE problem = ''")
def recovered_now(spark, sf_dir):
    from ..operators import recover

    req, answers = _layers(spark, sf_dir)
    return gates.recovered_now(recover.write_back(V.papers(spark, sf_dir), answers, V.now()), req)


@query(with_sql("SELECT id FROM papers WHERE source = 'wiki'", "papers"))
def papers_of_discipline(spark, sf_dir):
    return gates.of_discipline(V.papers(spark, sf_dir).withColumnRenamed("source", "discipline"), "wiki").select("id")


# ---- reports

_ROWS = "r AS (SELECT doc_id AS ordinal, CASE WHEN doc_id % 3 = 0 THEN concat('gone', doc_id - doc_id % 2) ELSE concat('p', doc_id - doc_id % 4) END AS paper_id, concat('t', doc_id % 5) AS tag_id FROM documents)"


@query(f"""WITH {V.SQL['papers']}, {V.SQL['redirects']}, {_ROWS}, live AS (SELECT r.*, coalesce(p.id, x.new_id) AS lid FROM r LEFT JOIN papers p ON p.id = r.paper_id LEFT JOIN (SELECT old_id, max(new_id) AS new_id FROM redirects GROUP BY 1) x ON x.old_id = r.paper_id)
  SELECT count(*) AS n_rows, count(*) FILTER (WHERE lid <> paper_id) AS moved, count(*) FILTER (WHERE lid IS NULL) AS dropped, count(*) - count(*) FILTER (WHERE lid IS NULL) - (SELECT count(*) FROM (SELECT DISTINCT lid, tag_id FROM live WHERE lid IS NOT NULL)) AS collapsed FROM live""")  # fmt: skip
def resolution_counts(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").selectExpr("doc_id AS ordinal", "CASE WHEN doc_id % 3 = 0 THEN concat('gone', doc_id - doc_id % 2) ELSE concat('p', doc_id - doc_id % 4) END AS paper_id", "concat('t', doc_id % 5) AS tag_id")
    return resolve.resolution_counts(rows, V.papers(spark, sf_dir), V.redirects(spark, sf_dir), ["paper_id", "tag_id"], "ordinal")


@query(with_sql(f"""SELECT count(*) AS processed, count(*) FILTER (WHERE NOT ok) AS invalid, count(*) FILTER (WHERE ok AND dup) AS duplicates, count(*) FILTER (WHERE ok AND NOT dup) AS inserted
  FROM (SELECT {D.valid_paper('title', 'source', 'authors', True)} AND title <> '' AS ok, coalesce({D.normalize_doi('doi')}, '') <> '' AND row_number() OVER (PARTITION BY {D.normalize_doi('doi')}, {D.valid_paper('title', 'source', 'authors', True)} AND title <> '' ORDER BY doc_id) > 1 AS dup FROM papers)""", "papers"))  # fmt: skip
def intake_statistics(spark, sf_dir):
    from ..functions.rules import valid_paper
    from ..functions.text import normalize_doi

    p = V.papers(spark, sf_dir)
    return normalize.statistics(p, valid_paper(F.col("title"), F.col("source"), F.col("authors")) & (F.col("title") != ""), normalize_doi(F.col("doi")), "doc_id")


@query(f"WITH {V.SQL['papers']}, {_KW}, {_KEYWORD_SQL} SELECT (SELECT count(*) FROM papers) AS papers, count(DISTINCT paper_id) AS classified, (count(DISTINCT paper_id) * 100 // (SELECT count(*) FROM papers))::BIGINT AS per_cent, count(*) / count(DISTINCT paper_id)::DOUBLE AS mean_labels, 0::BIGINT AS fallbacks FROM kl")
def classification_statistics(spark, sf_dir):
    p = V.papers(spark, sf_dir)
    return classify.statistics(p, classify.keyword_labels(p, _keywords(spark)))


@query(f"WITH {_CENTROID_SQL}, l AS (SELECT DISTINCT concat('sf', slug * 3) AS slug FROM cl), {V.SQL['tags']} SELECT slug FROM l WHERE slug NOT IN (SELECT name FROM tags) ORDER BY slug")
def missing_tags(spark, sf_dir):
    labels = _centroid_labels(spark, sf_dir).select(F.concat(F.lit("sf"), (F.col("slug") * 3).cast("string")).alias("slug"))
    return classify.missing_tags(labels, V.tags(spark, sf_dir))


_NEWEST = f"newest AS (SELECT * FROM papers WHERE created_at >= TIMESTAMP '{NOW}' - INTERVAL 45 DAY ORDER BY created_at DESC NULLS LAST, id LIMIT 300)"


@query(f"""WITH {V.SQL['papers']}, {_NEWEST}, k AS (SELECT *, {D.normalize_doi('doi')} AS k FROM newest) SELECT count(*) AS n FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY id) AS rn FROM k WHERE k IS NOT NULL AND k <> '') WHERE rn > 1""")
def newest_duplicates(spark, sf_dir):
    """How many of the newest papers a scan by DOI would remove (a scan's cap is its feature)."""
    return dedup.by_doi(dedup.scanned(V.papers(spark, sf_dir), V.now(), 45, 300)).agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {D.dimension('journals')} SELECT sum(n)::BIGINT AS journals, count(*) AS disciplines FROM (SELECT discipline, count(*) AS n FROM journals GROUP BY 1)")
def journal_totals(spark, sf_dir):
    return link.journal_totals(dims.dimension(spark, "journals"))
