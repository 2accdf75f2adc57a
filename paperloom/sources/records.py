"""Schemas and readers of the raw records that the engine takes in.

Each feed is landed as JSON lines, one record a line, or as whole answers: an envelope of registry items,
an RSS feed or an Atom answer a row. Readers are lazy and splittable; a line that isn't a record gives
nulls and is dropped by the normaliser's first rule; ``rejected`` returns such lines.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CATALOGUE = (
    "id string, doi string, title string, publication_date string, publication_year int, cited_by_count int, abstract string, "
    "abstract_inverted_index map<string,array<int>>, authorships array<struct<author:struct<display_name:string,orcid:string,id:string>,institutions:array<struct<display_name:string>>>>, "
    "open_access struct<oa_url:string>, primary_location struct<source:struct<display_name:string,id:string>>, concepts array<struct<id:string,score:double>>"
)
#: ``title`` may be a string or a list; it is read as text and opened by the normaliser.
REGISTRY = (
    "DOI string, title string, abstract string, author array<struct<given:string,family:string,ORCID:string,affiliation:array<struct<name:string>>>>, "
    "published struct<`date-parts`:array<array<int>>>, `published-print` struct<`date-parts`:array<array<int>>>, `published-online` struct<`date-parts`:array<array<int>>>, link array<struct<`content-type`:string,URL:string>>"
)
#: The same as fields of a struct.
REGISTRY_FIELDS = REGISTRY.replace("` struct", "`:struct").replace(" string", ":string").replace(" array<struct", ":array<struct").replace("published struct", "published:struct")
PREPRINTS = (
    "id string, title string, summary string, published string, updated string, link string, authors array<struct<name:string,arxiv_affiliation:string>>, "
    "links array<struct<type:string,title:string,href:string>>, tags array<struct<term:string>>, arxiv_primary_category struct<term:string>, arxiv_doi string, arxiv_journal_ref string, arxiv_comment string"
)
FEED = "title string, author string, summary string, published string, link string"
BULK = "externalIds struct<DOI:string>, doi string, abstract string"
RSS = "channel struct<item:array<struct<title:string,author:string,`dc:creator`:string,description:string,pubDate:string,link:string>>>"
ATOM = (
    "entry array<struct<id:string,title:string,summary:string,published:string,updated:string,author:array<struct<name:string,`arxiv:affiliation`:string>>,"
    "link:array<struct<_href:string,_rel:string,_type:string,_title:string>>,category:array<struct<_term:string>>,`arxiv:primary_category`:struct<_term:string>,"
    "`arxiv:doi`:string,`arxiv:journal_ref`:string,`arxiv:comment`:string>>"
)
#: Entries taken of one feed.
FEED_MOST = 50
SCHEMAS = {"catalogue": CATALOGUE, "registry": REGISTRY, "preprints": PREPRINTS, "feed": FEED, "bulk": BULK}


def read(spark: SparkSession, kind: str, path: str) -> DataFrame:
    """Landed records of one kind."""
    return spark.read.schema(SCHEMAS[kind]).json(path)


def parse(lines: DataFrame, kind: str, column: str = "value") -> DataFrame:
    """The same from a column of JSON texts; other columns stay."""
    return lines.withColumn("_r", F.from_json(column, SCHEMAS[kind])).select(*[c for c in lines.columns if c != column], "_r.*")


def rejected(lines: DataFrame, kind: str, column: str = "value") -> DataFrame:
    """The lines that aren't records of this kind, with a reason; nothing else stops for them."""
    marked = lines.withColumn("_r", F.from_json(column, SCHEMAS[kind] + ", _corrupt string", {"columnNameOfCorruptRecord": "_corrupt"}))
    bad = F.col(column).isNull() | F.col("_r._corrupt").isNotNull()
    return marked.filter(bad).select(*lines.columns, F.when(F.col(column).isNull(), "empty").otherwise("malformed").alias("reason"))


def envelope(answers: DataFrame, column: str = "value") -> DataFrame:
    """Registry items of whole answers; an answer without a message (an error, a 404) has none. Other columns stay."""
    opened = answers.withColumn("_r", F.from_json(column, f"message struct<items:array<struct<{REGISTRY_FIELDS}>>>"))
    return opened.select(*[c for c in answers.columns if c != column], F.inline("_r.message.items"))


def rss(feeds: DataFrame, column: str = "value", most: int = FEED_MOST) -> DataFrame:
    """The first entries of each whole RSS feed, shaped as ``FEED``; other columns stay."""
    opened = feeds.withColumn("_r", F.from_xml(column, RSS)).select(*[c for c in feeds.columns if c != column], F.explode(F.slice("_r.channel.item", 1, most)).alias("_e"))
    e = F.col("_e")
    return opened.select(*[c for c in feeds.columns if c != column], e["title"].alias("title"), F.coalesce(e["author"], e["dc:creator"]).alias("author"), e["description"].alias("summary"), e["pubDate"].alias("published"), e["link"].alias("link"))


def atom(answers: DataFrame, column: str = "value") -> DataFrame:
    """The entries of whole Atom answers, shaped as ``PREPRINTS``; other columns stay."""
    kept = [c for c in answers.columns if c != column]
    e = F.col("_e")
    opened = answers.withColumn("_r", F.from_xml(column, ATOM)).select(*kept, F.explode("_r.entry").alias("_e"))
    page = F.get(F.filter(e["link"], lambda x: F.coalesce(x["_rel"], F.lit("alternate")) == "alternate"), F.lit(0))["_href"]
    return opened.select(
        *kept, e["id"].alias("id"), e["title"].alias("title"), e["summary"].alias("summary"), e["published"].alias("published"), e["updated"].alias("updated"), page.alias("link"),
        F.transform(e["author"], lambda a: F.struct(a["name"].alias("name"), a["arxiv:affiliation"].alias("arxiv_affiliation"))).alias("authors"),
        F.transform(e["link"], lambda x: F.struct(x["_type"].alias("type"), x["_title"].alias("title"), x["_href"].alias("href"))).alias("links"),
        F.transform(e["category"], lambda c: F.struct(c["_term"].alias("term"))).alias("tags"), F.struct(e["arxiv:primary_category"]["_term"].alias("term")).alias("arxiv_primary_category"),
        e["arxiv:doi"].alias("arxiv_doi"), e["arxiv:journal_ref"].alias("arxiv_journal_ref"), e["arxiv:comment"].alias("arxiv_comment"),
    )


def by_concepts(records: DataFrame, concepts: list[str], now: F.Column, days: int = 7, most: int = 250) -> DataFrame:
    """Recent catalogue records of any of the concepts, the most cited of each, every record once (by the first concept)."""
    from pyspark.sql import Window

    order = F.create_map(*[x for i, c in enumerate(concepts) for x in (F.lit(c), F.lit(i))])
    each = recent(records, "publication_date", now, days).filter("id IS NOT NULL").withColumn("_c", F.explode(F.array_distinct(F.transform("concepts", lambda c: F.try_element_at(order, F.element_at(F.split(c["id"], "/"), F.lit(-1)))))))
    top = Window.partitionBy("_c").orderBy(F.desc(F.coalesce("cited_by_count", F.lit(0))), "id")
    first = Window.partitionBy("id").orderBy("_c")
    cut = each.filter("_c IS NOT NULL").withColumn("_n", F.row_number().over(top)).filter(F.col("_n") <= most)
    return cut.withColumn("_f", F.row_number().over(first)).filter("_f = 1").drop("_n", "_f").withColumnRenamed("_c", "concept_ord")


def recent(records: DataFrame, date: str, now: F.Column, days: int, concept: str | None = None) -> DataFrame:
    """Catalogue records of the last days, of one concept if given."""
    out = records.filter(F.col(date) >= F.date_format(now - F.expr(f"INTERVAL {int(days)} DAYS"), "yyyy-MM-dd"))
    return out.filter(F.exists("concepts", lambda c: c["id"].endswith(concept))) if concept else out


def of_sources(records: DataFrame, source_ids: list[str], start: str, end: str | None = None, most: int | None = None) -> DataFrame:
    """Catalogue records of the given sources in a date range, newest first when capped."""
    bare = F.regexp_replace("primary_location.source.id", "^https://openalex.org/", "")
    out = records.filter(bare.isin(source_ids) & (F.col("publication_date") >= start))
    if end:
        out = out.filter(F.col("publication_date") <= end)
    return out.orderBy(F.desc("publication_date"), "id").limit(most) if most else out


def window(year: int | None = None, start: str | None = None, end: str | None = None) -> tuple[str | None, str | None]:
    """A date range from a year or from both ends, but not from both at once."""
    if year is not None and (start or end):
        raise ValueError("give a year or a range")
    return (f"{year}-01-01", f"{year}-12-31") if year is not None else (start, end)


def per_category(preprints: DataFrame, most: int = 50) -> DataFrame:
    """The newest preprints of each category they were fetched for, each preprint once.

    Rows carry ``category`` and ``category_ord``.
    """
    from pyspark.sql import Window

    top = preprints.withColumn("_rn", F.row_number().over(Window.partitionBy("category").orderBy(F.desc("published"), "id"))).filter(F.col("_rn") <= most)
    once = Window.partitionBy("id").orderBy("category_ord", "_rn")
    return top.withColumn("_first", F.row_number().over(once)).filter("_first = 1").drop("_rn", "_first")


def bulk_answers(bulk: DataFrame) -> DataFrame:
    """ndoi, abstract of a bulk lookup's hits."""
    from ..functions.text import normalize_doi_prefix

    doi = F.coalesce("externalIds.DOI", "doi")
    return bulk.filter("abstract IS NOT NULL AND abstract <> ''").select(normalize_doi_prefix(doi).alias("ndoi"), "abstract").filter("ndoi <> ''").groupBy("ndoi").agg(F.max("abstract").alias("abstract"))


def secondary_keys(env: Mapping[str, str], base: str = "S2_API_KEY", most: int = 9) -> list[str]:
    """Keys of a bulk service from the environment: the base name, then its suffixes _2 to _9; blank ones are left out."""
    names = [base, *(f"{base}_{i}" for i in range(2, most + 1))]
    return [v for n in names if (v := (env.get(n) or "").strip())]


def fetched(requests: DataFrame, fetch: Callable[[list[str], str | None], dict[str, str]], keys: Sequence[str] = (), size: int = 500, tries: int = 3, wait: float = 2.0, pause: float = 0.0) -> DataFrame:
    """ndoi, abstract for the requests (a column ndoi) by a live lookup in chunks, inside tasks.

    ``fetch`` gets a chunk and a key. A ``PermissionError`` means that the key is worn out: the next key
    takes the same chunk, each key once. Any other error is tried again after ``wait`` seconds, doubled
    up to 10; a chunk that fails is left out. ``pause`` seconds lie between chunks of a task.
    """

    def chunk(asked: list[str], at: int) -> tuple[dict[str, str], int]:
        worn, failed = 0, 0
        while True:
            try:
                return fetch(asked, keys[at % len(keys)] if keys else None), at
            except PermissionError:
                worn, at = worn + 1, at + 1
                if worn >= max(1, len(keys)):
                    return {}, at
            except Exception:  # noqa: BLE001
                failed += 1
                if failed >= tries:
                    return {}, at
                time.sleep(min(10.0, wait * 2 ** (failed - 1)))

    def run(batches):  # noqa: ANN001, ANN202
        import pandas as pd

        at, held = 0, []
        for batch in batches:
            held += batch["ndoi"].dropna().tolist()
            while len(held) >= size:
                got, at = chunk(held[:size], at)
                held = held[size:]
                yield pd.DataFrame(list(got.items()), columns=["ndoi", "abstract"])
                time.sleep(pause)
        if held:
            got, at = chunk(held, at)
            yield pd.DataFrame(list(got.items()), columns=["ndoi", "abstract"])

    return requests.select("ndoi").distinct().mapInPandas(run, "ndoi string, abstract string").filter("abstract IS NOT NULL")


def read_jdbc(spark: SparkSession, url: str, query: str, **options: str) -> DataFrame:
    """A parametrised scan of a database."""
    return spark.read.format("jdbc").option("url", url).option("query", query).options(**options).load()
