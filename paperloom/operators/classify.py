"""Keyword, centroid and model-score classifiers.

Keywords are matched by an equi-join on tokens: a text's distinct tokens meet each keyword's first
token (and its plurals for one-word keywords); only longer keywords that the text contains are then
verified by a pattern. So the cost follows the text and not text x dictionary. The dictionary goes to
every task and texts stay where they are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import keyword_score, strip

WORD = r"[\p{L}\p{N}_]"
TOP = 3


def keyword_hits(papers: DataFrame, keywords: DataFrame) -> DataFrame:
    """paper_id, slug, slug_ord, n: matching dictionary entries per subfield, two at least."""
    text = F.lower(F.concat_ws(" ", F.coalesce("title", F.lit("")), F.coalesce("abstract", F.lit("")), F.coalesce("source", F.lit(""))))
    docs = papers.select(F.col("id").alias("paper_id"), text.alias("body"))
    words = F.regexp_extract_all("body", F.lit(f"({WORD}+)"), F.lit(1))
    kw = F.lower("keyword")
    first = F.regexp_extract(kw, f"^({WORD}+)", 1)
    single = first == kw
    dim = keywords.select("entry_id", "slug", "slug_ord", kw.alias("kw"), single.alias("single"), F.explode(F.when(single, F.array(kw, F.concat(kw, F.lit("s")), F.concat(kw, F.lit("es")))).otherwise(F.array(first))).alias("probe"))
    probes = [r["probe"] for r in dim.select("probe").distinct().collect()]
    known = docs.select("paper_id", "body", F.array_distinct(F.filter(words, lambda w: w.isin(probes))).alias("known"))
    met = known.select("paper_id", "body", F.explode("known").alias("probe")).join(F.broadcast(dim), "probe")
    # a pattern is compiled and run only where the keyword is in the text
    pattern = F.concat(F.lit(rf"(?<!{WORD})\Q"), "kw", F.lit(rf"\E(?:e?s)?(?!{WORD})"))
    held = F.when(F.col("single"), True).when(F.contains("body", "kw"), F.regexp_like("body", pattern)).otherwise(False)
    kept = met.filter(held).select("paper_id", "slug", "slug_ord", "entry_id").repartition("paper_id")
    return kept.distinct().groupBy("paper_id", "slug", "slug_ord").agg(F.count(F.lit(1)).alias("n")).filter("n >= 2")


def keyword_labels(papers: DataFrame, keywords: DataFrame) -> DataFrame:
    """The three best subfields of each paper: paper_id, slug, confidence, rank."""
    scored = keyword_hits(papers, keywords).withColumn("confidence", keyword_score(F.col("n")))
    w = Window.partitionBy("paper_id").orderBy(F.desc("confidence"), "slug_ord")
    return scored.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= TOP).select("paper_id", "slug", "confidence", "rank")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def centroids(vectors: DataFrame) -> DataFrame:
    """label, centroid: the normalised mean vector of each label."""
    at = vectors.select("label", F.posexplode("embedding").alias("i", "x")).groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("m"))
    mean = at.groupBy("label").agg(F.array_sort(F.collect_list(F.struct("i", "m"))).alias("s")).select("label", F.transform("s", lambda e: e["m"]).alias("v"))
    return mean.select("label", F.transform("v", lambda x: x / F.sqrt(dot(F.col("v"), F.col("v")))).alias("centroid"))


def centroid_labels(vectors: DataFrame, middles: DataFrame, cutoffs: DataFrame, default: float = 0.3) -> DataFrame:
    """The three nearest labels at or above their cutoff: vec_id, slug, score, rank.

    Every vector meets every centroid; there are as many rows of centroids as labels.
    """
    dim = middles.join(cutoffs, "label", "left").select(F.col("label").alias("slug"), "centroid", F.coalesce("cutoff", F.lit(default)).alias("cutoff"))
    norm = F.sqrt(dot(F.col("embedding"), F.col("embedding")))
    scored = vectors.filter(F.size("embedding") > 0).select("vec_id", "embedding", norm.alias("norm")).crossJoin(dim).select("vec_id", "slug", "cutoff", F.round(dot(F.col("embedding"), F.col("centroid")) / F.col("norm"), 9).alias("score"))
    w = Window.partitionBy("vec_id").orderBy(F.desc("score"), "slug")
    return scored.filter("score >= cutoff").withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= TOP).select("vec_id", "slug", "score", "rank")


def hybrid_labels(by_keyword: DataFrame, by_centroid: DataFrame, tags: DataFrame) -> DataFrame:
    """paper_id, tag_id, confidence, source: keyword labels first, then others, three at most.

    The cut comes before labels without a tag are dropped. Both inputs have paper_id, slug,
    confidence and rank.
    """
    both = by_keyword.select("paper_id", "slug", "confidence", "rank", F.lit(0).alias("o")).unionByName(by_centroid.select("paper_id", "slug", "confidence", "rank", F.lit(1).alias("o")))
    once = both.withColumn("_a", F.row_number().over(Window.partitionBy("paper_id", "slug").orderBy("o", "rank"))).filter("_a = 1")
    cut = once.withColumn("_b", F.row_number().over(Window.partitionBy("paper_id").orderBy("o", "rank"))).filter(F.col("_b") <= TOP)
    return cut.join(tags.select(F.col("name").alias("slug"), F.col("id").alias("tag_id")), "slug").select("paper_id", "tag_id", "confidence", F.when(F.col("o") == 0, "keyword").otherwise("embedding").alias("source"))


def modelled(rows: DataFrame, load: Callable[[], Callable[[list[str]], list[list[float]]]], text: str, size: int = 64) -> DataFrame:
    """The rows with ``p``, an array of a model's numbers (an encoder's vector, a classifier's logits) for a text column.

    ``load`` runs once a task and returns the model, which gets ``size`` texts at a time; so devices and
    weights are the caller's. Null texts count as empty.
    """
    from pyspark.sql.functions import pandas_udf

    @pandas_udf("array<double>")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import pandas as pd

        model = load()
        for batch in batches:
            texts = batch.fillna("").tolist()
            yield pd.Series([[float(x) for x in p] for i in range(0, len(texts), size) for p in model(texts[i : i + size])], dtype=object)

    return rows.withColumn("p", score(F.col(text)))


def missing_tags(labels: DataFrame, tags: DataFrame) -> DataFrame:
    """The labels' slugs that no tag has, in order."""
    return labels.select("slug").distinct().join(tags.select(F.col("name").alias("slug")), "slug", "left_anti").orderBy("slug")


def statistics(papers: DataFrame, labels: DataFrame, fallback: DataFrame | None = None) -> DataFrame:
    """One row: papers, classified ones, their share in whole per cent, mean labels of a classified paper, and fallbacks."""
    per = labels.groupBy("paper_id").agg(F.count(F.lit(1)).alias("n"))
    done = per.agg(F.count(F.lit(1)).alias("classified"), F.avg("n").alias("mean_labels"))
    by_fallback = (fallback.select("paper_id").distinct() if fallback is not None else per.select("paper_id").limit(0)).agg(F.count(F.lit(1)).alias("fallbacks"))
    out = papers.agg(F.count(F.lit(1)).alias("papers")).crossJoin(done).crossJoin(by_fallback)
    return out.select("papers", "classified", F.when(F.col("papers") > 0, F.expr("classified * 100 div papers")).otherwise(0).cast("bigint").alias("per_cent"), "mean_labels", "fallbacks")


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    """label, centroid from a JSON object ``{label: {"centroid": [...]}}``; a missing file is an error."""
    raw = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", "map<string,struct<centroid:array<double>>>")).alias("label", "v"))
    return raw.select("label", F.col("v.centroid").alias("centroid"))


def read_cutoffs(spark: SparkSession, path: str) -> DataFrame:
    """label, cutoff from a JSON object ``{label: number}``; no rows where there is no file."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath):
        return spark.createDataFrame([], "label string, cutoff double")
    return spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", "map<string,double>")).alias("label", "cutoff"))


def score_labels(scores: DataFrame, threshold: float) -> DataFrame:
    """id, label, score from an array of probabilities: all at the threshold or above, else the first best."""
    best = F.array_position("p", F.array_max("p")).cast("int") - 1
    every = F.transform("p", lambda x, i: F.struct(i.alias("label"), x.alias("score")))
    over = F.filter(every, lambda e: e["score"] >= threshold)
    chosen = F.when(F.size(over) > 0, over).otherwise(F.array(F.struct(best.alias("label"), F.array_max("p").alias("score"))))
    return scores.filter(F.size("p") > 0).select("id", F.explode(chosen).alias("e")).select("id", "e.label", "e.score")


def external_keywords(labels: DataFrame, sources: dict[str, int]) -> DataFrame:
    """paper_id, keywords: names by source rank and alphabet, the first of each name in any case, joined."""
    rank = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in sources.items() for x in kv]), F.col("source")), F.lit(9))
    name = strip(F.coalesce("label_name", F.lit("")))
    rows = labels.filter(F.col("source").isin(*sources)).select("paper_id", rank.alias("r"), name.alias("name"), F.lower(name).alias("low")).filter("name <> ''")
    once = rows.groupBy("paper_id", "low").agg(F.min(F.struct("r", "low", "name")).alias("s"))
    return once.groupBy("paper_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list("s")), lambda x: x["name"]), ", ").alias("keywords"))


def model_input(papers: DataFrame, keywords: DataFrame, use_journal: bool = True) -> DataFrame:
    """id, seg: title, journal and keywords as one line, each only where it isn't blank."""
    j = F.when(F.lit(use_journal) & (F.coalesce("source", F.lit("")) != ""), F.concat(F.lit(" | journal: "), "source")).otherwise("")
    k = F.when(F.coalesce("keywords", F.lit("")) != "", F.concat(F.lit(" | keywords: "), "keywords")).otherwise("")
    return papers.join(keywords.withColumnRenamed("paper_id", "id"), "id", "left").select("id", F.concat(F.coalesce("title", F.lit("")), j, k).alias("seg"))
