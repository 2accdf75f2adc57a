"""Mixing sources to target weights by Poisson replication.

Every document of source s is repeated ``Poisson(rate_s)`` times, where
``rate_s = weight_s * total / size_s``: on average source s then fills the share ``weight_s`` of the
mixture. The count comes from inverting the distribution at a uniform number hashed from the seed
and the document's id, so a rerun, a retried task or another partitioning draws the same counts.
The copies are then shuffled globally: one exchange on a hashed key, sorted inside each partition.

Only one aggregate of a row per source is needed beside the text. It is counted first: up to
BROADCAST_SOURCES rows it is broadcast, so the text isn't shuffled by a hot source; beyond, it is
joined like any other table.

Defined results: a null source is a source of its own; a null text has size 0; a source of size 0
has rate 0; documents with a null id hash like the text 'null'; repeated rows with the same id are
drawn the same count. A weight that is missing from ``weights`` is 0. Other columns are carried.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpointed
from .quality import free_name

SEED = 20240131
#: Exponent of the temperature weights used when no weights are given.
TEMPERATURE = 0.7
#: Mean size of the mixture against the corpus.
EPOCHS = 1.0
#: Rates up to this are inverted term by term; above, the source is repeated whole this often as well.
MAX_TERM_RATE = 16.0
#: With a rate of at most 16, the tail above 90 repetitions is under 2**-53.
TERMS = 90
#: Most sources whose rates are broadcast (a row has about 800 bytes).
BROADCAST_SOURCES = 20_000


def uniform(seed: int, key: Column, salt: str) -> Column:
    """A number in [0, 1) from 52 bits of the MD5 of seed, salt and key."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.lit(salt), F.coalesce(key.cast("string"), F.lit("null"))).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def rates(docs: DataFrame, weights: Mapping[str, float] | None, epochs: float) -> DataFrame:
    """One row a source: src, rate. Sizes are characters, exactly summed over the whole table."""
    sizes = docs.groupBy(F.col("source").alias("src")).agg(F.sum(F.length(F.coalesce("text", F.lit("")))).cast("double").alias("size"))
    if weights is None:
        sizes = sizes.withColumn("w", F.round(F.pow("size", F.lit(TEMPERATURE)), 3))
    else:
        pairs = [x for k, v in sorted(weights.items()) for x in (F.lit(k), F.lit(float(v)))]
        table = F.create_map(*pairs) if pairs else F.lit(None).cast("map<string,double>")
        sizes = sizes.withColumn("w", F.coalesce(F.try_element_at(table, F.col("src")), F.lit(0.0)))
    totals = sizes.agg(F.sum("size").alias("all_size"), F.sum(F.col("w").cast("decimal(38,3)")).cast("double").alias("all_w"))
    share = F.col("w") / F.col("all_w")
    return sizes.crossJoin(totals).select(
        "src", F.when((F.col("size") > 0) & (F.col("all_w") > 0), share * F.lit(float(epochs)) * F.col("all_size") / F.col("size")).otherwise(0.0).alias("rate")
    )


def cumulative(rate: Column) -> Column:
    """P(N <= k) for k = 0, 1, ... as an array, for a rate of at most MAX_TERM_RATE."""
    start = F.struct(F.exp(-rate).alias("p"), F.lit(0.0).alias("c"), F.array().cast("array<double>").alias("a"))

    def step(acc: Column, k: Column) -> Column:
        c = acc["c"] + acc["p"]
        return F.struct((acc["p"] * rate / (k + F.lit(1)).cast("double")).alias("p"), c.alias("c"), F.array_append(acc["a"], c).alias("a"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(TERMS - 1)), start, step, lambda acc: acc["a"])


def copies(docs: DataFrame, weights: Mapping[str, float] | None = None, epochs: float = EPOCHS, seed: int = SEED) -> DataFrame:
    """The documents' columns with ``copy_no`` (from 0) and ``shuffle_key``, in shuffled order."""
    p = free_name(docs, "mix_")
    src, rate, whole, steps, u, n, copy, key = (p + x for x in ("src", "rate", "whole", "steps", "u", "n", "copy", "key"))
    per = rates(docs, weights, epochs).withColumnRenamed("src", src).withColumnRenamed("rate", rate)
    per = per.withColumn(whole, F.floor(F.greatest(F.col(rate) - F.lit(MAX_TERM_RATE), F.lit(0.0))))
    per = checkpointed(per.withColumn(steps, cumulative(F.col(rate) - F.col(whole))).select(src, whole, steps))
    if per.count() <= BROADCAST_SOURCES:
        per = F.broadcast(per)
    drawn = docs.withColumn(u, uniform(seed, F.col("doc_id"), "count"))  # before the join, so that it is hashed once a document
    counted = drawn.join(per, F.col("source").eqNullSafe(F.col(src)), "inner").withColumn(n, F.col(whole).cast("int") + F.size(F.filter(F.col(steps), lambda c: c <= F.col(u))))
    # in two steps, so that no array is longer than about a thousand however often a document is repeated
    many = counted.filter(F.col(n) > 0).withColumn(copy, F.explode(F.sequence(F.lit(0), F.floor((F.col(n) - 1) / 1000).cast("int"))))
    many = many.withColumn(copy, F.explode(F.sequence(F.col(copy) * 1000, F.least(F.col(n) - 1, F.col(copy) * 1000 + 999))))
    many = many.withColumn(key, F.md5(F.concat_ws(":", F.lit(str(seed)), F.lit("order"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.col(copy).cast("string")).cast("binary")))
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shuffled = many.select(*[F.col(f"`{c}`") for c in docs.columns], copy, key).repartition(parts, F.col(key)).sortWithinPartitions(key)
    return shuffled.withColumnRenamed(copy, p + "no").withColumnRenamed(key, p + "order")


def mixed(docs: DataFrame, weights: Mapping[str, float] | None = None, epochs: float = EPOCHS, seed: int = SEED) -> DataFrame:
    """The mixture with the documents' own columns only."""
    return copies(docs, weights, epochs, seed).select(*[F.col(f"`{c}`") for c in docs.columns])


def sql_copies(source: str, columns: str, epochs: float = EPOCHS, seed: int = SEED) -> str:
    """DuckDB SQL of :func:`copies` with the temperature weights; mix_order is the shuffle's key."""
    return f"""
WITH RECURSIVE base AS (SELECT * FROM {source}),
sizes AS (SELECT source AS src, sum(length(coalesce(text, '')))::DOUBLE AS size FROM base GROUP BY 1),
weighed AS (SELECT *, round(pow(size, {TEMPERATURE}::DOUBLE), 3) AS w FROM sizes),
totals AS (SELECT sum(size) AS all_size, sum(w::DECIMAL(38,3))::DOUBLE AS all_w FROM weighed),
per AS (SELECT src, CASE WHEN size > 0 AND all_w > 0 THEN w / all_w * {epochs}::DOUBLE * all_size / size ELSE 0.0::DOUBLE END AS rate FROM weighed, totals),
per2 AS (SELECT src, rate, floor(greatest(rate - {MAX_TERM_RATE}::DOUBLE, 0.0::DOUBLE)) AS whole FROM per),
terms AS (
  SELECT src, whole, rate - whole AS r, 0 AS k, exp(-(rate - whole)) AS p, 0.0::DOUBLE + exp(-(rate - whole)) AS c FROM per2
  UNION ALL
  SELECT src, whole, r, k + 1, p * r / (k + 1)::DOUBLE, c + p * r / (k + 1)::DOUBLE FROM terms WHERE k < {TERMS - 1}),
steps AS (SELECT src, whole, list(c ORDER BY k) AS cs FROM terms GROUP BY 1, 2),
drawn AS (
  SELECT base.*, whole::INT + len(list_filter(cs, lambda c: c <= u))::INT AS n
  FROM (SELECT *, ('0x' || substr(md5('{seed}:count:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT::DOUBLE / {2**52}::DOUBLE AS u FROM base) base
  JOIN steps ON base.source IS NOT DISTINCT FROM steps.src)
SELECT {columns}, copy::INT AS mix_no, md5('{seed}:order:' || coalesce(doc_id::VARCHAR, 'null') || ':' || copy::VARCHAR) AS mix_order
FROM drawn, unnest(range(0, n)) AS t(copy)"""
