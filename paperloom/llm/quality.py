"""Quality rules: a threshold table compiled into one Spark projection.

Every metric is a built-in expression, so the whole decision stays inside the JVM: there is no
shuffle, no user function and no second pass over the text.

The ratio of distinct words falls with a text's length, however clean it is. A text below it is
therefore rejected only if its windows of WINDOW words fall below it on average too (few words over
and over), or if most of its runs of RUN words are repeats (a long passage over and over). Up to
WINDOW words the first holds whenever the ratio itself is too low. The DuckDB SQL has the ratio
alone, so the two may differ beyond WINDOW words.

Defined results: a null text counts as empty; an empty text has no words and is rejected; a null
ratio cannot occur because every denominator is at least 1. Repeated rows are judged one by one and
all kept or all rejected. Other columns are carried along, also ones named like a metric.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters that prose rarely holds; counted one by one.
SYMBOLS = "#%&*$|~^{}<>\\_=+"
#: Emphasis marks count apart: prose may hold a few.
SHOUTS = "!"
SPACES = " \t\n\r\f"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÑÒÓÔÕÖØÙÚÛÜÝŒ"
#: Function words of four languages in one list: a wrong language tag then does no harm.
STOP_WORDS = tuple(
    sorted(
        set(
            "the of and to a in is that it for was on with as be by this are at from or an not "
            "der die und den von zu das mit sich des auf für ist im nicht dem ein eine als auch "
            "de la le et les un du une que pour est par dans qui avec pas sur au "
            "el en y los se las del por con no su para es al lo como".split()
        )
    )
)


@dataclass(frozen=True)
class Rule:
    """Keep when ``low <= metric <= high``; judged only from ``min_words`` words on.

    With ``confirmed``, it is broken only if one of those metrics is below its bound as well.
    """

    name: str
    metric: str
    low: float | None = None
    high: float | None = None
    min_words: int = 0
    confirmed: tuple[tuple[str, float], ...] = ()


#: Words of a window, and of a run.
WINDOW = 20_000
RUN = 5
LOW_VARIETY = 0.2

#: The production table.
RULES = (
    Rule("length", "n_words", 1, None),
    Rule("word_length", "mean_word_length", 1.5, 20.0, 10),
    Rule("symbols", "symbol_ratio", None, 0.1),
    Rule("shouts", "shout_ratio", None, 0.3, 3),
    Rule("capitals", "upper_ratio", None, 0.5, 10),
    Rule("stop_words", "stop_ratio", 0.05, None, 50),
    Rule("word_variety", "distinct_ratio", LOW_VARIETY, None, 20, (("window_ratio", LOW_VARIETY), ("run_ratio", 0.5))),
    Rule("repeated_lines", "repeated_line_ratio", None, 0.5),
)
METRICS = (
    "n_words", "mean_word_length", "symbol_ratio", "shout_ratio", "upper_ratio", "stop_ratio",
    "distinct_ratio", "repeated_line_ratio",
)


def _removed(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def with_metrics(docs: DataFrame, out: str) -> DataFrame:
    """``docs`` with the metrics as struct column ``out``; the helpers go again."""
    text = F.coalesce(F.col("text"), F.lit(""))
    body = F.btrim(text, F.lit(SPACES))
    words = F.when(F.length(body) > 0, F.split(F.lower(body), "[ \\t\\n\\r\\f]+")).otherwise(F.array().cast("array<string>"))
    lines = F.filter(F.split(body, "\\n"), lambda x: F.length(F.btrim(x, F.lit(SPACES))) > 0)
    pre = out + "_parts"
    staged = docs.withColumn(pre, F.struct(body.alias("body"), words.alias("words"), lines.alias("lines")))
    p = F.col(pre)
    count = out + "_distinct"
    staged = staged.withColumn(count, F.size(F.array_distinct(p["words"])))
    n = F.size(p["words"])
    n1 = F.greatest(n, F.lit(1)).cast("double")
    chars = F.greatest(F.length(p["body"]), F.lit(1)).cast("double")
    n_lines = F.greatest(F.size(p["lines"]), F.lit(1)).cast("double")
    spaces = _removed(p["body"], SPACES)
    distinct_ratio = F.col(count) / n1
    # pairs of word and window, so that no lambda holds the array of words
    in_windows = F.size(F.array_distinct(F.transform(p["words"], lambda w, i: F.xxhash64(w, F.floor(i / WINDOW)))))
    shifted = F.arrays_zip(*[F.slice(p["words"], F.lit(k + 1), F.greatest(n - (RUN - 1), F.lit(0))).alias(f"w{k}") for k in range(RUN)])
    runs = F.size(F.array_distinct(F.transform(shifted, lambda x: F.xxhash64(*[x[f"w{k}"] for k in range(RUN)]))))
    low = distinct_ratio < LOW_VARIETY  # the two are needed, and made, for few texts only
    metrics = F.struct(
        n.cast("bigint").alias("n_words"),
        ((F.length(p["body"]) - spaces) / n1).alias("mean_word_length"),
        (_removed(p["body"], SYMBOLS) / n1).alias("symbol_ratio"),
        (_removed(p["body"], SHOUTS) / n1).alias("shout_ratio"),
        (_removed(p["body"], UPPER) / chars).alias("upper_ratio"),
        (F.size(F.filter(p["words"], lambda w: w.isin(*STOP_WORDS))) / n1).alias("stop_ratio"),
        distinct_ratio.alias("distinct_ratio"),
        (1.0 - F.greatest(F.size(F.array_distinct(p["lines"])), F.when(F.size(p["lines"]) == 0, 1).otherwise(0)) / n_lines).alias("repeated_line_ratio"),
        F.when(low, in_windows / n1).otherwise(1.0).alias("window_ratio"),
        F.when(low, runs / F.greatest(n - (RUN - 1), F.lit(1))).otherwise(1.0).alias("run_ratio"),
    )
    # a generator of one row: no filter is pushed below it, which would compute the metrics a second time
    return staged.select(*[F.col(f"`{c}`") for c in docs.columns], F.inline(F.array(F.struct(metrics.alias(out)))))


def compiled(metrics: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """The names of the broken rules, joined by commas; '' when there is none."""
    broken = []
    for r in rules:
        v = metrics[r.metric]
        bad = F.lit(False)
        if r.low is not None:
            bad = bad | (v < r.low)
        if r.high is not None:
            bad = bad | (v > r.high)
        if r.min_words:
            bad = bad & (metrics["n_words"] >= r.min_words)
        if r.confirmed:
            bad = bad & reduce(or_, [metrics[name] < bound for name, bound in r.confirmed])
        broken.append(F.when(bad, F.lit(r.name)))
    return F.concat_ws(",", *broken)


def free_name(docs: DataFrame, name: str) -> str:
    """``name``, lengthened until no column (in any case) begins with it."""
    taken = [c.lower() for c in docs.columns]
    while any(c.startswith(name.lower()) for c in taken):
        name += "_"
    return name


def kept(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The documents that break no rule, with their own columns."""
    m = free_name(docs, "q_metrics")
    return with_metrics(docs, m).filter(compiled(F.col(m), rules) == "").select(*[F.col(f"`{c}`") for c in docs.columns])


def measured(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The documents that break no rule, with their own columns and the metrics, whose names are lengthened where taken."""
    m = free_name(docs, "q_metrics")
    taken, named = {c.lower() for c in docs.columns}, []
    for k in METRICS:
        name = k
        while name in taken:
            name += "_"
        taken.add(name)
        named.append(F.col(m)[k].alias(name))
    return with_metrics(docs, m).filter(compiled(F.col(m), rules) == "").select(*[F.col(f"`{c}`") for c in docs.columns], *named)


def judged(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row a document: doc_id, each metric, ``broken`` and ``keep``."""
    m = free_name(docs, "q_metrics")
    x = with_metrics(docs.select("doc_id", "text"), m)
    return x.select("doc_id", *[F.col(m)[k].alias(k) for k in METRICS], compiled(F.col(m), rules).alias("broken")).withColumn("keep", F.col("broken") == "")


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sql_body(source: str, columns: str = "*", rules: tuple[Rule, ...] = RULES) -> str:
    """DuckDB SQL: rows of ``source`` (with text) with the metrics and ``broken``."""
    sp = "' ' || chr(9) || chr(10) || chr(13) || chr(12)"
    gone = lambda chars: f"(length(body) - length(translate(body, {_quoted(chars)}, '')))"
    stop = ", ".join(map(_quoted, STOP_WORDS))
    broken = []
    for r in rules:
        tests = ([f"{r.metric} < {r.low}"] if r.low is not None else []) + ([f"{r.metric} > {r.high}"] if r.high is not None else [])
        broken.append(f"CASE WHEN ({' OR '.join(tests)}) AND n_words >= {r.min_words} THEN {_quoted(r.name)} END")
    return f"""
SELECT *, concat_ws(',', {', '.join(broken)}) AS broken FROM (
  SELECT * EXCLUDE (body, words, lines),
    len(words)::BIGINT AS n_words,
    (length(body) - (length(body) - length(translate(body, {sp}, ''))))::DOUBLE / greatest(len(words), 1)::DOUBLE AS mean_word_length,
    {gone(SYMBOLS)}::DOUBLE / greatest(len(words), 1)::DOUBLE AS symbol_ratio,
    {gone(SHOUTS)}::DOUBLE / greatest(len(words), 1)::DOUBLE AS shout_ratio,
    {gone(UPPER)}::DOUBLE / greatest(length(body), 1)::DOUBLE AS upper_ratio,
    len(list_filter(words, lambda w: w IN ({stop})))::DOUBLE / greatest(len(words), 1)::DOUBLE AS stop_ratio,
    len(list_distinct(words))::DOUBLE / greatest(len(words), 1)::DOUBLE AS distinct_ratio,
    CASE WHEN len(lines) = 0 THEN 0.0::DOUBLE ELSE 1.0::DOUBLE - len(list_distinct(lines))::DOUBLE / len(lines)::DOUBLE END AS repeated_line_ratio
  FROM (
    SELECT *, CASE WHEN body = '' THEN []::VARCHAR[] ELSE regexp_split_to_array(lower(body), '[ \\t\\n\\r\\f]+') END AS words,
      list_filter(string_split(body, chr(10)), lambda x: trim(x, {sp}) <> '') AS lines
    FROM (SELECT {columns}, trim(coalesce(text, ''), {sp}) AS body FROM {source})))"""
