"""PII: information-theoretic sanitisation.

Protected entities are the values of personal-data patterns (mail addresses, phone numbers, card
numbers, network addresses). They are always generalised to their class. Beyond that, the corpus
tells which terms give an entity away: with P(t), P(e) and P(e, t) estimated from all documents, the
pointwise mutual information PMI(e; t) = log2 P(e, t) / (P(e) P(t)) reaches the entity's whole
information IC(e) = -log2 P(e) when t occurs only with e. The disclosure of a term is the largest
PMI(e; t) / IC(e) over the entities it occurs with. At GENERALISE it is replaced by a class
('[NAME]', '[NUMBER]', '[TERM]'), at REMOVE it is taken out, in every document.

P(t), P(e) and P(e, t) all count documents, copies included; a term occurs with each entity of its
document, however far away. Besides, a term needs MIN_OCCASIONS
occasions with the same entity, which are distinct stretches of text (the WINDOW terms around the entity),
so that thousands of copies of one page are one; one coincidence says nothing.

The plan: one pass that finds the entities with enough occasions, one that gathers the terms of
these, one that counts every term's documents (pre-aggregated per batch), equi-joins, and one pass
that rewrites. The list of disclosing terms is counted; up to BROADCAST_TERMS it is broadcast, beyond that
it is joined by document. Nothing else is gathered.

Defined results: null and empty texts stay as they are and count no term; texts, terms and addresses
may have any length; repeated rows are counted each in term frequencies and rewritten alike, as are rows
with a null doc_id; an empty table gives an empty result; other columns are carried along by
``sanitised_documents``.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from ..session import checkpointed
from .words import hashes, slices, text_column, trimmed, words

#: For Arrow: texts that may hold an entity.
HINT = r"@|[0-9][0-9 ().-]{5,}[0-9]|[0-9]\.[0-9]|[0-9a-fA-F]:[0-9a-fA-F]*:"
LOCAL = r"[\p{L}\p{N}._%+-]"
BEFORE = regex.compile(f"(?r){LOCAL}++")
DOMAIN = regex.compile(r"@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++)++")
IN_MAIL = regex.compile(f"{LOCAL}*+{DOMAIN.pattern}")
#: Where an entity may begin: entities other than mail addresses begin where a run of digits does, or just before.
ANCHOR = regex.compile(r"@|[+(]?\d++|[A-Z]{2}(?=\d)")
NUMBER = regex.compile(
    r"(?P<NETWORK>(?<![\p{N}.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\p{N}]|\.\p{N}))"
    r"|(?P<ACCOUNT>(?<![\p{L}\p{N}])[A-Z]{2}\d{2}(?: ?[0-9A-Z]{4}){3,7}(?: ?[0-9A-Z]{1,3})?(?![\p{L}\p{N}]))"
    r"|(?P<CARD>(?<![\p{L}\p{N}-])(?:\d{4}[ -]?){3}\d{4}(?![\p{L}\p{N}-]))"
    r"|(?P<NATIONAL>(?<![\p{L}\p{N}-])\d{3}-\d{2}-\d{4}(?![\p{L}\p{N}-]))"
    r"|(?P<PHONE>(?<![\p{L}\p{N}+-])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[ .-]\d{3}[ .-]\d{4})(?![\p{L}\p{N}]))"
)
#: Words on either side of an entity that tell its occasions apart; terms count from the whole text.
WINDOW = 10
MIN_OCCASIONS = 3
GENERALISE = 0.75
REMOVE = 0.95
BROADCAST_TERMS = 200_000
#: Terms handed on at once; bounds memory, not results.
BATCH_TERMS = 200_000
TERM = regex.compile(r"\S+")


def entities(text: str) -> list[tuple[str, int, int]]:
    """Class, start and end of each entity, in order; where two meet, the one that begins first."""
    out: list[tuple[str, int, int]] = []
    end = 0
    for m in ANCHOR.finditer(text):
        a = m.start()
        if m[0] == "@":
            if a >= end and (tail := DOMAIN.match(text, a)) and (head := BEFORE.match(text, end, a)):
                out.append(("MAIL", head.start(), tail.end()))
                end = tail.end()
            continue
        for at in (a, a + 1) if m[0][0] in "+(" else (a,):
            if at >= end and (n := NUMBER.match(text, at)) and not IN_MAIL.match(text, at):
                out.append((n.lastgroup or "", *n.span()))
                end = n.end()
                break
    return out


def key(kind: str, value: str) -> str:
    """Ways of writing one entity have one key."""
    return f"{kind}:{value.lower()}" if kind == "MAIL" else f"{kind}:{regex.sub(r'[^0-9A-Z.]', '', value)}"


def hinted(text: pa.Array) -> list[int]:
    return pc.indices_nonzero(pc.fill_null(pc.match_substring_regex(text, HINT), False)).to_pylist()


def tokens(text: str, found: list[tuple[str, int, int]]) -> tuple[list[int], list[str]]:
    """Places and terms of the words outside the entities, in order."""
    at, parts = 0, []
    for _, a, b in found:
        parts += [text[at:a], " " * (b - a)]
        at = b
    places, terms = [], []
    for m in TERM.finditer("".join([*parts, text[at:]])):
        t = trimmed(m[0].lower())
        if any(c.isalnum() for c in t):
            places.append(m.start())
            terms.append(t)
    return places, terms


def surroundings(text: str) -> list[tuple[str, list[str]]]:
    """Each entity's key with the distinct terms of the text, without other entities."""
    found = entities(text)
    terms = sorted(set(tokens(text, found)[1])) if found else []
    return [(key(kind, text[a:b]), terms) for kind, a, b in found]


def stretches(text: str, found: list[tuple[str, int, int]], places: list[int], terms: list[str]) -> Iterator[tuple[str, set[str], int]]:
    """Each entity's key, the distinct terms within WINDOW words, and a hash of them."""
    for kind, a, b in found:
        i, j = bisect_left(places, a), bisect_left(places, b)
        around = {*terms[max(0, i - WINDOW) : i], *terms[j : j + WINDOW]}
        yield key(kind, text[a:b]), around, int(hashes(pa.array(["\n".join(sorted(around))])).astype(np.int64)[0])


def evidence(text: str) -> Iterator[tuple[str, int, int, list[str]]]:
    """entity, occasion, 1 where the document counts for the terms and else 0, terms ('' for the entity itself).

    The document counts once for each pair of entity and term, however many stretches hold it.
    """
    found = entities(text)
    if not found:
        return
    places, terms = tokens(text, found)
    seen: dict[str, set[str]] = {}
    of: dict[str, set[int]] = {}
    for e, around, h in stretches(text, found, places, terms):
        known = seen.setdefault(e, set())
        of.setdefault(e, set()).add(h)
        around.add("")
        for new, part in ((1, around - known), (0, around & known)):
            if part:
                yield e, h, new, sorted(part)
        known |= around
    whole = set(terms)
    for e, known in seen.items():
        if rest := whole - known:
            # further away: all stretches of the entity here are one occasion, which copies share
            h = of[e].pop() if len(of[e]) == 1 else int(hashes(pa.array(["\n".join(map(str, sorted(of[e])))])).astype(np.int64)[0])
            yield e, h, 1, sorted(rest)


def occasions(docs: DataFrame) -> DataFrame:
    """entity, occasion, document and terms as in ``evidence``, for all documents."""
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.list_(pa.string()))

    def table(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=["entity", "occasion", "document", "terms"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            size = 0
            text = batch.column(0)
            for i in hinted(text):
                for row in evidence(text[i].as_py()):
                    rows.append(row)
                    size += len(row[3])
                    if size > BATCH_TERMS:
                        yield table(rows)
                        rows, size = [], 0
            yield table(rows)

    return docs.select("text").mapInArrow(run, "entity string, occasion bigint, document bigint, terms array<string>")


def of_documents(offsets: np.ndarray, at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Each document with each of its distinct terms."""
    x = (np.repeat(np.arange(len(offsets) - 1), np.diff(offsets)) * max(1, n) + at).astype(np.uint64)
    x.sort()
    if len(x):
        x = x[np.concatenate([[True], x[1:] != x[:-1]])]
    owner, term = np.divmod(x.view(np.int64), max(1, n))
    return owner, term


def term_documents(docs: DataFrame) -> DataFrame:
    """The number of documents of each term, as (term, n)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 32 << 20):
                offsets, at, distinct = words(text_column(part))
                n = np.bincount(of_documents(offsets, at, len(distinct))[1], minlength=len(distinct))
                yield pa.RecordBatch.from_arrays([distinct, pa.array(n.astype(np.int64))], names=["term", "n"])

    return docs.select("text").mapInArrow(run, "term string, n bigint").groupBy("term").agg(F.sum("n").alias("n"))


def document_terms(keyed: DataFrame) -> DataFrame:
    """(row, term) for the distinct terms of each text, split as everywhere else."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                offsets, at, distinct = words(text_column(part))
                owner, at = of_documents(offsets, at, len(distinct))
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(owner)), distinct.take(pa.array(at))], names=["row", "term"])

    return keyed.mapInArrow(run, "row bigint, term string")


def disclosing(docs: DataFrame, min_occasions: int = MIN_OCCASIONS, generalise: float = GENERALISE, remove: float = REMOVE) -> DataFrame:
    """term, disclosure and whether it is removed, for the terms that exceed the threshold."""
    found = occasions(docs)
    # an entity with too few occasions has no term with enough; so most pairs needn't be grouped
    alone = found.groupBy("entity").agg(F.count_distinct("occasion").alias("o"), F.sum(F.when(F.array_contains("terms", ""), F.col("document"))).alias("k_e"))
    # written once: it is read twice, and far smaller than the texts
    alone = checkpointed(alone.filter(F.col("o") >= min_occasions).select("entity", "k_e"))
    pairs = found.join(alone, "entity", "left_semi").select("entity", "occasion", "document", F.explode("terms").alias("term")).filter("term != ''")
    strong = pairs.groupBy("entity", "term").agg(F.count_distinct("occasion").alias("o"), F.sum("document").alias("k_et"))
    strong = checkpointed(strong.filter(F.col("o") >= min_occasions).select("entity", "term", "k_et"))
    df = term_documents(docs)
    total = docs.agg(F.count(F.lit(1)).alias("n_all"))
    joined = strong.join(alone, "entity").join(df, "term").crossJoin(total)
    ic = -F.log2(F.col("k_e") / F.col("n_all"))
    # terms glued to an entity are counted beside it, but not as words
    pmi = F.log2(F.col("k_et") * F.col("n_all") / (F.col("k_e") * F.greatest("n", "k_et")))
    share = F.when(ic > 0, pmi / ic).otherwise(0.0)
    return joined.groupBy("term").agg(F.max(share).alias("disclosure")).filter(F.col("disclosure") >= generalise).withColumn("removed", F.col("disclosure") >= remove)


def generalised(word: str) -> str:
    core = trimmed(word)
    kind = "[NUMBER]" if any(c.isdigit() for c in core) else "[NAME]" if core[:1].isupper() else "[TERM]"
    return word.replace(core, kind, 1)


def rewrite(text: str, terms: dict[str, bool]) -> tuple[str, int, int]:
    """The text with entities and terms generalised or removed, and how many of each."""
    parts, at, found = [], 0, entities(text)
    for kind, a, b in found:
        parts += [text[at:a], f"[{kind}]"]
        at = b
    parts.append(text[at:])
    n = 0
    if terms:

        def swap(m: regex.Match) -> str:
            nonlocal n
            gone = terms.get(trimmed(m[0].lower()))
            if gone is None:
                return m[0]
            n += 1
            return m[0].replace(trimmed(m[0]), "", 1) if gone else generalised(m[0])

        parts[::2] = [TERM.sub(swap, p) for p in parts[::2]]
    return "".join(parts), len(found), n


def _rewritten_column(text: pa.Array, terms_of: list[dict[str, bool]] | dict[str, bool], touched: list[int]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    e, t = np.zeros(len(text), np.int32), np.zeros(len(text), np.int32)
    if not touched:
        return text, e, t
    new = {}
    for i in touched:
        if (value := text[i].as_py()) is not None:
            new[i], e[i], t[i] = rewrite(value, terms_of if isinstance(terms_of, dict) else terms_of[i])
    mask = np.zeros(len(text), bool)
    mask[list(new)] = True
    return pc.replace_with_mask(text, pa.array(mask), pa.array([new[i] for i in sorted(new)], text.type)), e, t


def sanitised_documents(docs: DataFrame, counts: bool = False, broadcast_terms: int = BROADCAST_TERMS) -> DataFrame:
    """All documents with sanitised texts; with ``counts`` only doc_id, text, entities and terms."""
    spark = docs.sparkSession
    terms = checkpointed(disclosing(docs))
    few = terms.limit(broadcast_terms + 1).count() <= broadcast_terms
    base = docs.select("doc_id", "text") if counts else docs
    names, place = base.columns, base.columns.index("text")
    plain = base.toDF(*[f"c{i}" for i in range(len(names))])
    if few:
        known = spark.sparkContext.broadcast({r["term"]: r["removed"] for r in terms.collect()})
    else:
        known = None
        # each document's disclosing terms by an equi-join, then back to the document by its row key
        keyed = plain.withColumn("row", F.xxhash64(*[F.col(c).cast("string") for c in plain.columns]))
        per = document_terms(keyed.select("row", F.col(f"c{place}").alias("text"))).distinct()
        per = per.join(terms, "term").groupBy("row").agg(F.map_from_entries(F.collect_set(F.struct("term", "removed"))).alias("terms"))
        plain = keyed.join(per, "row", "left").drop("row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = known.value if known is not None else None
        for batch in (part for whole in batches for part in slices(whole, f"c{place}")):
            text = batch.column(place)
            touched = set(hinted(text))
            if table is not None:
                terms_of: dict | list = table
                if table:
                    offsets, at, distinct = words(pc.fill_null(text, ""))
                    hit = np.array([w in table for w in distinct.to_pylist()], bool)
                    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
                    touched |= set(np.unique(owner[hit[at]]).tolist())
            else:
                terms_of = [dict(m or []) for m in batch.column(len(names)).to_pylist()]
                touched |= {i for i, m in enumerate(terms_of) if m}
            text, e, t = _rewritten_column(text, terms_of, sorted(touched))
            columns = [text if i == place else batch.column(i) for i in range(len(names))]
            if counts:
                columns += [pa.array(e), pa.array(t)]
            yield pa.RecordBatch.from_arrays(columns, names=[f"c{i}" for i in range(len(columns))])

    schema = plain.select(*[f"c{i}" for i in range(len(names))]).schema
    if counts:
        for c in ("entities", "terms"):
            schema = schema.add(c, IntegerType())
        return plain.mapInArrow(run, schema).toDF(*names, "entities", "terms")
    return plain.mapInArrow(run, schema).toDF(*names)
