"""Scalar functions of the scholarly engine as Column builders.

A null text counts as '' unless a function says otherwise; all stay inside whole-stage code
generation. Word characters are letters, numbers and the underscore of any script.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: DOI prefixes of publishers whose pages can't be fetched automatically.
WALLED_PREFIXES = ("10.1002", "10.1016", "10.1017", "10.1080", "10.1086", "10.1093", "10.1111", "10.1177", "10.4324")


def strip(c: Column) -> Column:
    """Without white space at either end (any Unicode space); null stays null."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def clean_doi(c: Column) -> Column:
    """The DOI as it is stored: one leading 'doi:' goes, case and URL stay, blank is null."""
    return blank_to_null(strip(F.regexp_replace(strip(c), r"(?i)^doi:", "")))


def normalize_doi(c: Column) -> Column:
    """The DOI as it is compared: lower case, without resolver and 'doi:' (a space after it stays)."""
    return F.regexp_replace(F.regexp_replace(strip(F.lower(blank_to_null(c))), r"^https?://doi\.org/", ""), r"^doi:", "")


def normalize_doi_prefix(c: Column) -> Column:
    """The variant for lookups: prefixes go one after the other, then white space."""
    s = strip(blank_to_null(c))
    for prefix in (r"(?i)^https://doi\.org/", r"(?i)^http://doi\.org/", r"(?i)^doi:"):
        s = F.regexp_replace(s, prefix, "")
    return strip(F.lower(s))


def normalize_doi_stored(c: Column) -> Column:
    """The variant of the store's index: lower case, spaces and the https resolver go, 'doi:' stays."""
    return F.regexp_replace(F.trim(F.lower(c)), r"^https://doi\.org/", "")


def strip_tags(c: Column) -> Column:
    """Without markup; also what remains of JATS once its tags are gone."""
    return strip(F.regexp_replace(c, "<[^>]+>", ""))


def clean_jats(c: Column) -> Column:
    return F.coalesce(strip_tags(c), F.lit(""))


def one_line(c: Column) -> Column:
    """Each line break becomes a space; the ends are stripped, inner runs stay."""
    return strip(F.translate(c, "\n", " "))


def normalize_title(c: Column) -> Column:
    """Lower case, no markup or punctuation, single spaces, 100 characters at most."""
    s = F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "<[^>]+>", "")
    s = F.regexp_replace(s, r"(?U)[^\p{L}\p{N}_\s]", "")
    return F.left(strip(F.regexp_replace(s, r"(?U)\s+", " ")), F.lit(100))


def last_name(authors: Column) -> Column:
    """The last word of the first author's name, lower case; '' without one."""
    name = strip(F.coalesce(F.get(authors, F.lit(0))["name"], F.lit("")))
    return F.lower(F.coalesce(F.try_element_at(F.split(name, r"(?U)\s+"), F.lit(-1)), F.lit("")))


def signature(title: Column, authors: Column, published: Column) -> Column:
    """Title, last name and year, by which papers without identifiers are compared."""
    year = F.left(F.coalesce(published.cast("string"), F.lit("")), F.lit(4))
    return F.concat_ws("|", F.left(normalize_title(title), F.lit(50)), last_name(authors), year)


def recovery_route(doi: Column) -> Column:
    """Which terminal state a paper without abstract ends in."""
    return F.when(F.substring_index(F.coalesce(doi, F.lit("")), "/", 1).isin(*WALLED_PREFIXES), "free_exhausted").otherwise("free_dead")


def keyword_score(n: Column) -> Column:
    return F.least(F.lit(0.9), F.lit(0.5) + n * F.lit(0.1))


def orcid_or_null(c: Column) -> Column:
    """The ORCID as given, null where what follows the resolver has less than 10 characters."""
    bare = strip(F.regexp_replace(c, r"https?://orcid\.org/", ""))
    return F.when(F.length(bare) >= 10, c)


def bare_orcid(c: Column) -> Column:
    return F.regexp_replace(c, r"https?://orcid\.org/", "")


def iso_date(parts: Column) -> Column:
    """YYYY-MM-DD from [year, month, day], month and day 1 where missing; null without a year."""
    part = lambda i: F.get(parts, F.lit(i))
    get = lambda i: F.when(F.size(parts) > i, part(i)).otherwise(F.lit(1))
    whole = part(0).isNotNull() & get(1).isNotNull() & get(2).isNotNull()
    return F.when(whole, F.format_string("%04d-%02d-%02d", part(0), get(1), get(2)))


def incoming_wins(incoming: Column, stored: Column, guarded: bool) -> Column:
    """Update rule of a provided column; a guarded one keeps the stored value where the new is blank."""
    return F.coalesce(blank_to_null(incoming), stored) if guarded else incoming


def stored_wins(incoming: Column, stored: Column) -> Column:
    """Fill rule: the stored value unless it is blank."""
    return F.coalesce(F.nullif(stored, F.lit("")), F.nullif(incoming, F.lit("")))


def sigmoid(c: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-c))


def _let(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of a value that is computed once; lambdas that hold its expression would compute it for every element."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def inverted_index(c: Column) -> Column:
    """word -> positions of a text split at single spaces, made inside the row; null stays null."""
    word = lambda a, i: F.get(a, i)["word"]
    pairs = F.sort_array(F.transform(F.split(c, " ", -1), lambda w, i: F.struct(w.alias("word"), i.alias("pos"))))
    starts = lambda a: F.filter(F.sequence(F.lit(0), F.size(a) - 1), lambda i: (i == 0) | (word(a, i) != word(a, i - 1)))
    positions = lambda a, i, end: F.transform(F.slice(a, i + 1, end - i), lambda x: x["pos"])
    entry = lambda a, s, i, k: F.struct(word(a, i).alias("word"), positions(a, i, F.coalesce(F.get(s, k + 1), F.size(a))).alias("at"))
    entries = _let(pairs, lambda a: _let(starts(a), lambda s: F.transform(s, lambda i, k: entry(a, s, i, k))))
    return F.map_from_entries(F.when(c.isNotNull(), entries))


def rebuild_text(index: Column) -> Column:
    """The text of an inverted index word -> positions; null when it is empty."""
    pairs = lambda m: F.flatten(F.transform(F.map_entries(m), lambda e, i: F.transform(e["value"], lambda p: F.struct(p.alias("pos"), i.alias("ord"), e["key"].alias("word")))))
    return _let(index, lambda m: F.when(F.size(m) > 0, F.array_join(F.transform(F.sort_array(pairs(m)), lambda x: x["word"]), " ")))
