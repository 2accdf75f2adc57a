"""Validity rules of papers and abstracts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip

#: A short title that is one of these, or ends in one, names a venue and not a paper.
VENUE_ENDINGS = ("advances in", "annals of", "bulletin of", "communications", "journal of", "letters", "proceedings of", "reports", "review of", "transactions on")
#: Openings of texts that stand where an abstract should be.
BOILERPLATE = ("abstract not available", "all rights reserved", "copyright ©", "no abstract available")


def valid_paper(title: Column, source: Column, authors: Column, strict: bool = True) -> Column:
    """Whether a record is a paper: a title of its own of 20 characters or more, and a named author.

    Null names and null authors count as blank. With ``strict`` short titles that name a venue go.
    """
    t = F.coalesce(title, F.lit(""))
    low = strip(F.lower(t))
    ok = (F.length(t) >= 20) & ~F.coalesce(low == strip(F.lower(F.nullif(source, F.lit("")))), F.lit(False))
    named = F.exists(F.coalesce(authors, F.array().cast(_AUTHORS)), lambda a: F.length(strip(F.coalesce(a["name"], F.lit("")))) > 0)
    ok = ok & named
    if strict:
        venue = F.lit(False)
        for v in VENUE_ENDINGS:
            venue = venue | (low == v) | low.endswith(" " + v)
        ok = ok & ~((F.length(t) < 50) & venue)
    return F.coalesce(ok, F.lit(False))


_AUTHORS = "array<struct<name:string,affiliation:string,orcid:string,openalex_id:string>>"


def abstract_problem(text: Column, title: Column) -> Column:
    """Why a text is no abstract; '' when it is one."""

    def judged(x: Column) -> Column:
        t, head = x["t"], x["head"]
        n, low = F.length(t), F.lower(t)
        out = F.when(x["empty"], "empty").when(n < 100, F.concat(F.lit("too_short:"), n)).when(n > 12000, F.concat(F.lit("too_long:"), n))
        for b in BOILERPLATE:
            out = out.when(low.startswith(b), "boilerplate:" + b[:20])
        return out.when((head != "") & low.startswith(F.left(head, F.lit(80))) & (n < F.length(head) + 120), "title_only").otherwise("")

    # bound in a lambda, the stripped text is computed once and the generated code stays small
    body = F.coalesce(text, F.lit(""))
    bound = F.struct(strip(body).alias("t"), F.lower(F.coalesce(title, F.lit(""))).alias("head"), (body == "").alias("empty"))
    return F.get(F.transform(F.array(bound), judged), F.lit(0))
