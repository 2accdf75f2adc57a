"""The engine's scalar functions as DuckDB expressions, for the oracle SQL."""

from __future__ import annotations

import csv
import os

from ..functions.rules import BOILERPLATE, VENUE_ENDINGS
from ..functions.text import WALLED_PREFIXES
from ..sources.dims import HERE, SCHEMAS

RESOLVER = r"^https?://doi\.org/"
W = r"[\p{L}\p{N}_]"


def quoted(v: object) -> str:
    return str(v) if isinstance(v, (int, float)) else "'" + str(v).replace("'", "''") + "'"


def dimension(name: str) -> str:
    """A WITH clause that holds a dimension."""
    with open(os.path.join(HERE, f"{name}.csv"), newline="", encoding="utf-8") as f:
        rows = list(csv.reader(f))[1:]
    cols = [c.split() for c in SCHEMAS[name].split(", ")]
    body = ", ".join("(" + ", ".join(v if k == "int" else quoted(v) for (_, k), v in zip(cols, r, strict=True)) + ")" for r in rows)
    return f"{name} AS (SELECT * FROM (VALUES {body}) t({', '.join(c for c, _ in cols)}))"


def strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def clean_doi(x: str) -> str:
    return f"nullif({strip(f'''regexp_replace({strip(x)}, '^doi:', '', 'i')''')}, '')"


def normalize_doi(x: str) -> str:
    bare = strip(f"lower(nullif({x}, ''))")
    for prefix in (RESOLVER, "^doi:"):
        bare = f"regexp_replace({bare}, '{prefix}', '')"
    return bare


def normalize_doi_prefix(x: str) -> str:
    s = strip(f"nullif({x}, '')")
    for p in (r"^https://doi\.org/", r"^http://doi\.org/", "^doi:"):
        s = f"regexp_replace({s}, '{p}', '', 'i')"
    return strip(f"lower({s})")


def stored_doi(x: str) -> str:
    return rf"regexp_replace(trim(lower({x})), '^https://doi\.org/', '')"


def strip_tags(x: str) -> str:
    return strip(f"regexp_replace({x}, '<[^>]+>', '', 'g')")


def normalize_title(x: str) -> str:
    s = f"regexp_replace(lower(coalesce({x}, '')), '<[^>]+>', '', 'g')"
    s = rf"regexp_replace({s}, '[^\p{{L}}\p{{N}}_\s]', '', 'g')"
    return f"left({strip(rf'''regexp_replace({s}, '\s+', ' ', 'g')''')}, 100)"


def last_name(x: str) -> str:
    return rf"lower(coalesce(list_extract(regexp_split_to_array({strip(f'''coalesce({x}[1].name, '')''')}, '\s+'), -1), ''))"


def signature() -> str:
    return f"concat_ws('|', left({normalize_title('title')}, 50), {last_name('authors')}, left(coalesce(published_date, ''), 4))"


def route(x: str) -> str:
    return f"CASE WHEN string_split(coalesce({x}, ''), '/')[1] IN ({', '.join(map(quoted, WALLED_PREFIXES))}) THEN 'free_exhausted' ELSE 'free_dead' END"


def valid_paper(title: str, source: str, authors: str, strict: bool) -> str:
    low = strip(f"lower(coalesce({title}, ''))")
    named = f"len(list_filter(coalesce({authors}, []), lambda a: length({strip('''coalesce(a.name, '')''')}) > 0)) > 0"
    ok = f"length(coalesce({title}, '')) >= 20 AND NOT coalesce({low} = {strip(f'''lower(nullif({source}, ''))''')}, false) AND {named}"
    if strict:
        venue = " OR ".join(f"{low} = {quoted(v)} OR ends_with({low}, {quoted(' ' + v)})" for v in VENUE_ENDINGS)
        ok += f" AND NOT (length(coalesce({title}, '')) < 50 AND ({venue}))"
    return f"coalesce({ok}, false)"


def abstract_problem(text: str, title: str) -> str:
    t = strip(f"coalesce({text}, '')")
    head = f"lower(coalesce({title}, ''))"
    bad = " ".join(f"WHEN starts_with(lower({t}), {quoted(b)}) THEN {quoted('boilerplate:' + b[:20])}" for b in BOILERPLATE)
    return f"CASE WHEN coalesce({text}, '') = '' THEN 'empty' WHEN length({t}) < 100 THEN concat('too_short:', length({t})) WHEN length({t}) > 12000 THEN concat('too_long:', length({t})) {bad} WHEN {head} <> '' AND starts_with(lower({t}), left({head}, 80)) AND length({t}) < length({head}) + 120 THEN 'title_only' ELSE '' END"
