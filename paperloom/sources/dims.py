"""The engine's dimensions: concepts, preprint categories, journals and subfield keywords.

They ship as small CSV files; any other table of the same columns can take their place.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

HERE = os.path.join(os.path.dirname(os.path.abspath(__file__)), "dims")
SCHEMAS = {
    "concepts": "concept_id string, kind string, slug string",
    "arxiv_prefixes": "prefix string, discipline string",
    "journals": "source_id string, name string, discipline string, discipline_ord int, ordinal int",
    "journal_issns": "issn string, journal string, ordinal int",
    "subfield_keywords": "entry_id int, keyword string, slug string, discipline string, slug_ord int",
}
#: Rank of the sources of external keywords; others come last.
KEYWORD_SOURCES = {s: i for i, s in enumerate("s2_field s2_field_fine openalex_keyword".split())}
#: Subfields that ride on another one and never compete.
OVERLAYS = ("american-political-economy",)


def dimension(spark: SparkSession, name: str) -> DataFrame:
    """A dimension by name. The file is read on the driver, so executors don't need the folder."""
    import csv

    with open(os.path.join(HERE, f"{name}.csv"), newline="", encoding="utf-8") as f:
        rows = list(csv.reader(f))[1:]
    kinds = [int if c.split()[1] == "int" else str for c in SCHEMAS[name].split(", ")]
    return spark.createDataFrame([tuple(k(v) for k, v in zip(kinds, r, strict=True)) for r in rows], SCHEMAS[name])
