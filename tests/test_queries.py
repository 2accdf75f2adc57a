"""Every query with SQL against DuckDB, and the driver's contract."""

import ast
import os

import oracle
import pytest

import __spark_entry__ as entry
from paperloom.plans import registry

SF = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_against_duckdb(spark, name):
    assert oracle.differences(spark, registry.queries()[name], registry.oracle_sql()[name], SF) == ""


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_nothing_else_imports_the_optional_part():
    for folder, _, files in os.walk(os.path.join(ROOT, "paperloom")):
        for f in files:
            if f.endswith(".py") and os.sep + "llm" not in folder:
                for node in ast.walk(ast.parse(open(os.path.join(folder, f), encoding="utf-8").read())):
                    names = [a.name for a in node.names] if isinstance(node, (ast.Import, ast.ImportFrom)) else []
                    assert not any("llm" in n for n in names) and "llm" not in (getattr(node, "module", None) or ""), f


def test_rebuilt_texts_are_never_shuffled(spark, tmp_path):
    texts = ["a b a  c", "", " ", None, "x " * 3000, "a b a  c", "é\ne é "]
    spark.createDataFrame([(i // 2, t) for i, t in enumerate(texts)], "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = registry.queries()["rebuild_text"](spark, str(tmp_path))
    assert sorted(map(tuple, got.collect())) == sorted((i // 2, t) for i, t in enumerate(texts) if t is not None)
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
