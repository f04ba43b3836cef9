"""The driver's entry points, with and without the llm subpackage."""

from __future__ import annotations

import re
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry
from tracewright import catalog


def test_every_sql_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(catalog.QUERIES) <= set(entry.queries())


def test_entry_gives_rows(spark):
    df = entry.entry(spark)
    assert df.columns == ["conv_id", "segment", "n_messages", "n_assistant", "n_chars", "first_turn", "last_turn", "last_role"]
    assert df.count() > 0


@pytest.mark.parametrize("absent", ["tracewright.llm", "ahocorasick", "corpus_pipeline"])
def test_queries_without_the_subpackage_or_what_it_needs(monkeypatch, absent):
    for name in [n for n in sys.modules if n == "corpus_pipeline" or n.startswith("tracewright.llm")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, absent, None)
    with pytest.warns(UserWarning, match="without"):
        names, sql = set(entry.queries()), set(entry.oracle_sql())
    assert set(catalog.QUERIES) <= names and set(catalog.ORACLE_SQL) <= sql and "pipeline" not in names
    assert ("op1_hilbert_shards" in names) == (absent == "corpus_pipeline")


def test_nothing_else_imports_the_subpackage():
    root = Path(entry.__file__).parent / "tracewright"
    for path in root.rglob("*.py"):
        if "llm" not in path.relative_to(root).parts:
            assert not re.search(r"(from|import) .*\bllm\b", path.read_text()), path
