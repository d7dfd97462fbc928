"""The entry module registers the library's queries whatever the optional parts lack."""
from __future__ import annotations

import builtins
import sys

import pytest

import __spark_entry__ as entry
from harness.oracle import ORACLE
from harness.queries import QUERIES


def test_every_library_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("absent", ["llm", "corpus_pipeline", "public_tokenizers", "pandas", "pyarrow"])
def test_a_missing_package_takes_nothing_else_down(monkeypatch, absent):
    real = builtins.__import__

    def without(name, *args, **kwargs):
        if name.split(".")[0] == absent:
            raise ModuleNotFoundError(f"No module named {absent!r}", name=absent)
        return real(name, *args, **kwargs)
    for name in list(sys.modules):
        if name.split(".")[0] in ("llm", "corpus_pipeline"):
            monkeypatch.delitem(sys.modules, name)
    monkeypatch.setattr(builtins, "__import__", without)
    assert set(QUERIES) <= set(entry.queries())
    assert set(ORACLE) <= set(entry.oracle_sql())
