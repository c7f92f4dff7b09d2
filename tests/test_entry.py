"""The driver contract where training-data queries cannot be imported."""

from __future__ import annotations

import importlib
import importlib.util
import sys
import warnings

import pytest

import __spark_entry__ as contract
from lakestrata.plans.queries import QUERIES


@pytest.fixture
def without(monkeypatch):
    """The contract module as imported without some module."""

    def load(name):
        for loaded in list(sys.modules):
            if loaded.startswith("lakestrata.llm") or loaded in ("corpus_pipeline", name):
                monkeypatch.delitem(sys.modules, loaded)
        monkeypatch.setitem(sys.modules, name, None)
        return importlib.reload(contract)

    yield load
    monkeypatch.undo()
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        importlib.reload(contract)


@pytest.mark.parametrize("name", ["lakestrata.llm", "xxhash", "tokenizers", "public_tokenizers"])
def test_table_queries_stay(without, name):
    present = importlib.util.find_spec("lakestrata.llm") is not None
    with warnings.catch_warnings(record=True) as said:
        warnings.simplefilter("always")
        found = without(name)
    assert set(found.queries()) == set(found.oracle_sql()) == set(QUERIES)
    assert bool(said) == (present and name != "lakestrata.llm")
