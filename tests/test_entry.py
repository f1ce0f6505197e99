"""The entry keeps its core queries where the training-data folders, or what they need, are not there."""

import builtins
import importlib
import sys

import pytest


@pytest.mark.parametrize("absent", ["lattica.llm", "public_tokenizers", "corpus_pipeline"])
def test_core_queries_stay(monkeypatch, absent):
    real = builtins.__import__

    def blocked(name, globals=None, locals=None, fromlist=(), level=0):
        if name == absent or name.startswith(f"{absent}."):
            raise ModuleNotFoundError(f"No module named {name!r}")
        return real(name, globals, locals, fromlist, level)

    for name in [m for m in sys.modules if m == "corpus_pipeline" or m.startswith("lattica.llm")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setattr(builtins, "__import__", blocked)
    entry = importlib.reload(importlib.import_module("__spark_entry__"))
    from lattica import plans

    assert set(plans.QUERIES) <= set(entry.queries()) and set(plans.SQL) <= set(entry.oracle_sql())
    assert "pipeline" not in entry.queries()
