"""The entry points without packages that the corpus operators need."""

from __future__ import annotations

import importlib

import pytest

import __spark_entry__ as entry
from ledgerline.plans import catalogue


@pytest.mark.parametrize("name, raised", [("tokenizers", False), ("ledgerline.llm.common", True)])
def test_missing_packages(monkeypatch, name, raised):
    def missing(_):
        raise ModuleNotFoundError(f"No module named {name!r}", name=name)

    monkeypatch.setattr(importlib.util, "find_spec", lambda _: object())
    monkeypatch.setattr(importlib, "import_module", missing)
    if raised:
        with pytest.raises(ModuleNotFoundError):
            entry.queries()
    else:
        with pytest.warns(UserWarning, match=name):
            assert set(entry.queries()) == set(catalogue.QUERIES)
