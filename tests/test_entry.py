"""The driver's entry file with and without the training-data operators."""

from __future__ import annotations

import importlib.util
import os
import sys

import pytest

from marquee.plans.registry import REGISTRY

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
OPTIONAL = "marquee.llm"


class Missing:
    """A finder for which one module isn't there."""

    def __init__(self, name):
        self.name = name

    def find_spec(self, name, path=None, target=None):
        if name == self.name:
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)


def load(monkeypatch, missing=None):
    """The entry file as if imported anew."""
    if missing:
        monkeypatch.setattr(sys, "meta_path", [Missing(missing), *sys.meta_path])
        monkeypatch.delitem(sys.modules, missing, raising=False)
    for name in [m for m in sys.modules if m == "corpus_pipeline" or m.split(".")[:2] == OPTIONAL.split(".")]:
        monkeypatch.delitem(sys.modules, name)
    spec = importlib.util.spec_from_file_location("entry_under_test", f"{ROOT}/__spark_entry__.py")
    entry = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(entry)
    return entry


@pytest.mark.parametrize("missing", ["corpus_pipeline", OPTIONAL])
def test_without_the_optional_package_the_questions_stay(monkeypatch, missing):
    entry = load(monkeypatch, missing)
    assert set(entry.queries()) == set(REGISTRY) and set(entry.oracle_sql()) <= set(REGISTRY)


def test_a_broken_import_inside_the_package_is_not_hidden(monkeypatch):
    if importlib.util.find_spec(OPTIONAL) is None:
        pytest.skip("the package is not there")
    with pytest.raises(ModuleNotFoundError, match="xxhash"):
        load(monkeypatch, "xxhash")


def test_every_query_with_sql_is_registered(monkeypatch):
    entry = load(monkeypatch)
    assert set(entry.oracle_sql()) <= set(entry.queries()) and set(REGISTRY) <= set(entry.queries())
