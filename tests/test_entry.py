"""The entry module registers the library's own queries whatever becomes of the optional part."""

import sys

import pytest

import __spark_entry__ as E
from riskloom.plans.catalog import load_all


@pytest.mark.parametrize("missing", ["zstandard", "xxhash", "regex", "riskloom.llm"])
def test_a_missing_package_keeps_the_other_queries(monkeypatch, missing):
    for name in [m for m in sys.modules if m.startswith("riskloom.llm") or m == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, missing, None)  # importing it raises ImportError
    with pytest.warns(UserWarning, match="left out"):
        names = E.queries()
    assert set(names) == set(load_all())
    with pytest.warns(UserWarning, match="left out"):
        assert set(E.oracle_sql()) < set(names)


def test_every_oracle_has_its_query():
    assert set(E.oracle_sql()) <= set(E.queries())
