"""The driver contract with and without the optional training-data operators."""

import sys

import __spark_entry__ as E
from docmart.plans import ORACLE_SQL, QUERIES


class _Hidden:
    """An import finder under which the optional modules do not exist."""

    def find_spec(self, name, path=None, target=None):
        if name == "corpus_pipeline" or name == "docmart.llm" or name.startswith("docmart.llm."):
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)
        return None


def test_registry_stands_without_the_optional_modules(monkeypatch):
    for name in [n for n in sys.modules if n == "corpus_pipeline" or n == "docmart.llm" or n.startswith("docmart.llm.")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setattr(sys, "meta_path", [_Hidden(), *sys.meta_path])
    assert set(E.queries()) == set(QUERIES)
    assert set(E.oracle_sql()) == set(ORACLE_SQL)
