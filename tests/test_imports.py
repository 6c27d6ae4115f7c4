"""Every module imports cleanly (the counterpart of a DAG import-error test)."""

import importlib
import pkgutil

import civicledger


def test_all_modules_import():
    names = [m.name for m in pkgutil.walk_packages(civicledger.__path__, "civicledger.")]
    assert len(names) >= 15
    for name in names:
        importlib.import_module(name)


def test_entry_contract_shape():
    import __spark_entry__ as E
    assert callable(E.entry) and callable(E.queries) and callable(E.oracle_sql)
    own = E._queries.registered()
    assert len(own) >= 39 and set(own) <= set(E.oracle_sql())
