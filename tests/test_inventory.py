"""The SURVEY §2 inventory map stays in sync with the registered queries."""
import importlib.util
import os

from vitrine.plans.catalog import oracle_sql, queries


def _rows():
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                        "tools", "operators_doc.py")
    spec = importlib.util.spec_from_file_location("operators_doc", path)
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod.ROWS


def test_every_inventory_key_is_registered_and_every_key_is_mapped():
    qs = queries()
    mapped = {k for _, _, keys, _ in _rows() for k in keys}
    assert mapped <= set(qs)
    assert set(qs) <= mapped


def test_oracles_only_for_registered_keys():
    assert set(oracle_sql()) <= set(queries())
    assert set(queries()) - set(oracle_sql()) == {"table_file_size"}
