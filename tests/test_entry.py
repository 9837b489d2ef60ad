import importlib.util
import os

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _entry():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_entry_runs_on_smoke_tables(spark):
    df = _entry().entry(spark)
    rows = df.collect()
    assert rows and df.columns == ["c_mktsegment", "price_bin", "rate", "n"]


def test_oracles_are_subset_of_queries():
    mod = _entry()
    q, o = mod.queries(), mod.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 100
