"""The driver's contract, and that the core stands without the training-data subpackage."""

from __future__ import annotations

import importlib
import os
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
DATA = "/root/testdata/sf0.001"


def test_core_imports_no_llm():
    for path in (ROOT / "roundmill").rglob("*.py"):
        if "llm" not in path.relative_to(ROOT / "roundmill").parts:
            assert "roundmill.llm" not in path.read_text(), path


def test_names():
    entry = importlib.import_module("__spark_entry__")
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert {"p4_found", "investor_agg", "export_rounds"} <= set(entry.queries())


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data here")
def test_entry_runs(spark):
    entry = importlib.import_module("__spark_entry__")
    assert entry.entry(spark).count() > 0


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data here")
def test_sql_agrees(spark):
    import duckdb

    from roundmill.plans import registry

    con = duckdb.connect()
    for path in Path(DATA).glob("*.parquet"):
        con.execute(f"create view {path.stem} as select * from '{path}'")
    plain = lambda v: "" if v is None else f"{v:.3f}" if isinstance(v, float) else str(v)
    for name, sql in registry.oracle_sql().items():
        df = registry.queries()[name](spark, DATA)
        answer = con.execute(sql)
        names = [c[0] for c in answer.description]
        assert sorted(df.columns) == sorted(names), name
        ours = sorted(tuple(plain(r[c]) for c in sorted(names)) for r in df.collect())
        theirs = sorted(tuple(plain(r[names.index(c)]) for c in sorted(names)) for r in answer.fetchall())
        assert ours == theirs, name


def test_version():
    assert sys.version_info >= (3, 10) and subprocess.run([sys.executable, "-c", "import roundmill"], cwd=ROOT, check=False).returncode == 0
