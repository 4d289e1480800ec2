"""Every registered query against its DuckDB SQL at sf0.01 (the driver's
correctness gate, run locally). The optional subpackage has its own tests."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from oracle_check import compare, duck
from strata.plans.catalog import QUERIES
from strata.plans.oracle import ORACLE

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(queries()) and set(ORACLE) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    ok, ok_cols, ns, nd, *_ = compare(spark, name, QUERIES[name], ORACLE[name], SF, con)
    assert ok_cols and ns == nd and ok


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() > 0 and df.columns == ["category", "lines", "quantity", "revenue"]


def test_entry_without_the_optional_subpackage(tmp_path):
    root = Path(__file__).resolve().parents[1]
    shutil.copytree(root / "strata", tmp_path / "strata", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert out.stdout.split() == [str(len(QUERIES))] * 2, out.stderr[-800:]
