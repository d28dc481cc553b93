from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__
from sheetloom.plans import registry

ROOT = Path(__file__).resolve().parents[1]


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_core_query_runs(spark, sf_dir, name):
    df = __spark_entry__.queries()[name](spark, sf_dir)
    assert df.columns and len(set(df.columns)) == len(df.columns)
    df.write.format("noop").mode("overwrite").save()


def test_sql_belongs_to_queries():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_rest_imports_without_the_text_subpackage():
    code = "import sys; sys.modules['sheetloom.llm'] = None; import __spark_entry__ as e; assert 'p1_found' in e.queries() and not [q for q in e.queries() if q.startswith('p9')]"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)
