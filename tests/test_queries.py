"""Every registered query against its SQL, on the smallest test tables."""

import os
import shutil
import subprocess
import sys

import pytest

import __spark_entry__ as entry
from check import compare

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, name):
    result, _ = compare(spark, SF_DIR, name)
    assert result.startswith(("same", "rows only"))
    assert not result.endswith(" 0")


def test_names_are_unique_and_known():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_has_the_published_schema(spark):
    assert entry.entry(spark).columns == [
        "deviceId", "period", "avg_speed_over_limit", "overspeed_events", "max_speed_over_limit"
    ]


def test_the_entry_imports_without_the_training_data_operators(tmp_path):
    root = os.path.dirname(os.path.abspath(entry.__file__))
    shutil.copytree(os.path.join(root, "kerbside"), tmp_path / "kerbside", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        shutil.copy(os.path.join(root, name), tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 90 and not any(n.startswith('op') or n == 'pipeline' for n in q)"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
