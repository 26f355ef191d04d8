"""The entry points from outside: another folder, and without the operators for training data."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

REPO = Path(__file__).resolve().parent.parent
SF_DIR = "/root/testdata/sf0.001"

RUN = """
import sys
sys.path.insert(0, sys.argv[1])
import __spark_entry__ as entry
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "2")
    .config("spark.ui.enabled", "false").config("spark.sql.warehouse.dir", sys.argv[2] + "/w").getOrCreate())
for name in ("q_scan_files", "q_top_k_probed"):
    assert entry.queries()[name](spark, sys.argv[3]).count() > 0
"""

NAMES = """
import sys
sys.path.insert(0, sys.argv[1])
import __spark_entry__ as entry
names = set(entry.queries())
assert set(entry.oracle_sql()) <= names
print(*sorted(names))
"""


def run(code, cwd, *args):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-B", "-c", code, *args], cwd=cwd, env=env, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr[-3000:]
    return done.stdout.split()


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")
def test_tasks_need_no_installed_package(tmp_path):
    run(RUN, tmp_path, str(REPO), str(tmp_path), SF_DIR)


def test_without_the_operators_for_training_data(tmp_path):
    for name in ("docpipe", "workload", "__spark_entry__.py", "corpus_pipeline.py"):
        source = REPO / name
        if source.is_dir():
            shutil.copytree(source, tmp_path / name, ignore=shutil.ignore_patterns("__pycache__", "llm"))
        elif source.exists() and name != "corpus_pipeline.py":
            shutil.copy(source, tmp_path / name)
    names = run(NAMES, tmp_path, str(tmp_path))
    assert "q_top_k" in names and all(n.startswith("q_") for n in names)
