"""The entry file in places where parts of the repository are missing."""

import os
import shutil
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF_DIR = "/root/testdata/sf0.001"

LIST = """
import __spark_entry__ as contract
print(*sorted(contract.queries()))
print(*sorted(contract.oracle_sql()))
"""
RUN = """
import sys
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4")
    .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate())
sys.path.insert(0, sys.argv[1])
import __spark_entry__ as contract
queries = contract.queries()
for name in sys.argv[3:]:
    if name in queries:
        print(name, queries[name](spark, sys.argv[2]).count() > 0)
spark.stop()
"""
#: One or more queries of each module that runs Python in tasks.
WITH_PYTHON = (
    "itemcf_top10",
    "content_similar",
    "dense_similar",
    "stream_recent_queue",
    "op1_substring_dedup",
    "op2_lm_scoring",
    "op4_minhash",
    "op6_decontamination",
    "op7_html_extraction",
    "op8_pii",
    "op9_toxicity",
    "op10_bpe",
    "op11_source_divergence",
    "op12_embedding_near_dedup",
    "op13_periodic_runs",
)


def python(code, folder, *args):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", code, *args], cwd=folder, env=env, capture_output=True, text=True, timeout=900
    )
    assert not done.returncode, done.stderr[-3000:]
    return done.stdout.splitlines()


def test_without_the_optional_folders(tmp_path):
    copy = tmp_path / "copy"
    shutil.copytree(REPO, copy, ignore=shutil.ignore_patterns("llm", ".git", "__pycache__", ".pytest_cache"))
    for missing_pipeline in (False, True):
        if missing_pipeline:
            (copy / "corpus_pipeline.py").unlink(missing_ok=True)
        queries, oracles = (line.split() for line in python(LIST, copy))
        assert len(queries) >= 60 and "rate_more_products" in queries
        assert "pipeline" not in queries and not any(q.startswith("op") for q in queries)
        assert set(oracles) <= set(queries)


def test_from_a_foreign_folder(tmp_path):
    """The repository is on the driver's path only."""
    lines = python(RUN, tmp_path, REPO, SF_DIR, *WITH_PYTHON)
    assert lines and all(line.endswith("True") for line in lines)
