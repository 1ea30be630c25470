"""Queries that come first in a session without any Spark setting of ours."""
import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CODE = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
import __spark_entry__ as E
print("ROWS", E.catalog.queries()[{name!r}](spark, "/root/testdata/sf0.001").count())
"""


@pytest.mark.parametrize("name", ["doc_frequency", "build_title_corpus", "number_corpus", "search_all_words"])
def test_query_runs_first(name, tmp_path):
    out = subprocess.run([sys.executable, "-c", CODE.format(root=ROOT, name=name)], cwd=tmp_path, capture_output=True,
                         text=True, timeout=300)
    assert "ROWS" in out.stdout, out.stderr[-2000:]
