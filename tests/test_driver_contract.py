"""The driver loads __spark_entry__.py by path, from its own directory and
with its own session: the Python steps must still run on the workers."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import importlib.util
spec = importlib.util.spec_from_file_location("entry_mod", "{ROOT}/__spark_entry__.py")
E = importlib.util.module_from_spec(spec); spec.loader.exec_module(E)
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false").getOrCreate())
print("ENTRY", len(E.entry(spark).collect()))
print("TRANSLATE", E.queries()["translate_docs"](spark, "/root/testdata/sf0.001").count())
print("SENTIMENT", E.queries()["sentiment"](spark, "/root/testdata/sf0.001").count())
"""


def test_entry_and_python_steps_from_another_directory(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    r = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tmp_path, env=env, capture_output=True, text=True,
                       timeout=600)
    out = r.stdout
    assert r.returncode == 0, r.stderr[-2000:]
    assert "ENTRY " in out and "TRANSLATE 400" in out and "SENTIMENT 50" in out, out
