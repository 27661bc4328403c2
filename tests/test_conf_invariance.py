"""Results do not depend on the session: a different shuffle width, ANSI
mode off and AQE off give the same oracle matches (own process, own session)."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import sys
sys.path.insert(0, "{ROOT}")
import __spark_entry__ as E
from pyspark.sql import SparkSession
from docflow.plans.oracle import compare, duck
spark = (SparkSession.builder.master("local[3]").config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false").config("spark.sql.shuffle.partitions", "3")
         .config("spark.sql.ansi.enabled", "false").config("spark.sql.adaptive.enabled", "false").getOrCreate())
sf = "/root/testdata/sf0.01"
con = duck(sf)
names = ["page_status", "link_flags", "site_quota", "ready_set", "translate_docs", "latest_version",
         "two_ended", "turn_overlap", "stream_hourly"]
bad = []
for n in names:
    ok, msg = compare(spark, n, E.queries()[n], E.oracle_sql()[n], sf, con)
    spark.conf.set("spark.sql.adaptive.enabled", "false")      # configure() turns AQE back on
    if not ok:
        bad.append(msg)
print("MISMATCHES", bad)
"""


def test_results_do_not_depend_on_session_settings(tmp_path):
    r = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tmp_path, capture_output=True, text=True, timeout=900)
    assert r.returncode == 0, r.stderr[-2000:]
    assert "MISMATCHES []" in r.stdout, r.stdout[-2000:]
