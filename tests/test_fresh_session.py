"""Regression: a deep query as the very first action of a brand-new, plain session
(the driver's situation) must plan and run; re-analysing WITH chains over windowed
inputs used to fail there inside Spark's DeduplicateRelations rule."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "4")
         .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate())
import __spark_entry__ as se
print("ROWS", len(se.queries()[{name!r}](spark, "/root/testdata/sf0.001").collect()))
"""


def _first_query_rows(name):
    out = subprocess.run([sys.executable, "-c", SCRIPT.format(root=ROOT, name=name)],
                         capture_output=True, text=True, timeout=600)
    rows = [ln for ln in out.stdout.splitlines() if ln.startswith("ROWS")]
    assert rows, out.stderr[-2000:]
    return int(rows[0].split()[1])


def test_accepted_rules_first():
    assert _first_query_rows("accepted_rules") == 425


def test_rule_changes_first():
    assert _first_query_rows("rule_changes") == 465
