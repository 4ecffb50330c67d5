"""Executors that do not have the package: the operators' functions travel with their tasks."""

import os
import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parents[2]
SCRIPT = f"""
import sys
sys.path.insert(0, {str(REPO)!r})
from daybook.session import build_session
spark = build_session("elsewhere", **{{"spark.master": "local[4]", "spark.ui.enabled": "false",
    "spark.sql.shuffle.partitions": "4", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g"}})
spark.sparkContext.setLogLevel("ERROR")
from daybook.llm.queries import QUERIES
for name, query in QUERIES.items():
    print(name, query(spark, "/root/testdata/sf0.001").count(), flush=True)
"""


def test_every_query_from_another_folder(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    assert done.returncode == 0, done.stderr[-3000:]
    names = [line.split()[0] for line in done.stdout.splitlines() if line.startswith("op")]
    assert len(names) == 13 and all(int(line.split()[1]) > 0 for line in done.stdout.splitlines() if line.startswith("op"))
