"""Task functions reach workers that can't import the package."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CODE = f"""
import sys
sys.path.insert(0, {REPO!r})  # on the driver only
from framewright.session import build_session
import __spark_entry__ as entry
spark = build_session(cores=2, shuffle_partitions=2)
print("rows", entry.queries()["knn_join"](spark, "/root/testdata/sf0.001").count())
"""


def test_knn_join_from_another_folder(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", CODE], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "rows" in done.stdout, done.stderr[-2000:]
