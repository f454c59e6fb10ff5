"""Working files go where executors reach them, and go with the session."""

import os
import subprocess
import sys
from pathlib import Path

from labelweave.session import shared_folder

SCRIPT = """
import sys
from labelweave.session import build_session, shared_folder
spark = build_session("files", "local[1]", **{"spark.ui.enabled": "false", "spark.checkpoint.dir": sys.argv[1]})
folder = shared_folder(spark, "rows")
spark.range(5).write.parquet(folder)
assert spark.read.parquet(folder).count() == 5 and folder.startswith(sys.argv[1])
spark.stop()
"""


def test_files_are_removed_when_the_session_ends(tmp_path):
    root = str(Path(__file__).resolve().parent.parent)
    env = os.environ | {"PYTHONPATH": root}
    subprocess.run([sys.executable, "-c", SCRIPT, str(tmp_path)], check=True, env=env, timeout=200, cwd=tmp_path)
    assert [p for p in tmp_path.rglob("*") if p.is_file() or p.name.startswith("rows-")] == []


def test_places_are_fresh(spark):
    a, b = shared_folder(spark, "x"), shared_folder(spark, "x")
    assert a != b
    spark.range(1).write.parquet(a)
    assert spark.read.parquet(a).count() == 1
