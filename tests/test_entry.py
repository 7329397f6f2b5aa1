"""The entry file works without the training-data operators."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
LIST = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), sorted(e.queries())[:1])"


def listed(folder):
    env = {**os.environ, "PYTHONPATH": str(folder), "PYTHONDONTWRITEBYTECODE": "1"}
    done = subprocess.run([sys.executable, "-c", LIST], cwd=folder, env=env, capture_output=True, text=True, check=False)
    assert done.returncode == 0, done.stderr
    return done.stdout


def test_entry_without_the_training_folders(tmp_path):
    from waymark.queries import ORACLE_SQL, QUERIES

    want = f"{len(QUERIES)} {len(ORACLE_SQL)} {sorted(QUERIES)[:1]}\n"
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=lambda d, names: [n for n in names if n in (".git", "llm", "__pycache__")])
    # The pipeline's file is left, which alone must not be imported.
    assert listed(copy) == want
    (copy / "waymark" / "llm").mkdir()
    assert listed(copy) == want
