import os
import shutil
import subprocess
import sys
from pathlib import Path

CODE = """
import glob
glob.glob = lambda *a, **k: []
import __spark_entry__ as e
from pyspark.sql import SparkSession
assert set(e.oracle_sql()) <= set(e.queries())
assert SparkSession.getActiveSession() is None
print(len(e.queries()), len(e.oracle_sql()))
"""


def test_registration_needs_no_session_and_no_jars():
    env = os.environ | {"JAVA_HOME": "/nonexistent", "SPARK_HOME": "/nonexistent"}
    done = subprocess.run([sys.executable, "-c", CODE], env=env, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
    assert int(done.stdout.split()[0]) >= 78


def test_library_stands_without_the_optional_subpackage(tmp_path):
    """A copy without the folders of the optional operators imports, with the pipeline file still there or not."""
    root = Path(__file__).parent.parent
    for kept_pipeline in (True, False):
        copy = tmp_path / f"copy-{kept_pipeline}"
        copy.mkdir()
        shutil.copytree(root / "trainlake", copy / "trainlake", ignore=shutil.ignore_patterns("llm", "__pycache__"))
        shutil.copy(root / "__spark_entry__.py", copy)
        if kept_pipeline and (root / "corpus_pipeline.py").exists():
            shutil.copy(root / "corpus_pipeline.py", copy)
        done = subprocess.run([sys.executable, "-c", CODE], cwd=copy, capture_output=True, text=True)
        assert done.returncode == 0, done.stderr
        assert int(done.stdout.split()[0]) >= 78
