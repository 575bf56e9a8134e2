"""Without the optional text operators the rest still imports and answers."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
ASK = "import __spark_entry__ as e; print(len(e.queries()), sum(n.startswith('op') or n == 'pipeline' for n in e.queries()), set(e.oracle_sql()) <= set(e.queries()))"


@pytest.mark.parametrize("pipeline", [True, False])
def test_the_rest_imports_without_them(tmp_path, pipeline):
    left_out = [".git", "__pycache__", "llm"] + ([] if pipeline else ["corpus_pipeline.py"])
    shutil.copytree(ROOT, tmp_path / "copy", ignore=shutil.ignore_patterns(*left_out))
    done = subprocess.run([sys.executable, "-c", ASK], cwd=tmp_path / "copy", env={"PATH": "/usr/bin:/bin"}, capture_output=True, text=True, check=False)
    assert done.returncode == 0, done.stderr
    n, of_text, sound = done.stdout.split()
    assert int(n) > 125 and int(of_text) == 0 and sound == "True"
