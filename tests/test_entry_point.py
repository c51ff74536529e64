"""The entry point without the training-data operators."""

import json
import shutil
import subprocess
import sys
from pathlib import Path

from tidelake.plans.registered import QUERIES

REPO = Path(__file__).resolve().parents[1]
COUNT = "import json, __spark_entry__ as e; print(json.dumps([sorted(e.queries()), sorted(e.oracle_sql())]))"


def listed(folder):
    out = subprocess.run([sys.executable, "-c", COUNT], cwd=folder, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    return json.loads(out.stdout)


def test_imports_without_them(tmp_path):
    """Also where the pipeline's file, or caches of the package, are left."""
    without = shutil.ignore_patterns("llm", ".git", "__pycache__")
    shutil.copytree(REPO / "tidelake", tmp_path / "all/tidelake", ignore=without)
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if (REPO / name).exists():
            shutil.copy(REPO / name, tmp_path / "all")
    names, sql = listed(tmp_path / "all")
    assert names == sorted(QUERIES) and set(sql) <= set(names)
    (tmp_path / "all/tidelake/llm/__pycache__").mkdir(parents=True)
    assert listed(tmp_path / "all")[0] == names
