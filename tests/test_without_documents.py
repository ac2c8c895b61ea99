"""The package, its queries and their SQL work where the document operators are absent."""

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def test_entry_without_the_subpackage(tmp_path):
    skip = shutil.ignore_patterns("llm", "__pycache__")
    for name in ("clientela", "registry"):
        shutil.copytree(ROOT / name, tmp_path / name, ignore=skip)
    for name in ("__spark_entry__.py", "bench.py"):
        shutil.copy(ROOT / name, tmp_path / name)
    code = "import __spark_entry__ as e, bench; print(len(e.queries()), [n for n in e.queries() if n.startswith(('op', 'pipeline'))])"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr
    count, listed = done.stdout.split(" ", 1)
    assert int(count) > 100 and listed.strip() == "[]"


def test_nothing_else_imports_the_subpackage():
    outside = [p for p in ROOT.glob("**/*.py") if "llm" not in p.parts and p.name not in ("corpus_pipeline.py", "__spark_entry__.py", Path(__file__).name)]
    assert [p for p in outside if "clientela.llm" in p.read_text()] == []
