"""The library without the optional subpackage: what is left must import, name its queries and run."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent

PROBE = """
import __spark_entry__ as e, bench, importlib, pkgutil, millrace
names = set(e.queries())
assert names and set(e.oracle_sql()) <= names and not any(n.startswith("op") or n == "pipeline" for n in names), names
for m in pkgutil.walk_packages(millrace.__path__, "millrace."):
    importlib.import_module(m.name)
"""


@pytest.mark.parametrize("also", [(), ("corpus_pipeline.py",)])
def test_without_the_optional_folders(tmp_path, also):
    for name in ("__spark_entry__.py", "bench.py", "corpus_pipeline.py"):
        if (ROOT / name).exists():
            shutil.copy(ROOT / name, tmp_path)
    shutil.copytree(ROOT / "millrace", tmp_path / "millrace", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in also:
        (tmp_path / name).unlink(missing_ok=True)
    subprocess.run([sys.executable, "-c", PROBE], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)}, timeout=120)


def test_nothing_else_imports_it():
    for path in (ROOT / "millrace").rglob("*.py"):
        if "llm" not in path.relative_to(ROOT).parts:
            assert "millrace.llm" not in path.read_text() and "from .llm" not in path.read_text(), path
