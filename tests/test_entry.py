"""The entry imports and lists the analytics queries without the optional training-data package."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
PROBE = "import __spark_entry__ as e; q = e.queries(); print(len(q), 'w7_label_transactions' in q, any(n.startswith('op') or n == 'pipeline' for n in q))"


def probe(root):
    found = subprocess.run([sys.executable, "-c", PROBE], cwd=root, capture_output=True, text=True, check=True)
    n, flagship, optional = found.stdout.split()
    return int(n), flagship == "True", optional == "True"


@pytest.mark.parametrize("gone", [["riskspark/llm"], ["riskspark/llm", "corpus_pipeline.py"], ["corpus_pipeline.py"]])
def test_entry_without_the_optional_package(tmp_path, gone):
    out = set(gone)
    shutil.copytree(ROOT / "riskspark", tmp_path / "riskspark", ignore=lambda d, names: [n for n in names if n == "__pycache__" or f"riskspark/{n}" in out])
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if name not in out and (ROOT / name).exists():
            shutil.copy(ROOT / name, tmp_path / name)
    n, flagship, optional = probe(tmp_path)
    assert n > 100 and flagship and not optional
