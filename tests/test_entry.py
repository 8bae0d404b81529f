"""The entry point with and without the optional folders."""

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
SAY = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), any(k.startswith('op') and k[2].isdigit() for k in e.queries()))"


def said(folder):
    out = subprocess.run([sys.executable, "-c", SAY], cwd=folder, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    return out.stdout.split()


def test_imports_without_the_text_operators(tmp_path):
    for name in ("pulsegrid", "__spark_entry__.py"):
        source = ROOT / name
        if source.is_dir():
            shutil.copytree(source, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
        else:
            shutil.copy(source, tmp_path / name)
    n, sql, some = said(tmp_path)
    assert int(n) >= int(sql) > 80 and some == "False"


def test_nothing_else_imports_the_text_operators():
    for file in (ROOT / "pulsegrid").rglob("*.py"):
        if "llm" not in file.relative_to(ROOT).parts:
            assert "llm" not in file.read_text(), file
