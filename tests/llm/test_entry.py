"""The entry without the llm folders, and with a broken one."""

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[2]
LIST = "import __spark_entry__ as e; q = e.queries(); print(len(q), 'pipeline' in q, len(e.oracle_sql()))"


def listed(folder):
    return subprocess.run([sys.executable, "-B", "-c", LIST], cwd=folder, capture_output=True, text=True)


def test_entry_with_and_without(tmp_path):
    ignore = shutil.ignore_patterns(".git", "__pycache__", ".pytest_cache")
    for name in ("whole", "bare", "broken"):
        shutil.copytree(ROOT, tmp_path / name, ignore=ignore)
    whole = listed(tmp_path / "whole").stdout.split()
    assert whole[1] == "True"
    for p in ("helixtable/llm", "tests/llm"):
        shutil.rmtree(tmp_path / "bare" / p)
    (tmp_path / "bare/corpus_pipeline.py").unlink()
    bare = listed(tmp_path / "bare").stdout.split()
    assert bare[1] == "False" and int(bare[0]) == int(whole[0]) - 14 and int(bare[2]) > 0
    (tmp_path / "broken/helixtable/llm/substring.py").write_text("import a_module_that_is_not_there\n")
    assert "a_module_that_is_not_there" in listed(tmp_path / "broken").stderr


def test_nothing_else_imports_the_subpackage():
    for p in (ROOT / "helixtable").rglob("*.py"):
        assert "llm" not in p.parts and "helixtable.llm" not in p.read_text() or "llm" in p.parts, p
