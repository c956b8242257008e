import pathlib
import shutil
import subprocess
import sys

import pytest

ROOT = pathlib.Path(__file__).resolve().parents[1]
LOOK = """
import sys; sys.path.insert(0, '.')
import __spark_entry__ as entry
names = set(entry.queries())
assert set(entry.oracle_sql()) <= names
print(len(names), sum(n.startswith('op') and n[2].isdigit() or n == 'pipeline' for n in names))
"""


@pytest.mark.parametrize("gone", [["portfolio_ops/llm"], ["portfolio_ops/llm", "tests/llm"],
                                  ["portfolio_ops/llm", "tests/llm", "corpus_pipeline.py"]])
def test_queries_without_the_optional_part(tmp_path, gone):
    skipped = shutil.ignore_patterns(".git", "__pycache__", *(pathlib.Path(g).name for g in gone))
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=skipped)
    out = subprocess.run([sys.executable, "-c", LOOK], cwd=copy, capture_output=True, text=True, check=True)
    total, corpus = map(int, out.stdout.split())
    assert total > 50 and corpus == 0


def test_another_fault_is_raised(tmp_path):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", "llm"))
    (copy / "corpus_pipeline.py").write_text("import no_such_module_at_all\n")
    out = subprocess.run([sys.executable, "-c", LOOK], cwd=copy, capture_output=True, text=True)
    assert "no_such_module_at_all" in out.stderr
