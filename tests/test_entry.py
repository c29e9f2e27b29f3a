"""The entry point with and without the optional subpackage."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
COUNT = "import __spark_entry__ as e; q = e.queries(); print(len(q), sum(n.startswith('op') or n == 'pipeline' for n in q), len(set(e.oracle_sql()) - set(q)))"


@pytest.mark.parametrize("left_out", [["reviewloom/llm", "tests/llm"], ["reviewloom/llm", "tests/llm", "corpus_pipeline.py"], ["corpus_pipeline.py"]])
def test_entry_without_optional_parts(tmp_path, left_out):
    here = tmp_path / "copy"
    names = {Path(n).name for n in left_out if n != "tests/llm"}
    shutil.copytree(ROOT, here, ignore=shutil.ignore_patterns(".git", "__pycache__", "tests", *names))
    out = subprocess.run([sys.executable, "-c", COUNT], cwd=here, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    total, optional, orphans = map(int, out.stdout.split())
    from reviewloom import catalog

    catalog.load_all()
    assert total - optional == len(catalog.QUERIES) and orphans == 0
    assert (optional == 0) == ("reviewloom/llm" in left_out)


def test_a_broken_subpackage_is_not_forgiven(tmp_path):
    here = tmp_path / "copy"
    shutil.copytree(ROOT, here, ignore=shutil.ignore_patterns(".git", "__pycache__", "tests", "llm"))
    (here / "corpus_pipeline.py").write_text("import a_module_that_nobody_has\n")
    out = subprocess.run([sys.executable, "-c", COUNT], cwd=here, capture_output=True, text=True, timeout=120)
    assert out.returncode and "a_module_that_nobody_has" in out.stderr
