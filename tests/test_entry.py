"""The driver's entry file works with and without the training-data operators."""

import shutil
import subprocess
import sys

import pytest

from conftest import ROOT

ASK = "import __spark_entry__ as e; q = e.queries(); print(len(q), len(e.oracle_sql()), any(k.startswith('op') for k in q), 'pipeline' in q)"


def ask(root, before=""):
    done = subprocess.run([sys.executable, "-c", before + ASK], cwd=root, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(root)}, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    return done.stdout.split()[-4:]


@pytest.mark.parametrize("gone", [["cohortloom/llm", "tests/llm"], ["cohortloom/llm", "tests/llm", "corpus_pipeline.py"]])
def test_queries_without_the_llm_folders(tmp_path, gone):
    root = tmp_path / "copy"
    shutil.copytree(ROOT, root, ignore=shutil.ignore_patterns(".git", "__pycache__", ".pytest_cache"))
    for name in gone:
        if (root / name).is_dir():
            shutil.rmtree(root / name)
        else:
            (root / name).unlink(missing_ok=True)
    n, n_sql, has_op, has_pipeline = ask(root)
    assert int(n) > 190 and int(n_sql) > 180 and has_op == has_pipeline == "False"
    # folders that are left empty count as deleted
    (root / "cohortloom/llm/__pycache__").mkdir(parents=True, exist_ok=True)
    assert ask(root) == [n, n_sql, has_op, has_pipeline]


def test_queries_where_the_operators_cannot_be_imported():
    """A library that only they need is missing: their queries are left out with a warning, the others stay."""
    if not (ROOT / "cohortloom/llm/queries.py").exists():
        pytest.skip("the training-data operators are not here")
    n, n_sql, has_op, has_pipeline = ask(ROOT, "import sys; sys.modules['pyarrow'] = None; ")
    assert int(n) > 190 and int(n_sql) > 180 and has_op == has_pipeline == "False"
