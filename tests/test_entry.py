"""The entry module also works where the operators on text have been left out."""

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def names(root, *more):
    code = "import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))"
    return subprocess.run([sys.executable, "-c", code, *more], cwd=root, capture_output=True, text=True)


def copied(tmp_path):
    for name in ("assaylake", "verification"):
        shutil.copytree(ROOT / name, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    return tmp_path


def test_without_the_text_operators(tmp_path):
    found = names(copied(tmp_path))
    assert found.returncode == 0, found.stderr
    queries, sqls = found.stdout.splitlines()
    assert queries == sqls and "mart_posts_user_year" in queries and "op1_" not in queries


def test_other_import_errors_are_not_swallowed(tmp_path):
    (copied(tmp_path) / "corpus_pipeline.py").write_text("import no_such_module\n")
    assert "no_such_module" in names(tmp_path).stderr


def test_missing_modules_of_the_text_operators_leave_these_out(tmp_path):
    (copied(tmp_path) / "corpus_pipeline.py").write_text("raise ModuleNotFoundError('no', name='tiktoken')\n")
    found = names(tmp_path)
    assert found.returncode == 0 and "tiktoken is not installed" in found.stderr
    assert "op1_" not in found.stdout and "mart_posts_user_year" in found.stdout
