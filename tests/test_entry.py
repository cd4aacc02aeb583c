"""The driver's contract, with and without the corpus operators."""

import os
import shutil
import subprocess
import sys

import __spark_entry__ as entry

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_every_sql_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries()) and len(entry.oracle_sql()) >= 70


def test_entry_runs(spark):
    out = entry.entry(spark)
    assert out.columns == ["s1_id", "cand_id", "country", "source", "s1_ord", "cand_ord", "score", "rank"] and out.count() > 0


def test_library_works_without_the_corpus_operators(tmp_path):
    shutil.copytree(os.path.join(ROOT, "kinmatch"), tmp_path / "kinmatch", ignore=shutil.ignore_patterns("llm"))
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), tmp_path)
    os.makedirs(tmp_path / "kinmatch/llm/__pycache__")  # a folder that was left behind is no package
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not [n for n in q if n.startswith('op') or n == 'pipeline']; print(len(q), len(e.oracle_sql()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"}, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    assert int(done.stdout.split()[0]) >= 70
