"""The entry module with and without the folders that may be removed."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SHOWN = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert set(o) <= set(q); print(len(q), 'pipeline' in q, any(n.startswith('op') for n in q))"


def shown(folder):
    return subprocess.run([sys.executable, "-c", SHOWN], cwd=folder, env={**os.environ, "PYTHONPATH": str(folder)}, capture_output=True, text=True, check=True).stdout.split()


def copy_of(tmp_path, *without):
    for name in ("weftline", "__spark_entry__.py", "corpus_pipeline.py"):
        source = os.path.join(ROOT, name)
        if os.path.isdir(source):
            shutil.copytree(source, tmp_path / name, ignore=shutil.ignore_patterns("__pycache__", *without))
        elif os.path.exists(source) and name not in without:
            shutil.copy(source, tmp_path)
    return tmp_path


def test_queries_of_what_is_there():
    from weftline.plans import registry

    whole = os.path.isdir(os.path.join(ROOT, "weftline", "llm"))
    assert shown(ROOT)[1:] == [str(whole and os.path.exists(os.path.join(ROOT, "corpus_pipeline.py"))), str(whole)]
    assert int(shown(ROOT)[0]) >= len(registry.queries())


def test_without_the_folders(tmp_path):
    from weftline.plans import registry

    assert shown(copy_of(tmp_path, "llm")) == [str(len(registry.queries())), "False", "False"]


def test_without_folders_and_pipeline(tmp_path):
    assert shown(copy_of(tmp_path, "llm", "corpus_pipeline.py"))[1:] == ["False", "False"]
