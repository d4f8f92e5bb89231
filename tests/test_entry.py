"""The driver contract holds with and without the llm folders."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def names(root):
    code = "import __spark_entry__ as e; print('NAMES', *sorted(e.queries())); print('SQL', *sorted(e.oracle_sql()))"
    env = {**os.environ, "PYTHONPATH": root, "PYTHONDONTWRITEBYTECODE": "1"}
    run = subprocess.run([sys.executable, "-c", code], cwd=root, env=env, capture_output=True, text=True, check=True)
    lines = [x.split() for x in run.stdout.splitlines()]
    return set(lines[0][1:]), set(lines[1][1:])


def copy_without(tmp_path, *left_out):
    target = tmp_path / "repo"
    shutil.copytree(ROOT, target, ignore=shutil.ignore_patterns(".git", "__pycache__", *left_out))
    return str(target)


def test_without_llm_folders_and_pipeline(tmp_path):
    with_all, _ = names(ROOT)
    for place, left_out in (("a", ("llm", "corpus_pipeline.py")), ("b", ("llm",))):  # the pipeline's file without its operators, too
        (tmp_path / place).mkdir()
        found, sql = names(copy_without(tmp_path / place, *left_out))
        assert found == {n for n in with_all if not n.startswith("op") and n != "pipeline"}
        assert sql <= found


def test_nothing_outside_llm_imports_it():
    for folder, _, files in os.walk(os.path.join(ROOT, "tripstats")):
        if os.path.basename(folder) in ("llm", "__pycache__"):
            continue
        for name in files:
            if name.endswith(".py"):
                text = open(os.path.join(folder, name)).read()
                assert "import llm" not in text and "llm." not in text and ".llm" not in text, name
