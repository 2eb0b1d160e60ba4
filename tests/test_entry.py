"""The entry with and without the optional subpackage."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
COUNT = "import __spark_entry__ as e; print(sorted(set(e.queries()) ^ set(e.oracle_sql())), *sorted(e.queries()), sep='\\n')"


def names(folder):
    done = subprocess.run([sys.executable, "-c", COUNT], cwd=folder, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    return set(done.stdout.split("\n")[1:]) - {""}


@pytest.mark.parametrize("pipeline_stays, leftovers", [(False, False), (True, False), (True, True)])
def test_entry_imports_without_the_subpackage(tmp_path, pipeline_stays, leftovers):
    from prosemill.plans.catalog import QUERIES

    for name in ("prosemill", "__spark_entry__.py", "corpus_pipeline.py"):
        source, target = os.path.join(ROOT, name), tmp_path / name
        if os.path.isdir(source):
            shutil.copytree(source, target, ignore=shutil.ignore_patterns("llm", "__pycache__"))
        elif os.path.exists(source) and (pipeline_stays or name != "corpus_pipeline.py"):
            shutil.copy(source, target)
    if leftovers:
        (tmp_path / "prosemill" / "llm" / "__pycache__").mkdir(parents=True)
    assert names(tmp_path) == set(QUERIES)


def test_errors_inside_the_subpackage_are_raised(tmp_path):
    shutil.copytree(os.path.join(ROOT, "prosemill"), tmp_path / "prosemill", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), tmp_path)
    (tmp_path / "prosemill" / "llm").mkdir()
    (tmp_path / "prosemill" / "llm" / "queries.py").write_text("import no_such_module_at_all\n")
    done = subprocess.run([sys.executable, "-c", COUNT], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert done.returncode and "no_such_module_at_all" in done.stderr
