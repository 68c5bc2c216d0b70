"""The registered queries without the text operators, or without what those import."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
COUNT = "import __spark_entry__ as e; print(sorted(e.queries())); assert set(e.oracle_sql()) <= set(e.queries())"


def names(folder):
    found = subprocess.run([sys.executable, "-c", COUNT], cwd=folder, capture_output=True, text=True, check=True)
    return eval(found.stdout)


@pytest.mark.parametrize("how", ["no folder", "empty folder", "missing library", "no pipeline"])
def test_entry_without(tmp_path, how):
    copy = str(tmp_path / "repo")
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", "tests", "spark-warehouse"))
    from toolgauge.plans.queries import QUERIES

    own, text = sorted(QUERIES), os.path.join(copy, "toolgauge", "llm")
    if not os.path.exists(text):  # as the driver leaves it
        assert names(copy) == own
        return
    if how == "missing library":
        with open(os.path.join(text, "warc.py"), "a") as file:
            file.write("\nimport a_library_that_is_not_there\n")
    elif how == "no pipeline":
        os.remove(os.path.join(copy, "corpus_pipeline.py"))
        own = names(ROOT)
        own.remove("pipeline")
    else:
        shutil.rmtree(text)
        if how == "empty folder":
            os.mkdir(text)
    assert names(copy) == own
