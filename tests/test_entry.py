"""The driver's entry points with and without the corpus operators."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
COUNT = "import __spark_entry__ as e; q = e.queries(); print(len(q), set(e.oracle_sql()) <= set(q), any(n.startswith('op') and n[2].isdigit() for n in q))"


def copied(folder):
    for name in ("firstseen", "__spark_entry__.py", "corpus_pipeline.py"):
        if (ROOT / name).is_dir():
            shutil.copytree(ROOT / name, folder / name)
        elif (ROOT / name).exists():
            shutil.copy(ROOT / name, folder / name)


def counted(folder, before=""):
    done = subprocess.run([sys.executable, "-c", before + COUNT], cwd=folder, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    number, sql, corpus = done.stdout.split()
    return int(number), sql == "True", corpus == "True"


@pytest.mark.parametrize("left", ["nothing", "an empty folder", "compiled files"])
def test_the_rest_works_without_the_corpus_part(tmp_path, left):
    from firstseen.plans.queries import QUERIES

    copied(tmp_path)
    part = tmp_path / "firstseen" / "llm"
    if left == "nothing":
        shutil.rmtree(part, ignore_errors=True)
        (tmp_path / "corpus_pipeline.py").unlink(missing_ok=True)
    else:
        part.mkdir(exist_ok=True)
        for file in part.glob("*.py"):
            file.unlink()
        if left == "an empty folder":
            shutil.rmtree(part / "__pycache__", ignore_errors=True)
    assert counted(tmp_path) == (len(QUERIES), True, False)


def test_the_rest_works_without_its_libraries(tmp_path):
    from firstseen.plans.queries import QUERIES

    copied(tmp_path)
    assert counted(tmp_path, "import sys; sys.modules['xxhash'] = None; ")[0] >= len(QUERIES)
