"""The driver entry points with and without the corpus operators."""

import pathlib
import shutil
import subprocess
import sys

import __spark_entry__

ROOT = pathlib.Path(__spark_entry__.__file__).parent
ASK = "import __spark_entry__ as e, bench; print(len(e.queries()), sorted(set(e.oracle_sql()) - set(e.queries())), [q for q in e.queries() if q.startswith('op') and q[2].isdigit() or q == 'pipeline'])"


def test_works_without_the_corpus_operators(tmp_path):
    for folder in ("brindle", "tests"):
        shutil.copytree(ROOT / folder, tmp_path / folder, ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", "bench.py", "corpus_pipeline.py"):
        if (ROOT / name).exists():
            shutil.copy(ROOT / name, tmp_path)
    (tmp_path / "brindle" / "llm" / "__pycache__").mkdir(parents=True)  # what a deletion may leave behind
    done = subprocess.run([sys.executable, "-c", ASK], cwd=tmp_path, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
    count, unknown, left = done.stdout.strip().split(" ", 1)[0], "[]", "[]"
    assert int(count) > 100 and done.stdout.strip().endswith(f"{unknown} {left}")
