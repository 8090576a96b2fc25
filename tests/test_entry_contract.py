import os
import shutil
import subprocess
import sys
from pathlib import Path

import __spark_entry__ as E

ROOT = Path(__file__).resolve().parents[1]


def test_registry_contract():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 30
    for name in ("smote", "per_class_rates", "csv_strict", "parse_messages", "undersample"):
        assert name in o
    for name, sql in o.items():
        assert "LIMIT" not in sql.upper() or name == "preview_25", name


def test_entry_without_the_optional_operators(tmp_path):
    """A copy without the training-data folder imports and runs, with and without the pipeline file."""
    for keep_pipeline in (True, False):
        copy = tmp_path / f"copy-{keep_pipeline}"
        copy.mkdir()
        shutil.copy(ROOT / "__spark_entry__.py", copy)
        if keep_pipeline and (ROOT / "corpus_pipeline.py").exists():
            shutil.copy(ROOT / "corpus_pipeline.py", copy)
        shutil.copytree(ROOT / "flowml", copy / "flowml", ignore=shutil.ignore_patterns("llm", "__pycache__"))
        code = ("import __spark_entry__ as E\n"
                "from flowml.session import get_session\n"
                "assert not [n for n in E.queries() if n.startswith('op') or n == 'pipeline']\n"
                "s = get_session('local[1]', shuffle_partitions=2)\n"
                "print('rows', E.queries()['row_count'](s, '/root/testdata/sf0.001').first().n)\n")
        done = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, timeout=300,
                              env={**os.environ, "PYTHONPATH": str(copy)})
        assert done.returncode == 0 and "rows " in done.stdout, done.stderr[-2000:]
