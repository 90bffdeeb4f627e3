import shutil
import subprocess
import sys
from pathlib import Path

import __spark_entry__

ROOT = Path(__spark_entry__.__file__).parent


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0


def test_every_corpus_query_has_sql():
    from bilinea.plans import oracles, queries

    assert set(queries.queries()) == set(oracles.oracle_sql())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_entry_without_the_optional_parts(tmp_path):
    for name in ("bilinea", "__spark_entry__.py", "bench.py"):
        copy = shutil.copytree if (ROOT / name).is_dir() else shutil.copy
        copy(ROOT / name, tmp_path / name)
    shutil.rmtree(tmp_path / "bilinea/llm", ignore_errors=True)
    code = "import __spark_entry__ as e; assert 'a1_trailing_char_profile' in e.queries() and 'pipeline' not in e.queries() and set(e.oracle_sql()) == set(e.queries())"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True)
