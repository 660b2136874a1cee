"""The driver's contract, with and without the optional subpackage."""

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).parents[1]
SAY = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert set(o) <= set(q); print(len(q), 'op4_near_dedup' in q)"


def run(at: Path) -> list[str]:
    return subprocess.run([sys.executable, "-c", SAY], cwd=at, capture_output=True, text=True, check=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(at), "PYTHONDONTWRITEBYTECODE": "1"}).stdout.split()


def test_core_works_without_the_optional_parts(tmp_path):
    shutil.copytree(ROOT / "costloom", tmp_path / "costloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    n, has = run(tmp_path)
    assert int(n) >= 80 and has == "False"


def test_entry_runs(spark):
    import __spark_entry__

    df = __spark_entry__.entry(spark)
    assert df.limit(1).count() == 1 and {"cost_lag1", "cost_roll28", "price_drift", "dow"} <= set(df.columns)


def test_nothing_else_imports_the_optional_parts():
    for f in [*(ROOT / "costloom").rglob("*.py"), ROOT / "bench.py"]:
        if "llm" not in f.parts:
            assert ".llm" not in f.read_text() and "import llm" not in f.read_text(), f
