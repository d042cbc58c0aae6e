from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parents[1]
COUNT = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), sorted(set(e.oracle_sql()) - set(e.queries())))"


def counted(folder: Path) -> str:
    run = subprocess.run([sys.executable, "-c", COUNT], cwd=folder, capture_output=True, text=True, timeout=120)
    assert run.returncode == 0, run.stderr
    return run.stdout.strip()


def test_queries_without_the_llm_folders(tmp_path):
    from tallywork.plans.catalog import registry

    copy = tmp_path / "repo"
    copy.mkdir()
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if (REPO / name).exists():
            shutil.copy(REPO / name, copy / name)
    shutil.copytree(REPO / "tallywork", copy / "tallywork", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    known = registry()
    assert counted(copy) == f"{len(known.queries)} {len(known.checks)} []"
    (copy / "corpus_pipeline.py").unlink(missing_ok=True)
    assert counted(copy) == f"{len(known.queries)} {len(known.checks)} []"
