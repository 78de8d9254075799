"""The driver contract in a copy without the training-data operators."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
ASK = "import __spark_entry__ as e; from legajo.plans.queries import REGISTRY; assert set(e.queries()) == set(REGISTRY) == set(e.oracle_sql()); print(len(REGISTRY))"


@pytest.mark.parametrize("left_out", [("llm",), ("llm", "corpus_pipeline.py")])
def test_import_without_the_training_data_operators(tmp_path, left_out):
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    if "corpus_pipeline.py" not in left_out and os.path.exists(f"{ROOT}/corpus_pipeline.py"):
        shutil.copy(f"{ROOT}/corpus_pipeline.py", tmp_path)
    shutil.copytree(f"{ROOT}/legajo", tmp_path / "legajo", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", ASK], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120)
    assert run.returncode == 0, run.stderr
    assert int(run.stdout) > 50
