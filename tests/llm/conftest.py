from pathlib import Path

import pytest


@pytest.fixture(autouse=True)
def worker_path(spark):
    """Python workers import the package from this repository."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
