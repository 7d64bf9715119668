from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))


@pytest.fixture(scope="session")
def docs_small(spark, small):
    return spark.read.parquet(f"{small}/documents.parquet")
