import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from llm_fixtures import DOCS, HARD  # noqa: E402


@pytest.fixture(scope="session")
def hard(spark):
    return spark.createDataFrame(HARD, DOCS).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)
