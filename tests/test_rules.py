"""What library code must not do: run off the cluster, pick a master, or lose work with an executor."""

import re
from pathlib import Path

import pytest

LIBRARY = sorted((Path(__file__).resolve().parent.parent / "tickbars").rglob("*.py"))
LIBRARY = [path for path in LIBRARY if path.parent.name != "llm"]  # has bounded models to fetch
BANNED = [r"\.collect\(", r"\.toPandas\(", r"\budf\(", r"pandas_udf", r"localCheckpoint", r"\.master\(\"", r"\.rdd\b",
          r"crossJoin", r"\.coalesce\(1\)", r"repartition\(1\)"]


@pytest.mark.parametrize("pattern", BANNED)
def test_not_in_the_library(pattern):
    assert LIBRARY
    assert [path.name for path in LIBRARY if re.search(pattern, path.read_text())] == []
