"""One local session for all tests; intermediate tables go where it says."""

from __future__ import annotations

import json
import sys
from collections.abc import Callable, Iterator
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark() -> Iterator[SparkSession]:
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def lines(tmp_path: Path) -> Callable[..., str]:
    """Write values (as JSON) or text (as it is) to the lines of a file; gives its folder."""

    def write(rows: list, name: str = "a.json", folder: str = "in") -> str:
        path = tmp_path / folder / name
        path.parent.mkdir(parents=True, exist_ok=True)
        text = (row if isinstance(row, str) else json.dumps(row) for row in rows)
        path.write_text("\n".join(text) + "\n", encoding="utf-8")
        return str(tmp_path / folder)

    return write
