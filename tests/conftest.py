from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from siltstone.shipping import ship_packages

    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    ship_packages(session, ROOT, ("siltstone", "queries"))
    yield session
    session.stop()


@pytest.fixture
def put(tmp_path):
    """Write a text file below the test's folder and return its path."""

    def write(name: str, text: str) -> str:
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text, encoding="utf-8")
        return str(path)

    return write


def rows(df, *order):
    """Rows as dictionaries, sorted by the given columns."""
    out = [r.asDict() for r in df.collect()]
    return sorted(out, key=lambda r: tuple(str(r[c]) for c in order)) if order else out
