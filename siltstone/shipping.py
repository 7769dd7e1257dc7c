"""Code for Python workers: functions that run in tasks are looked up by module name."""

from __future__ import annotations

import zipfile
from collections.abc import Iterable
from pathlib import Path

from pyspark.sql import SparkSession

from siltstone.session import scratch_path
from siltstone.storage import arrow_path

_SHIPPED: set[str] = set()


def ship_packages(spark: SparkSession, root: str, packages: Iterable[str]) -> None:
    """Make packages below ``root`` importable on executors, once per application."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    folder = scratch_path(spark, "code")
    fs, name = arrow_path(folder)
    fs.create_dir(name, recursive=True)
    with fs.open_output_stream(f"{name}/siltstone_code.zip") as sink, zipfile.ZipFile(sink, "w") as out:
        for package in packages:
            for file in sorted(Path(root, package).rglob("*.py")):
                out.write(file, str(file.relative_to(root)))
    context.addPyFile(f"{folder}/siltstone_code.zip")
    _SHIPPED.add(context.applicationId)
