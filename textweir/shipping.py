"""Sends the package's own code to the executors."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent
_sent: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Add the package to the application's Python files, once for each application."""
    context = spark.sparkContext
    if context.applicationId in _sent:
        return
    folder = tempfile.mkdtemp(prefix="textweir-code-")
    archive = f"{folder}/textweir_code.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for path in sorted(ROOT.rglob("*.py")):
            out.write(path, path.relative_to(ROOT.parent))
    context.addPyFile(archive)
    _sent.add(context.applicationId)
