"""Makes the package importable where tasks run."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[2]
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends the package to the executors unless their Python path already has it."""
    app = spark.sparkContext.applicationId
    paths = [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)]
    if app in _shipped or any(p and Path(p).resolve() == ROOT for p in paths):
        return
    archive = Path(tempfile.mkdtemp(prefix="run-")) / "riskweave_code.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in (ROOT / "riskweave").rglob("*.py"):
            z.write(f, f.relative_to(ROOT))
    spark.sparkContext.addPyFile(str(archive))  # Spark serves it to every executor
    _shipped.add(app)
