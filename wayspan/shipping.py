"""Make the package importable on executors that don't have it on their path."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent
_shipped: set[str] = set()


def _on_path() -> bool:
    """Whether workers find the package as the driver does: by PYTHONPATH or the working folder."""
    places = [p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p] + [os.getcwd()]
    return any((Path(p) / ROOT.name / "__init__.py").exists() for p in places)


def ship(spark: SparkSession) -> None:
    """Send the package to the executors once for each application, where they need it."""
    app = spark.sparkContext.applicationId
    if app in _shipped or _on_path():
        return
    path = Path(tempfile.mkdtemp(prefix="wayspan-")) / "wayspan.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(ROOT.rglob("*.py")):
            z.write(f, f"{ROOT.name}/{f.relative_to(ROOT)}")
    spark.sparkContext.addPyFile(str(path))
    _shipped.add(app)
