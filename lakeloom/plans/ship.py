"""Makes this package importable in Python workers."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Adds the package as a ZIP to the application, once, unless workers find it anyway: by PYTHONPATH, or by the working folder of a local master."""
    root, context = Path(__file__).resolve().parents[2], spark.sparkContext
    known = [Path(p).resolve() for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if context.master.startswith("local["):
        known.append(Path.cwd().resolve())
    if root in known or context.applicationId in _SHIPPED:
        return
    target = Path(os.path.realpath(tempfile.mkdtemp())) / "lakeloom.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted((root / "lakeloom").rglob("*.py")):
            z.write(p, p.relative_to(root).as_posix())
    context.addPyFile(str(target))
    _SHIPPED.add(context.applicationId)
