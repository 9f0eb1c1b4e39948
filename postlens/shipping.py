"""The package on the executors.

A session that was not started where the package is installed has Python workers that
do not find it. ``ship`` sends them its source.
"""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship(spark: SparkSession, *folders: Path) -> None:
    """Add the source of this package, and of the packages or modules ``folders``, to the workers; once in a session."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    archive = Path(tempfile.mkdtemp(prefix="postlens-")) / "postlens_source.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for top in (Path(__file__).resolve().parent, *folders):
            files = [top] if top.is_file() else sorted(top.rglob("*.py"))
            for f in files:
                z.write(f, f.relative_to(top.parent))
    spark.sparkContext.addPyFile(str(archive))
    _SHIPPED.add(app)
