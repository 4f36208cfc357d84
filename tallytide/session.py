"""What a session needs before it runs this library."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED = "spark.tallytide.shipped"


def prepare(spark: SparkSession) -> SparkSession:
    """Set the time zone to UTC and send the package to the Python workers, once per application.

    The call-site lookup behind error messages is switched off: plans with many
    columns spend more time on it than on planning.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.dataFrameQueryContext.enabled", "false")
    app = spark.sparkContext.applicationId
    if spark.conf.get(_SHIPPED, "") != app:
        spark.sparkContext.addPyFile(_package_zip())
        spark.conf.set(_SHIPPED, app)
    return spark


def _package_zip() -> str:
    root = Path(__file__).resolve().parent
    target = os.path.join(tempfile.mkdtemp(prefix="tallytide-"), "tallytide.zip")
    with zipfile.ZipFile(target, "w") as archive:
        for source in sorted(root.rglob("*.py")):
            archive.write(source, source.relative_to(root.parent))
    return target
