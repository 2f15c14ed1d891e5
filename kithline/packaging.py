"""Handing the package to the executors of a cluster on which it is not installed."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import SparkSession


def ship(spark: SparkSession) -> str:
    """Zip the package and hand it to all executors, also to later ones; the archive's path.

    Python workers import it from there, whatever folder the driver was started in.
    """
    package = os.path.dirname(os.path.abspath(__file__))
    base = os.path.join(tempfile.mkdtemp(prefix="kithline-"), "kithline")
    archive = shutil.make_archive(base, "zip", os.path.dirname(package), os.path.basename(package))
    spark.sparkContext.addPyFile(archive)
    return archive
