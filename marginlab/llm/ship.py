"""Python workers need the library's modules: sent to them where they would not find them."""

from __future__ import annotations

import os
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

_SENT: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the executors, once per application.

    Nothing is sent if the workers find it as the driver does, in the working
    folder or on PYTHONPATH. A cluster that installs the package does not need this.
    """
    root = Path(__file__).resolve().parents[2]
    known = [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)]
    application = spark.sparkContext.applicationId
    if application in _SENT or any(p and Path(p).resolve() == root for p in known):
        return
    folder = os.path.realpath(tempfile.mkdtemp(prefix="marginlab-"))
    spark.sparkContext.addPyFile(shutil.make_archive(f"{folder}/marginlab", "zip", root, "marginlab"))
    _SENT.add(application)
