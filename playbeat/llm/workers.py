"""Brings this package to Python workers that do not have it on their path."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import zipfile

from pyspark.sql import SparkSession

BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
_SENT: set[str] = set()


def send_code(spark: SparkSession) -> None:
    """Adds the package's sources to the session once, as `--py-files` would; the driver serves the archive to executors.

    Also makes Arrow batches of whole texts smaller, unless the session has a size of its own.
    """
    if spark.conf.get(BATCH) == "10000":
        spark.conf.set(BATCH, "1000")
    context = spark.sparkContext
    if context.applicationId in _SENT:
        return
    _SENT.add(context.applicationId)
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    folder = tempfile.mkdtemp(prefix="code-")
    atexit.register(shutil.rmtree, folder, True)
    archive = os.path.join(folder, f"{os.path.basename(top)}.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for at, _, names in os.walk(top):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(at, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(top)))
    context.addPyFile(archive)
