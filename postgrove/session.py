"""Session settings for jobs, and the folder executors share."""

from __future__ import annotations

import atexit
import functools
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

from postgrove.functions.batches import BATCH_BYTES

_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Batches of long texts stay small in the Python workers.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(BATCH_BYTES),
}


def build_session(app_name: str) -> SparkSession:
    """A session for a submitted job. Master, memory and shuffle width stay with
    the submitter; only settings the submitter left open are filled in."""
    spark = SparkSession.builder.appName(app_name).getOrCreate()
    given = dict(spark.sparkContext.getConf().getAll())
    for key, value in _DEFAULTS.items():
        if key not in given:
            spark.conf.set(key, value)
    return spark


@functools.cache
def _local_folder(application: str) -> str:
    folder = tempfile.mkdtemp(prefix=f"postgrove-{application}-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name under the one the cluster names in spark.checkpoint.dir.

    A machine-local folder is only used where there is a single process; it is
    removed when that ends.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = _local_folder(spark.sparkContext.applicationId)
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
