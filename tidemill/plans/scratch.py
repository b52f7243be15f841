"""A folder of its own for every query that writes something before it reads it back."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

from tidemill.session import checkpoint_dir


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder of `spark.checkpoint.dir`."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
