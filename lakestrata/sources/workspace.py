"""Where jobs put the tables they write."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def run_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder that every executor can reach.

    It lies under the session's ``spark.checkpoint.dir``, or under its warehouse
    where that is unset; a cluster shares both. On a cluster a warehouse without a
    file system in its path, or on ``file:``, may be each machine's own: there
    ``spark.checkpoint.dir`` must be set.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        shared = spark.conf.get("spark.sql.warehouse.dir")
        local = spark.sparkContext.master.split("[")[0] == "local"
        if not local and shared.split(":")[0] in ("file", shared):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
    return f"{shared.rstrip('/')}/lakestrata/{name}-{uuid.uuid4().hex}"
