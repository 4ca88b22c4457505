"""Session settings and shared scratch space."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

RECOMMENDED_CONF = {
    # Day parts follow the UTC calendar of the ISO timestamps.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Large dedup state lives on local disk with changelogs in the checkpoint.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

def build_session(app_name: str = "clipwire", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the recommended settings; keyword settings win over them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder name under the shared folder the session names.

    The folder is ``spark.checkpoint.dir``, or where that is unset a folder of the warehouse.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"
    return f"{base.rstrip('/')}/clipwire/{label}-{uuid.uuid4().hex}"
