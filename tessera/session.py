"""Spark session helpers.

The library never owns a session: every operator takes DataFrames.  These
helpers only build a session for tests, the bench and the examples, and make
sure a checkpoint directory exists for iterative jobs.
"""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Broadcast only sides whose size Spark has measured below this bound.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
}


def get_spark(app: str = "tessera", master: str | None = None,
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", os.environ.get("TESSERA_DRIVER_MEMORY", "16g"))
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    ensure_checkpoint_dir(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers once per application, so that its functions can be
    unpickled there wherever the driver was started from."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    if os.path.isdir(root):  # else it came as an archive and is on the workers already
        path = os.path.join(tempfile.mkdtemp(prefix="tessera-code-"), "tessera.zip")
        with zipfile.ZipFile(path, "w") as z:
            for folder, _, names in os.walk(root):
                for name in names:
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        z.write(full, os.path.relpath(full, os.path.dirname(root)))
        sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def is_local(spark: SparkSession) -> bool:
    """Executors are threads of the driver, so that its temporary folders are theirs too."""
    master = spark.sparkContext.master
    return master.startswith("local") and not master.startswith("local-cluster")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's shared ``spark.checkpoint.dir``; only a local master may leave it unset and
    then gets a private scratch folder."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="tessera-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def checkpoint(df):
    """Cut lineage with a reliable checkpoint (never localCheckpoint)."""
    ensure_checkpoint_dir(df.sparkSession)
    ship_package(df.sparkSession)
    return df.checkpoint(eager=True)
