"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime settings every operator relies on.  Broadcasts stay behind Spark's own
# size check (autoBroadcastJoinThreshold) unless an operator proves a bound itself.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "txnrisk", master: str | None = None, conf: dict | None = None) -> SparkSession:
    """Session with the settings above; ``master`` only for local runs."""
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder executors and driver share, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a fresh temporary folder: on a cluster a
    machine-local path would be lost together with its executor.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):  # executors elsewhere, also under local-cluster
        raise RuntimeError("Set spark.checkpoint.dir to a folder all executors can reach.")
    folder = tempfile.mkdtemp(prefix="txnrisk-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def working_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder for one intermediate table."""
    return f"{shared_folder(spark)}/txnrisk/{name}-{uuid.uuid4().hex[:12]}"


def discard(spark: SparkSession, path: str) -> None:
    """Remove a written intermediate table that nothing reads any more."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def stage(df, name: str):
    """Cut lineage: write ``df`` to the shared folder and read it back.

    Written tables survive lost executors, which cached blocks do not.
    """
    spark = df.sparkSession
    path = working_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
