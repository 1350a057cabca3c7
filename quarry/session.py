"""SparkSession construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, app: str = "quarry",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Session tuned for the corpus jobs.

    On a cluster the master, memory and checkpoint folder come from the
    submit configuration; locally we default to ``local[$BENCH_CPUS]``.
    """
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.appName(app)
    submitted = "PYSPARK_GATEWAY_PORT" in os.environ  # spark-submit has chosen master and sizes
    if master or not submitted:
        builder = builder.master(master or f"local[{cpus}]")
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Filters on a Python Data Source reach its reader.
        "spark.sql.python.filterPushdown.enabled": "true",
        # Broadcasts are chosen explicitly behind size checks; keep the
        # automatic threshold modest so AQE never broadcasts a large side.
        "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    }
    if not submitted:
        conf["spark.driver.memory"] = os.environ.get("QUARRY_DRIVER_MEMORY", "16g")
    if shuffle_partitions or not submitted:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or int(cpus) * 2)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared (HDFS/object store) folder there; we only pick
    a scratch folder ourselves when the setting is absent (local tests).
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="quarry-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def reliable_checkpoint(df):
    """Cut lineage with a reliable checkpoint in the shared folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete an intermediate folder of ours that nothing reads any more (any Hadoop file system)."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once a session, where they could not import it otherwise.

    Nothing is sent when the folder that holds the package is on the workers'
    path already: in ``PYTHONPATH`` or the working folder of the driver.
    """
    package = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(package)
    path = [os.path.abspath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    sc = spark.sparkContext
    if root in path or os.path.abspath(os.getcwd()) == root or getattr(sc, "_quarry_shipped", False):
        return
    out = os.path.join(tempfile.mkdtemp(prefix="quarry-package-"), "quarry.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    sc._quarry_shipped = True
