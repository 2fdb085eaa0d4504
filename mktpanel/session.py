"""Session defaults and the shared folder used for written tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on.  Time zone: news stamps and dates are computed
# time-zone free, but UTC keeps anything printed by Spark stable as well.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.showConsoleProgress": "false",
    # The UI is off; keep the driver's job/stage/SQL status store small so long
    # sessions with many queries do not slow down as it grows.
    "spark.sql.ui.retainedExecutions": "20",
    "spark.ui.retainedJobs": "50",
    "spark.ui.retainedStages": "50",
}


def build_session(master: str | None = None, app: str = "mktpanel",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the defaults above.

    On a cluster pass ``master=None`` and let spark-submit decide.  The web UI
    stays off: jobs here never serve pages.
    """
    b = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        b = b.master(master)
    for k, v in SESSION_DEFAULTS.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A cluster names a folder every executor can reach; it is read from the
    session.  Only when it is unset (local tests) a private folder is created
    and registered, so later calls and ``DataFrame.checkpoint`` agree.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="mktpanel-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
        spark.sparkContext.setCheckpointDir(root)
    return root


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for one written table.

    The application owns it: the file system removes the folder when the driver
    ends.  Callers that keep a table name a path of their own.
    """
    path = f"{checkpoint_root(spark).rstrip('/')}/mktpanel/{name}-{uuid.uuid4().hex[:12]}"
    # The folder is made now, to be owned; the table goes below it and is the caller's to create.
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(folder)
    system.deleteOnExit(folder)
    return f"{path}/table"


def materialize(df, name: str = "stage", partition_by: str | None = None):
    """Write ``df`` as parquet under the shared checkpoint folder and read it back.

    Used at stage boundaries whose result is small and read by several
    branches (the weekly panel), so upstream scans run once and the lineage
    is cut.  Files in the shared folder survive executor loss, and the
    read-back table carries real size statistics for the optimizer.
    """
    spark = df.sparkSession
    path = shared_dir(spark, name)
    w = df.write.mode("overwrite")
    (w.partitionBy(partition_by) if partition_by else w).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
