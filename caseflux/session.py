"""Session set-up and durable intermediate tables.

Every iterative operator cuts its lineage by writing a table into the folder
that all executors share.  The folder is the cluster's ``spark.checkpoint.dir``;
a private one is chosen only on a local master where that setting is absent
(tests, a laptop).
"""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Most bytes a side may have (rows x width estimate) to be broadcast.
BROADCAST_BYTES = 48 << 20

_OWN_DIR: dict[str, str] = {}


def local_session(cores: int | str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session with the settings the engine is tested with."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("caseflux")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def ship_package(spark: SparkSession) -> None:
    """Sends the package to the executors, once a context, unless PYTHONPATH already names it.

    Spark's file server hands the archive out, so it need not lie in a shared folder.
    """
    sc = spark.sparkContext
    package = os.path.dirname(os.path.abspath(__file__))
    if getattr(sc, "_caseflux_shipped", False) or os.path.dirname(package) in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    archive = os.path.join(tempfile.mkdtemp(prefix="caseflux-"), "caseflux.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(package):
            for n in names:
                if n.endswith(".py"):
                    path = os.path.join(folder, n)
                    z.write(path, os.path.relpath(path, os.path.dirname(package)))
    sc.addPyFile(archive)
    sc._caseflux_shipped = True


def shared_dir(spark: SparkSession) -> str:
    """The folder shared by all executors, as the session names it."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN_DIR:
        _OWN_DIR[app] = tempfile.mkdtemp(prefix="caseflux-")
        spark.sparkContext.setCheckpointDir(_OWN_DIR[app])
    return _OWN_DIR[app]


class Workspace:
    """Durable tables of one operator run, under the shared folder.

    ``save`` writes a DataFrame as Parquet and reads it back, which cuts the
    lineage and survives the loss of any executor.  Tables are removed by
    ``drop`` or, at the latest, when the driver ends.
    """

    def __init__(self, spark: SparkSession, name: str = "run"):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/caseflux-{name}-{uuid.uuid4().hex[:12]}"
        atexit.register(self._remove, self.root)

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        self._remove(f"{self.root}/{name}")

    def _remove(self, path: str) -> None:
        try:
            sc = self.spark.sparkContext
            jpath = sc._jvm.org.apache.hadoop.fs.Path(path)
            jpath.getFileSystem(sc._jsc.hadoopConfiguration()).delete(jpath, True)
        except Exception:  # the session is gone; nothing is left to clean with
            pass


def broadcast_if_small(df: DataFrame, rows: int, row_bytes: int, limit: int | None = None) -> DataFrame:
    """Broadcast hint only where ``rows * row_bytes`` is known to be within ``limit`` (BROADCAST_BYTES)."""
    return F.broadcast(df) if rows * row_bytes <= (BROADCAST_BYTES if limit is None else limit) else df
