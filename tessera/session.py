"""Session helpers: a tuned local session for tests/bench, and lineage cuts.

Library code never creates its own session; it takes the caller's.  The only
session-level setting the library touches is ``spark.checkpoint.dir``, and only
when the caller left it unset (tests, local runs).  On a cluster the shared
folder named there is used as-is.
"""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | None = None, app: str = "tessera") -> SparkSession:
    """Session for tests and the local bench (AQE on, UI off, UTC)."""
    cores = cores or int(os.environ.get("BENCH_CPUS", "8"))
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.default.parallelism", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting a private one only in local mode.

    A cluster names its shared folder in ``spark.checkpoint.dir``; that value is
    always preferred.  A fresh temporary folder is created only when nothing is
    configured and every task runs in this machine's one JVM (``local[...]``).
    Anywhere else a private folder would put each executor's files on its own
    disk, so an unset folder is an error there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        if not is_local_master(sc.master):
            raise ValueError(
                "spark.checkpoint.dir is not set: intermediate tables need a folder that "
                f"the driver and all executors of {sc.master} share"
            )
        conf = tempfile.mkdtemp(prefix="tessera-ckpt-")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def is_local_master(master: str) -> bool:
    """True where driver and executors are one process (``local``, ``local[8]``)."""
    return master == "local" or master.startswith("local[")


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` once as parquet in the shared checkpoint folder and read it back.

    Same guarantees as a reliable checkpoint (fixed contents, short lineage,
    survives executor loss) in ONE job: ``checkpoint(eager=True)`` evaluates
    its input twice, once to count and once to write.
    """
    return Scratch(df.sparkSession).save(df, name)


class Scratch:
    """Intermediate tables of one query in the shared checkpoint folder.

    ``save`` writes a table and reads it back; ``drop`` deletes a table that no
    later step (and no frame handed to the caller) reads any more.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = os.path.join(ensure_checkpoint_dir(spark), "tables")
        self._saved: dict[int, tuple[DataFrame, str]] = {}  # by id(); the frame is kept, so ids stay unique

    def path(self, name: str) -> str:
        return os.path.join(self.root, f"{name}-{uuid.uuid4().hex}")

    def save(self, df: DataFrame, name: str = "table", partition_by: tuple[str, ...] = (), **options: str) -> DataFrame:
        path = self.path(name)
        writer = df.write.mode("error").options(**options)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(path)
        # the schema is known: no inference job, and partition columns keep their types
        back = self.spark.read.schema(df.schema).parquet(path)
        self._saved[id(back)] = (back, path)
        return back

    def drop(self, *frames: DataFrame) -> None:
        for df in frames:
            _, path = self._saved.pop(id(df), (None, None))
            if path:
                delete_folder(self.spark, path)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store the path names (Hadoop FileSystem API)."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


_SHIPPED: set[str] = set()
_SHIP_LOCK = threading.Lock()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers (``addPyFile`` of a zip).

    Operators that run pandas code inside tasks (``mapInPandas``, pandas UDFs)
    reference functions of this package; executors receive the package the way
    ``spark-submit --py-files`` would ship it.  Once per application.
    """
    sc = spark.sparkContext
    with _SHIP_LOCK:
        if sc.applicationId in _SHIPPED:
            return
        pkg_dir = os.path.dirname(os.path.abspath(__file__))
        root = os.path.dirname(pkg_dir)
        zpath = os.path.join(tempfile.mkdtemp(prefix="tessera-pyfiles-"), "tessera.zip")
        with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
            for dirpath, _, files in os.walk(pkg_dir):
                if "__pycache__" in dirpath:
                    continue
                for f in files:
                    if f.endswith(".py"):
                        full = os.path.join(dirpath, f)
                        z.write(full, os.path.relpath(full, root))
        sc.addPyFile(zpath)
        _SHIPPED.add(sc.applicationId)
