"""Session helpers: shared checkpoint folder and a test/bench session.

Library code never creates a session; callers pass one in. Lineage is cut
with Parquet written to the cluster-wide ``spark.checkpoint.dir``, never with
``localCheckpoint``.
"""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
#: Settings of a query that stages a table: its shuffle files go when it ends, and no method is longer than HotSpot compiles.
RELEASE_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
STAGING_CONF = {RELEASE_CONF: "true", "spark.sql.codegen.hugeMethodLimit": "8000"}
#: Bytes of a staged row group (a task reads whole ones), and of a scan where trees are grown.
ROW_GROUP = 8 << 20
TREE_SPLIT = 16 << 20


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Where the setting is absent, a local master gets a fresh folder; any other
    master must name one, as executors can't see a folder of the driver.
    """
    conf = spark.conf.get(CHECKPOINT_CONF, None)
    if not conf:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
        conf = tempfile.mkdtemp(prefix="netsift-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, conf)
    spark.sparkContext.setCheckpointDir(conf)
    return conf


def cut_lineage(df, split: int | None = None):
    """Write ``df`` as Parquet in the shared checkpoint folder and continue from there.

    Survives executor loss (the files are on shared storage), unlike ``localCheckpoint``. The last stage
    runs once (``checkpoint()`` runs it again to write), and later reads take the columns they need alone.
    With ``split``, scans of the result have at most so many bytes a task (see :func:`small_scans`).
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"cut-{uuid.uuid4().hex[:12]}")
    with staging(spark):
        df.write.option("parquet.block.size", ROW_GROUP).parquet(path)
    reader = small_scans(spark, split) if split else spark
    return reader.read.schema(df.schema).parquet(path)


_HELD = threading.Lock()
_STAGING: dict[str, tuple[list, dict]] = {}


@contextmanager
def staging(spark: SparkSession):
    """Queries planned and run inside remove their shuffle files when they end and leave generated code that is never compiled.

    The files would stay until the driver collects its garbage, so that a job holds the joins of all its
    steps on disk. For a query whose plan is not run again, as a staged write is (one that is
    run again calculates the lost files anew). Stages whose methods are too long for the JVM's
    compiler, such as all bins at once, run operator by operator instead of interpreted.
    Threads may share the session: the last one to leave restores its settings.
    """
    session = spark._jsparkSession.sessionUUID()
    with _HELD:
        uses, was = _STAGING.setdefault(session, ([], {k: spark.conf.get(k, None) for k in STAGING_CONF}))
        uses.append(1)
        for k, v in STAGING_CONF.items():
            spark.conf.set(k, v)
    try:
        yield
    finally:
        with _HELD:
            uses.pop()
            if not uses:
                del _STAGING[session]
                for k, v in was.items():
                    spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def small_scans(spark: SparkSession, split: int) -> SparkSession:
    """A session with the settings of ``spark``, but scans of at most ``split`` bytes a task.

    Tree learners keep the rows they scan, and encoded bins grow more than tenfold in memory, so
    a part of the usual size would be a cached block of gigabytes.
    """
    own, at = spark.newSession(), checkpoint_dir(spark)
    set_there = own.conf.getAll
    for key, value in spark.conf.getAll.items():
        if set_there.get(key) != value and own.conf.isModifiable(key):
            own.conf.set(key, value)
    if own.conf.get(CHECKPOINT_CONF, None) != at:
        own.conf.set(CHECKPOINT_CONF, at)
    own.conf.set("spark.sql.files.maxPartitionBytes", split)
    return own


def storage_memory(spark: SparkSession) -> int:
    """Bytes that the executors can cache now (without the driver's, unless it is the only one)."""
    sizes = sorted(e.totalOnHeapStorageMemory() for e in spark.sparkContext._jsc.sc().statusTracker().getExecutorInfos())
    return sum(sizes[1:] or sizes)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for intermediate tables and stream checkpoints under the shared folder."""
    base = checkpoint_dir(spark)
    path = os.path.join(base, name)
    return path


_SHIPPED: set[int] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``netsift`` importable in Python workers (data sources, foreachPartition).

    Zips the package once per SparkContext and distributes it with
    ``addPyFile``, so executors need no local install.
    """
    sc = spark.sparkContext
    if id(sc) in _SHIPPED:
        return
    import shutil

    pkg = os.path.dirname(os.path.abspath(__file__))
    out = tempfile.mkdtemp(prefix="netsift-pkg-")
    archive = shutil.make_archive(os.path.join(out, "netsift"), "zip", os.path.dirname(pkg), "netsift")
    sc.addPyFile(archive)
    _SHIPPED.add(id(sc))


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "netsift") -> SparkSession:
    """Session for tests and the local bench (no UI, AQE on, UTC)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark
