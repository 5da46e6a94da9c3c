"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on: AQE re-plans joins from measured shuffle sizes (runtime broadcast of
# small sides, skew-join splitting of hot keys, partition coalescing); the session zone is pinned so
# formatted times do not depend on the machine.
CORE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Keyed state (one row per device, join and window buffers) lives in RocksDB on local disk and is
    # snapshotted to the checkpoint, not on the JVM heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(master: str | None = None, partitions: int = 8, app: str = "storelens",
                  extra: dict | None = None) -> SparkSession:
    """Local or cluster session. On a cluster pass ``master=None`` and let spark-submit decide."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(CORE_CONF)
    conf.update({
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.driver.memory": os.environ.get("STORELENS_DRIVER_MEMORY", "8g"),
    })
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names shared storage and is only read; without it this is an error. Under a
    local master a fresh folder is made and registered with ``setCheckpointDir``, so every later call agrees.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no SparkContext, only the session's settings
        d = spark.conf.get("spark.checkpoint.dir", None)
        if not d:
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        return d
    d = sc.getConf().get("spark.checkpoint.dir", None)
    if d:
        return d
    d = sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="storelens-ckpt-"))
        d = sc.getCheckpointDir()
    return d


def _app_folder(spark: SparkSession) -> str:
    try:
        app = spark.sparkContext.applicationId
    except Exception:  # Spark Connect
        app = spark.conf.get("spark.app.id", "app")
    return f"{checkpoint_root(spark).rstrip('/')}/storelens/{app}"


def materialize(df, name: str):
    """Write ``df`` once as parquet under the shared checkpoint folder and read it back.

    Used where one intermediate (the page log, the order lines) feeds several branches of a job: it
    plays the part of the topic between the shop's jobs, cuts the lineage (an executor loss replays
    from the files, not from the sources) and lets each branch read only its columns. Files live in
    one folder per application; ``clear_materialized`` removes it when the results are written.
    """
    import uuid

    spark = df.sparkSession
    path = f"{_app_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def clear_materialized(spark: SparkSession) -> None:
    """Delete this application's materialised intermediates (DataFrames read from them become invalid)."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(_app_folder(spark))
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(path):
        fs.delete(path, True)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``storelens`` importable in Python workers (needed by the pandas state functions).

    On a cluster submit with ``--py-files``; otherwise the package is zipped once per application
    into the shared checkpoint folder and added with ``addPyFile``.
    """
    import io
    import zipfile

    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: ship with spark.addArtifacts(zip, pyfile=True) at submit time
        return
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for base, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    root = checkpoint_root(spark)
    local = root[len("file:"):] if root.startswith("file:") else root
    if not root.startswith("file:") and not sc.master.startswith("local") or "://" in local:
        # Shared storage, also where the default file system is one and the path names no scheme: write
        # through the Hadoop file system of the session.
        jvm = spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/storelens-{app}.zip")
        out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path, True)
        out.write(bytearray(buf.getvalue()))
        out.close()
        sc.addPyFile(path.toString())
    else:
        os.makedirs(local, exist_ok=True)
        target = os.path.join(local, f"storelens-{app}.zip")
        with open(target, "wb") as fh:
            fh.write(buf.getvalue())
        sc.addPyFile(target)
    _SHIPPED.add(app)
