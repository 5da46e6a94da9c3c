"""Small shared pieces: a table written once in the shared folder, and connected components."""

from __future__ import annotations

import contextlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.session import materialize


def write_once(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as parquet under ``spark.checkpoint.dir`` and read back (lineage is cut there)."""
    return materialize(df, f"llm-{name}")


def let_go(df: DataFrame) -> None:
    """Delete the files of tables that ``write_once`` gave and nothing reads any more."""
    jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
    for folder in {jvm.org.apache.hadoop.fs.Path(f).getParent().toString() for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


@contextlib.contextmanager
def no_shuffle_left(spark):
    """Shuffle files go with the query that wrote them, not when the driver happens to collect its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    old = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if old is None else spark.conf.set(key, old)


def lower_ascii(col):
    """A-Z to a-z, every other character as it is (``lower`` would also touch other alphabets)."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def components(edges: DataFrame, name: str = "cc", max_rounds: int = 60) -> DataFrame:
    """Connected components of the undirected edges ``(a, b)``: one row ``(node, component)`` per node
    that has an edge to another node; ``component`` is the smallest node reachable.

    Alternating large-star / small-star rounds: each round is two minima per node (combined map-side) and
    two equi-joins, which AQE can split at hubs; a round is written to the shared folder, so a lost
    executor replays one round. Every round keeps connectivity; it ends when the edge set is stable,
    which is when every node hangs on its component's minimum. Self-edges, repeated edges and null ends
    are dropped; no edges give an empty table.
    """
    e = (edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"), F.col("a").alias("_a"),
                      F.col("b").alias("_b"))
         .where(F.col("_a").isNotNull() & F.col("_b").isNotNull() & (F.col("u") != F.col("v")))
         .select("u", "v").distinct())
    e = write_once(e, f"{name}-0")
    seen = None
    for i in range(max_rounds):
        state = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state[0] == 0 or tuple(state) == seen:
            break
        seen = tuple(state)
        both = e.select("u", "v").unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u != v").distinct())
        # small star: each node's lower neighbours, and itself, move to the lowest of them
        mins = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(mins, "u").select(F.explode(F.array(F.col("u"), F.col("v"))).alias("u"),
                                              F.col("m").alias("v"))
                 .where("u != v").distinct())
        e = write_once(small, f"{name}-{i + 1}")
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    star = e.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return star.unionAll(roots)


TEXT_ROWS = 1000


def text_batches(spark) -> None:
    """Arrow batches of at most ``TEXT_ROWS`` rows for the functions that read whole texts: a setting of the session,
    lowered only, so that a batch of texts stays at some megabytes on both sides."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= TEXT_ROWS:
        spark.conf.set(key, str(TEXT_ROWS))


@contextlib.contextmanager
def returned_memory():
    """Give freed memory back to the machine when a task's function ends: its Python worker stays and others use it."""
    try:
        yield
    finally:
        import ctypes
        import gc

        import pyarrow as pa

        gc.collect()
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # another C library has no such call
            ctypes.CDLL("libc.so.6").malloc_trim(0)
