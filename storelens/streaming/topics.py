"""Sources and sinks (S1-S4, S7, S8, S10, S11) for Structured Streaming and batch alike.

A *topic* here is a directory of JSON-lines files whose records are ``{"offset": n, "value": "<json>"}``:
the two columns a Kafka source yields. Jobs chain through topics exactly as the shop's jobs do, and
every file sink keeps its exactly-once log in the query's checkpoint. With the Kafka package on the
class path, ``read_kafka`` / ``write_kafka`` are the same calls on a broker.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storelens import schemas

# Fixed value: the codec of a topic's files. A record repeats its field names in full, so its text shrinks to a tenth or less;
# such files are not split, so writers leave a file per task.
CODEC = "gzip"


def read_topic(spark: SparkSession, path: str, stream: bool = True, max_files_per_trigger: int | None = None) -> DataFrame:
    """Records of a topic directory as ``value, offset``."""
    if not stream:
        return spark.read.schema(schemas.RAW).json(path)
    r = spark.readStream.schema(schemas.RAW)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.json(path)


def read_json_lines(spark: SparkSession, path: str, schema=None, stream: bool = True) -> DataFrame:
    """Plain JSON-lines text (a log archive or a line feed). Returns ``value`` (text), or the
    parsed columns when ``schema`` is given."""
    src = spark.readStream.text(path) if stream else spark.read.text(path)
    if schema is None:
        return src
    return src.select(F.from_json("value", schema).alias("_r")).select("_r.*")


def read_kafka(spark: SparkSession, servers: str, topic: str, starting_offsets: str = "latest") -> DataFrame:
    """S1/S2 on a broker (needs the spark-sql-kafka package): ``value`` as text plus ``offset``."""
    return (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic).option("startingOffsets", starting_offsets).load()
            .select(F.col("value").cast("string").alias("value"), F.col("offset")))


def as_records(df: DataFrame, offset: Column | str = "offset", payload: list[str] | None = None) -> DataFrame:
    """S7 payload: one JSON text per row (all columns, or ``payload``) plus its offset."""
    cols = payload or [c for c in df.columns if c != "offset"]
    off = F.col(offset) if isinstance(offset, str) else offset
    return df.select(off.cast("long").alias("offset"), F.to_json(F.struct(*cols)).alias("value"))


def write_topic(df: DataFrame, path: str, checkpoint: str | None = None, trigger: dict | None = None):
    """Append records (``offset, value``) to a topic directory. Streams need ``checkpoint``."""
    if not df.isStreaming:
        df.select("offset", "value").write.mode("append").json(path, compression=CODEC)
        return None
    w = df.select("offset", "value").writeStream.format("json").option("path", path).option("compression", CODEC) \
        .option("checkpointLocation", checkpoint).outputMode("append")
    return w.trigger(**(trigger or {"availableNow": True})).start()


def write_routed(df: DataFrame, path: str, checkpoint: str | None = None, trigger: dict | None = None):
    """Topic per record: ``sink_table`` picks the directory, the payload is ``data`` only."""
    out = df.select("sink_table", F.col("offset").cast("long").alias("offset"), F.to_json("data").alias("value"))
    if not df.isStreaming:
        out.write.mode("append").partitionBy("sink_table").json(path, compression=CODEC)
        return None
    return (out.writeStream.format("json").option("path", path).option("compression", CODEC).option("checkpointLocation", checkpoint)
            .partitionBy("sink_table").outputMode("append").trigger(**(trigger or {"availableNow": True})).start())


# ------------------------------------------------------------------ one folder per micro-batch

def batch_folder(path: str, batch_id: int) -> str:
    return f"{path.rstrip('/')}/batch-{batch_id:012d}"


def _file_system(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def batch_ids(spark: SparkSession, path: str) -> list[int]:
    """The micro-batches that have a folder under ``path``."""
    p, fs = _file_system(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
    return sorted(int(n[len("batch-"):]) for n in names if n.startswith("batch-"))


def write_batch(df: DataFrame, path: str, batch_id: int, fmt: str = "json", partition_by: str | None = None) -> bool:
    """Inside ``foreachBatch``: the rows as the folder ``batch-<id>`` of ``path``. They are written beside it and moved into
    place by one rename (atomic on HDFS and local disks), so that readers see all of a batch or nothing; a batch that runs
    again after a failure finds its folder and writes nothing (returns False)."""
    spark = df.sparkSession
    target, fs = _file_system(spark, batch_folder(path, batch_id))
    if fs.exists(target):
        return False
    aside = f"{path.rstrip('/')}-staging/batch-{batch_id:012d}"
    w = df.write.mode("overwrite").format(fmt)
    w = w.option("compression", CODEC) if fmt == "json" else w
    (w.partitionBy(partition_by) if partition_by else w).save(aside)
    fs.mkdirs(target.getParent())
    if not fs.rename(_file_system(spark, aside)[0], target):
        raise RuntimeError(f"cannot move {aside} into place")
    return True


def read_facts(spark: SparkSession, path: str, table: str, columns: str, stream: bool = True,
               max_files: int | None = None, once: bool = False) -> DataFrame:
    """S8 read back: the routed records of one sink table with that table's schema; ``once`` deletes files that a stream has read.

    A routed record is the changed row's ``data``, a map of texts. ``columns`` (DDL) names and types the table's columns: each
    is cast from its text, null where it is missing or no such value; keys beyond them are left out. ``offset`` is the
    change record's."""
    folder = f"{path.rstrip('/')}/batch-*/sink_table={table}"
    if stream:
        r = spark.readStream.schema(schemas.RAW)
        if max_files:
            r = r.option("maxFilesPerTrigger", max_files)
        if once:
            r = r.option("cleanSource", "delete")
        src = r.json(folder)
    else:
        src = spark.read.schema(schemas.RAW).json(folder)
    data = src.select(F.from_json("value", "map<string,string>").alias("_d"), "offset")
    return data.select(*[F.col("_d")[f.name].try_cast(f.dataType).alias(f.name) for f in T.StructType.fromDDL(columns).fields], "offset")


def late_rows(query) -> int:
    """How many rows a streaming query has dropped behind its watermark so far, by its recent progress (rows are counted as
    they reach the state, after the map-side combine of an aggregate). Spark keeps the last
    ``spark.sql.streaming.numRecentProgressUpdates`` micro-batches."""
    return sum(op.numRowsDroppedByWatermark for p in query.recentProgress for op in p.stateOperators)


def write_kafka(df: DataFrame, servers: str, topic_col: str | None = None, topic: str | None = None,
                checkpoint: str | None = None):
    """S7/S8 on a broker: ``value`` text, topic fixed or taken from a column."""
    out = df.select(*([F.col(topic_col).alias("topic")] if topic_col else []), F.col("value"))
    w = out.writeStream.format("kafka").option("kafka.bootstrap.servers", servers).option("checkpointLocation", checkpoint)
    if topic:
        w = w.option("topic", topic)
    return w.start()


def stats_writer(path: str, columns: list[str] | tuple[str, ...], jdbc_url: str | None = None,
                 table: str | None = None, batch_size: int = 1000, properties: dict | None = None):
    """A ``foreachBatch`` function writing the declared columns in order.

    Files: each micro-batch overwrites its own ``batch_id=`` folder, so a replayed batch replaces
    itself (exactly-once). JDBC: rows are appended with their ``batch_id`` as a last column, ``batchsize``
    rows to a statement (the shop used 5); this is at-least-once, and a replayed batch shows by its id.
    """
    cols = list(columns)

    def write(batch: DataFrame, batch_id: int) -> None:
        out = batch.select(*cols)
        if jdbc_url:
            opts = dict(properties or {})
            opts["batchsize"] = str(batch_size)
            out.withColumn("batch_id", F.lit(batch_id)).write.mode("append").jdbc(jdbc_url, table, properties=opts)
        else:
            out.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch_id={batch_id}")
    return write


def write_stats(df: DataFrame, path: str, columns, checkpoint: str, output_mode: str = "append",
                trigger: dict | None = None):
    """S10 as a running query."""
    return (df.writeStream.foreachBatch(stats_writer(path, columns)).option("checkpointLocation", checkpoint)
            .outputMode(output_mode).trigger(**(trigger or {"availableNow": True})).start())


def write_console(df: DataFrame, output_mode: str = "append"):
    """Print each micro-batch."""
    return df.writeStream.format("console").option("truncate", "false").outputMode(output_mode).start()


def write_log_archive(raw: DataFrame, path: str, ts: str = "ts", zone: str = "UTC") -> None:
    """Log lines kept as one JSON per line, one folder per day (``dt=yyyy-MM-dd``).

    ``raw`` has the JSON text in ``value``; the day comes from the record's epoch-ms ``ts``. The days that ``raw`` holds are
    replaced, all others stay (dynamic partition overwrite), so a day may be archived again. Lines without a time go to the
    folder of the null day. Files of a day are as many as the tasks that write it; a hot day is not gathered."""
    from storelens.functions.time import day_of
    day = day_of(F.get_json_object("value", f"$.{ts}").cast("long"), zone, "yyyy-MM-dd")
    (raw.select("value", day.alias("dt")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("dt").text(path))


def read_log_archive(spark: SparkSession, path: str, first_day: str | None = None, last_day: str | None = None) -> DataFrame:
    """The archive's lines, ``value`` and ``dt``; of the days asked for only those folders are listed and read."""
    lines = spark.read.schema("value string, dt string").text(path)
    if first_day is not None:
        lines = lines.where(F.col("dt") >= first_day)
    return lines if last_day is None else lines.where(F.col("dt") <= last_day)


def newest_file_ms(spark: SparkSession, path: str) -> int:
    """The latest modification time (epoch ms) of a topic's files; 0 for an empty or missing topic."""
    p, fs = _file_system(spark, path)
    if not fs.exists(p):
        return 0
    newest, files = 0, fs.listFiles(p, True)
    while files.hasNext():
        newest = max(newest, files.next().getModificationTime())
    return newest


def latest_position(spark: SparkSession, path: str, kept_at: str) -> int:
    """S2 "latest offset": the position at which a query first started on a topic, the newest file it had then. It is kept in
    the folder ``kept_at``, so that a restart goes on from the query's checkpoint instead of skipping what came meanwhile."""
    p, fs = _file_system(spark, kept_at)
    if not fs.exists(p):
        write_batch(spark.createDataFrame([(newest_file_ms(spark, path),)], "ms long"), kept_at, 0, "parquet")
    return spark.read.parquet(batch_folder(kept_at, 0)).first()["ms"]


def read_rules(spark: SparkSession, path: str | None = None, jdbc_url: str | None = None,
               table: str = "table_process", properties: dict | None = None) -> DataFrame:
    """The routing rule table from parquet files or over JDBC (snake_case columns as stored)."""
    if jdbc_url:
        return spark.read.jdbc(jdbc_url, table, properties=properties or {})
    return spark.read.schema(schemas.RULE).parquet(path)
