"""Small hand-written inputs (FIXTURES.md part 2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storelens import schemas

DAY = 86_400_000


def log_rows(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """Behaviour-log records from dicts with keys mid, ts, offset and optional is_new, page_id,
    last_page_id, item, during_time, start (bool), displays (list of (type, item))."""
    data = []
    for i, r in enumerate(rows):
        common = (str(r["mid"]), r.get("vc", "v0"), r.get("ch", "c0"), r.get("ar", "a0"), r.get("is_new", "0"))
        start = ("icon", 1) if r.get("start") else None
        page = None if r.get("start") else (r.get("page_id", "home"), r.get("last_page_id"), r.get("item"),
                                           r.get("during_time", 0))
        disp = r.get("displays")
        disp = [tuple(d) for d in disp] if disp is not None else None
        data.append((common, start, page, disp, int(r["ts"]), int(r.get("offset", i))))
    schema = T.StructType(list(schemas.LOG.fields) + [T.StructField("offset", schemas.L)])
    return spark.createDataFrame(data, schema)


def rows_of(df: DataFrame, *cols: str) -> list[tuple]:
    return sorted(tuple(r) for r in df.select(*cols).collect())


def mid_ts(df: DataFrame) -> list[tuple]:
    return sorted((r["mid"], r["ts"]) for r in df.select(F.col("common.mid").alias("mid"), "ts").collect())
