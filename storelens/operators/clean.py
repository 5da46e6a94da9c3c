"""Parsing, splitting and filtering of behaviour logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storelens import schemas
from storelens.functions.json_text import object_size


def parse_records(raw: DataFrame, schema: T.StructType, value: str = "value", keep: tuple[str, ...] = ("offset",)) -> DataFrame:
    """JSON text -> typed columns. Unparseable text gives a row of nulls (permissive)."""
    kept = [c for c in keep if c in raw.columns]
    return raw.select(F.from_json(F.col(value), schema).alias("_r"), *kept).select("_r.*", *kept)


def parse_log(raw: DataFrame, value: str = "value") -> DataFrame:
    return parse_records(raw, schemas.LOG, value)


def _non_empty(struct_col: str, df: DataFrame) -> Column:
    """A struct that is present and has at least one non-null field (a JSON object of size > 0)."""
    fields = df.schema[struct_col].dataType.fieldNames()
    any_field = F.coalesce(*[F.col(f"{struct_col}.{f}").cast("string") for f in fields],
                           F.lit(None).cast("string")).isNotNull()
    return F.coalesce(F.col(struct_col).isNotNull() & any_field, F.lit(False))


def is_start(log: DataFrame) -> Column:
    """A non-empty ``start`` object: by its keys, known or not, where the record's text is at hand (``value``)."""
    if "value" in log.columns:
        named = F.contains("value", F.lit("start")) | F.contains("value", F.lit("\\"))  # else it has no such key, however spelled
        return F.when(named, object_size("value", "start") > 0).otherwise(F.lit(False))
    return _non_empty("start", log)


def split_log(log: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(start, page, display). Page records keep their displays; display rows are exploded."""
    start_flag = is_start(log)
    start = log.where(start_flag)
    page = log.where(~start_flag)
    return start, page, explode_displays(page)


def explode_displays(page: DataFrame) -> DataFrame:
    """P10: one row per element of ``displays`` with the parent's ``page_id`` added.

    Null and empty arrays give no rows (``explode``, not ``explode_outer``).
    """
    return page.select(F.explode("displays").alias("d"), F.col("page.page_id").alias("page_id")) \
        .select(F.col("d.*"), "page_id")


def is_entry(last_page_id: Column | str = "page.last_page_id", empty_is_entry: bool = True) -> Column:
    """An entry page has no previous page; ``empty_is_entry`` also counts ``''`` (jump and session)."""
    c = F.col(last_page_id) if isinstance(last_page_id, str) else last_page_id
    flag = c.isNull() | (c == "") if empty_is_entry else c.isNull()
    return F.coalesce(flag, F.lit(False))


def keyword_pages(page: DataFrame, page_id: str = "good_list", keep: tuple[str, ...] = ()) -> DataFrame:
    """Search pages that carry a search text; returns ``fullword, ts`` (and ``keep``)."""
    return page.where((F.col("page.page_id") == page_id) & F.col("page.item").isNotNull()) \
        .select(F.col("page.item").alias("fullword"), "ts", *keep)


def flatten_log(log: DataFrame) -> DataFrame:
    """Nested fields as top-level columns (for sinks and checks), with ``offset`` where the log has it."""
    return log.select(
        *(["offset"] if "offset" in log.columns else []),
        F.col("common.mid").alias("mid"), F.col("common.vc").alias("vc"), F.col("common.ch").alias("ch"),
        F.col("common.ar").alias("ar"), F.col("common.is_new").alias("is_new"),
        is_start(log).alias("is_start"),
        F.col("page.page_id").alias("page_id"), F.col("page.last_page_id").alias("last_page_id"),
        F.col("page.item").alias("item"), F.col("page.during_time").alias("during_time"),
        F.coalesce(F.size("displays"), F.lit(-1)).alias("n_displays"),
        "ts",
    )
