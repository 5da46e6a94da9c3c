"""The shop's SQL-text entry (A3, A4, A6 with lateral table joins) as Spark SQL over temp views.

The DataFrame jobs and these statements produce the same rows; Catalyst gives both the same plans.
Window bounds are printed from the window's epoch milliseconds on the UTC wall clock, so the text
does not depend on the session zone.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, SparkSession

from storelens.functions.text import KEYWORD_PATTERN
from storelens.operators import joins
from storelens.plans import jobs
from storelens.sources import adapters as ad
from storelens.sources.tables import Tables


def _view(df: DataFrame, stem: str) -> str:
    name = f"{stem}_{uuid.uuid4().hex[:8]}"
    df.createOrReplaceTempView(name)
    return name


def _fmt(col: str) -> str:
    return ("substring(CAST(timestampadd(MILLISECOND, unix_millis(" + col +
            "), TIMESTAMP_NTZ '1970-01-01 00:00:00') AS STRING), 1, 19)")


def _as_of_ms(as_of: str) -> str:
    stamp = _dt.datetime.strptime(as_of, "%Y-%m-%d %H:%M:%S").replace(tzinfo=_dt.timezone.utc)
    return f"CAST({int(stamp.timestamp() * 1000)} AS BIGINT)"


#: U1, U2 as SQL table functions, under the names that the shop's statements call.
TABLE_FUNCTIONS = (
    f"""CREATE OR REPLACE TEMPORARY FUNCTION ik_analyze(text STRING) RETURNS TABLE (word STRING)
        RETURN SELECT explode(regexp_extract_all(lower(text), r'{KEYWORD_PATTERN}', 0))""",
    """CREATE OR REPLACE TEMPORARY FUNCTION keywordProductC2R(click BIGINT, cart BIGINT, orders BIGINT)
        RETURNS TABLE (ct BIGINT, source STRING)
        RETURN SELECT u.ct, u.source FROM (SELECT explode(filter(array(
          named_struct('ct', click, 'source', 'CLICK'), named_struct('ct', cart, 'source', 'CART'),
          named_struct('ct', orders, 'source', 'ORDER')), x -> x.ct > 0)) AS u)""",
)


def create_table_functions(spark: SparkSession) -> None:
    """Register the table functions in the session. They are SQL text, inlined where they are called: a ``LATERAL`` call
    becomes a plain ``Generate`` of the JVM, also on streams."""
    for text in TABLE_FUNCTIONS:
        spark.sql(text)


def province_stats_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3 as SQL text: ``COUNT(DISTINCT order_id)`` and ``sum`` per province and 10 s window."""
    t = Tables(spark, sf_dir)
    wide = joins.lookup(jobs.order_wide_core(t), ad.dim_province(t), {"province_id": "id"},
                        {"name": "province_name", "area_code": "province_area_code",
                         "iso_code": "province_iso_code", "iso_3166_2": "province_3166_2_code"})
    v = _view(wide, "order_wide")
    return spark.sql(f"""
        SELECT {_fmt('window.start')} AS stt, {_fmt('window.end')} AS edt,
               province_id, province_name, province_area_code AS area_code, province_iso_code AS iso_code,
               province_3166_2_code AS iso_3166_2,
               CAST(sum(split_total_amount) AS DECIMAL(28,2)) AS order_amount,
               count(DISTINCT order_id) AS order_count, {_as_of_ms(jobs.AS_OF)} AS ts
        FROM {v}
        GROUP BY window(timestamp_millis(create_ts), '{jobs.WINDOW}'), province_id, province_name,
                 province_area_code, province_iso_code, province_3166_2_code""")


#: P11 + J7 + A4: ``{rows}`` has ``page`` and ``rowtime``.
KEYWORD_STATS = """
        WITH fullword AS (
          SELECT page.item AS fullword, rowtime FROM {rows}
          WHERE page.page_id = 'good_list' AND page.item IS NOT NULL)
        SELECT k.word AS keyword, count(*) AS ct, 'SEARCH' AS source, {stt} AS stt, {edt} AS edt, {ts} AS ts
        FROM fullword, LATERAL ik_analyze(fullword) AS k
        GROUP BY window(rowtime, '{window}'), k.word"""


def keyword_stats_text(rows: str, window: str, as_of: str) -> str:
    return KEYWORD_STATS.format(rows=rows, window=window, stt=_fmt("window.start"), edt=_fmt("window.end"), ts=_as_of_ms(as_of))


def keyword_stats_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P11 + U1 + A4 as SQL text: filter, lateral call of the token function, windowed count."""
    create_table_functions(spark)
    pages = jobs.page_records(Tables(spark, sf_dir)).selectExpr("page", "timestamp_millis(ts) AS rowtime")
    return spark.sql(keyword_stats_text(_view(pages, "page_view"), jobs.WINDOW, jobs.AS_OF))


def keyword_actions_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A6 as SQL text: two chained lateral calls (name tokens, then the positive action counts)."""
    create_table_functions(spark)
    v = _view(jobs.q_product_stats(spark, sf_dir), "product_stats")
    return spark.sql(f"""
        SELECT k.word AS keyword, a.ct, a.source, stt, edt, {_as_of_ms(jobs.AS_OF)} AS ts
        FROM {v}, LATERAL ik_analyze(spu_name) AS k, LATERAL keywordProductC2R(click_ct, cart_ct, order_ct) AS a""")


SQL_QUERIES = {
    "province_stats_sql": province_stats_sql,
    "keyword_stats_sql": keyword_stats_sql,
    "keyword_actions_sql": keyword_actions_sql,
}


def create_topic_table(spark: SparkSession, name: str, path: str, columns: str, fmt: str = "json") -> DataFrame:
    """S2 in SQL: a topic folder declared as a catalogue table with its columns, as the shop's DDL does with a
    connector. Statements and ``spark.readStream.table`` can name it; dropping it leaves the files. ``columns`` is a DDL
    column list of the records, e.g. ``"offset BIGINT, value STRING"``; columns that folders are named by (``kind=page``)
    come after them by themselves and are not listed. Returns the table for batch reading."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING {fmt} LOCATION '{path}'")
    return spark.table(name)
