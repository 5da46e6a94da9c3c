"""DuckDB SQL that recomputes each registered job from the raw tables, written independently of the
Spark plans (window functions where Spark uses aggregates, direct rules where Spark uses structs).

Views ``region nation customer supplier part orders lineitem events documents ...`` are registered by
the checker. Money is DECIMAL, times are epoch ms (truncated, ``epoch_us // 1000``), window bounds are
formatted from epoch microseconds, so nothing depends on a time zone.
"""

from __future__ import annotations

AS_OF_MS = 1735689600000        # 2025-01-01 00:00:00 UTC, the jobs' fixed stamp
TOKEN = r"[\p{L}\p{N}]+"       # letters and digits of any alphabet
AS_OF_DATE = "DATE '2025-01-01'"


def _fmt(us_expr: str) -> str:
    return f"strftime(make_timestamp({us_expr}), '%Y-%m-%d %H:%M:%S')"


def _win(ms: str, size_ms: int = 10_000) -> tuple[str, str]:
    start = f"(({ms}) // {size_ms}) * {size_ms}"
    return _fmt(f"({start}) * 1000"), _fmt(f"(({start}) + {size_ms}) * 1000")


MONEY = "DECIMAL(18,2)"
SPLIT = f"CAST(ROUND(CAST(l_extendedprice AS {MONEY}) * (1 - CAST(l_discount AS {MONEY})), 2) AS {MONEY})"

# ---------------------------------------------------------------------------------- shared CTEs

EV = """ev AS (
  SELECT e.*, CAST(json_extract_string(e.props, '$.k') AS INTEGER) AS k, epoch_us(e.ts) // 1000 AS ts_ms
  FROM events e)"""

LOG = EV + """,
log AS (
  SELECT ev.event_id AS "offset", CAST(ev.user_id AS VARCHAR) AS mid,
         'v' || CAST(k % 3 AS VARCHAR) AS vc, 'c' || CAST(k % 4 AS VARCHAR) AS ch,
         'a' || CAST(ev.user_id % 5 AS VARCHAR) AS ar,
         CASE WHEN k < 50 THEN '1' ELSE '0' END AS is_new,
         ev.event_type = 'signup' AS is_start,
         CASE ev.event_type WHEN 'click' THEN 'good_detail' WHEN 'view' THEN 'good_list'
                            WHEN 'purchase' THEN 'trade' WHEN 'error' THEN 'error' END AS page_id,
         CASE WHEN ev.event_type = 'signup' OR k % 4 = 0 THEN NULL ELSE 'home' END AS last_page_id,
         CASE WHEN ev.event_type = 'click' THEN CAST(k AS VARCHAR) WHEN ev.event_type = 'view' THEN p.p_name END AS item,
         CASE WHEN ev.event_type <> 'signup' THEN CAST(floor(ev.value * 1000) AS BIGINT) END AS during_time,
         CASE WHEN ev.event_type = 'view' THEN k % 3 ELSE -1 END AS n_displays,
         ev.ts_ms AS ts, strftime(ev.ts, '%Y%m%d') AS day, k, ev.event_type
  FROM ev LEFT JOIN part p ON ev.event_type = 'view' AND p.p_partkey = ev.k)"""

# T1 over the whole log, then the page records.
PAGES = LOG + """,
first_new AS (SELECT mid, min(day) AS first_day FROM log WHERE is_new = '1' GROUP BY mid),
rlog AS (
  SELECT log.* REPLACE (CASE WHEN log.is_new = '1' AND log.day <> f.first_day THEN '0' ELSE log.is_new END AS is_new)
  FROM log LEFT JOIN first_new f USING (mid)),
pages AS (SELECT * FROM rlog WHERE NOT is_start)"""


def _jumps(within_ms: int, name: str = "jumps") -> str:
    return f""",
{name}_n AS (
  SELECT *, lead(ts) OVER (PARTITION BY mid ORDER BY ts, "offset") AS nxt FROM pages),
{name} AS (
  SELECT * FROM {name}_n
  WHERE (last_page_id IS NULL OR last_page_id = '') AND (nxt IS NULL OR nxt - ts >= {within_ms}))"""


UV = """,
uv AS (
  SELECT * FROM pages WHERE last_page_id IS NULL
  QUALIFY row_number() OVER (PARTITION BY mid, day ORDER BY ts, "offset") = 1)"""

ORDER_INFO = """oi AS (
  SELECT o.o_orderkey AS id, CAST(c.c_nationkey AS BIGINT) AS province_id, o.o_custkey AS user_id,
         o.o_orderstatus AS order_status, CAST(o.o_totalprice AS DECIMAL(18,2)) AS total_amount,
         strftime(o.o_orderdate, '%Y-%m-%d %H:%M:%S') AS create_time, epoch_us(o.o_orderdate) // 1000 AS create_ts
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey)"""


# Record fields that no table of the driver carries.
NO_MONEY = ("activity_reduce_amount", "coupon_reduce_amount", "original_total_amount", "feight_fee", "split_feight_fee",
            "split_activity_amount", "split_coupon_amount")
NO_TEXT = ("expire_time", "operate_time")
NO_SOURCE = "".join(f"CAST(NULL AS DECIMAL(18,2)) AS {c}, " for c in NO_MONEY) + "".join(
    f"CAST(NULL AS VARCHAR) AS {c}, " for c in NO_TEXT)


def _order_wide_core(timing: str = "offset") -> str:
    if timing == "offset":
        line_ts = "epoch_us(o.o_orderdate + to_microseconds((l.l_linenumber - 4) * 2500)) // 1000"
        src = "lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"
        lo, hi = -5, 5
    else:
        line_ts = "epoch_us(l.l_shipdate) // 1000"
        src = "lineitem l"
        lo, hi = 0, 30 * 86_400_000
    return ORDER_INFO + f""",
od AS (
  SELECT l.l_orderkey * 16 + l.l_linenumber AS detail_id, l.l_orderkey AS order_id, l.l_partkey AS sku_id,
         CAST(l.l_quantity AS BIGINT) AS sku_num, CAST(l.l_extendedprice AS DECIMAL(18,2)) AS order_price,
         {SPLIT} AS split_total_amount, {line_ts} AS line_ts
  FROM {src}),
ow AS (
  SELECT od.detail_id, od.order_id, oi.user_id, od.sku_id, od.sku_num, od.order_price, od.split_total_amount,
         oi.province_id, oi.order_status, oi.total_amount, oi.create_time, oi.create_ts, {NO_SOURCE}
         substr(oi.create_time, 1, 10) AS create_date, substr(oi.create_time, 12, 2) AS create_hour
  FROM oi JOIN od ON oi.id = od.order_id AND od.line_ts BETWEEN oi.create_ts + ({lo}) AND oi.create_ts + ({hi}))"""


def _md5id(col: str) -> str:
    return f"CAST(('0x' || substr(md5({col}), 1, 15)) AS BIGINT)"


PROVINCE = """prov AS (
  SELECT CAST(n.n_nationkey AS BIGINT) AS id, n.n_name AS name, r.r_name AS area_code,
         upper(substr(n.n_name, 1, 3)) AS iso_code,
         upper(substr(n.n_name, 1, 2)) || '-' || CAST(n.n_nationkey AS VARCHAR) AS iso_3166_2
  FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey)"""

PRODUCT = f"""prod AS (
  SELECT p_partkey AS id, p_name AS sku_name, CAST(p_retailprice AS DECIMAL(18,2)) AS price,
         {_md5id('p_type')} AS spu_id, p_type AS spu_name, {_md5id('p_brand')} AS tm_id, p_brand AS tm_name,
         CAST(p_size AS BIGINT) AS category3_id, 'category ' || CAST(p_size AS VARCHAR) AS category3_name
  FROM part)"""

USER = """usr AS (
  SELECT c_custkey AS id,
         strftime(DATE '1950-01-01' + CAST(c_custkey % 18000 AS INTEGER), '%Y-%m-%d') AS birthday,
         CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender, CAST(c_nationkey AS BIGINT) AS nation_id
  FROM customer)"""

OWE = _order_wide_core("offset") + ",\n" + PROVINCE + ",\n" + PRODUCT + ",\n" + USER + f""",
owe AS (
  SELECT ow.*,
         CAST(floor(date_diff('day', CAST(usr.birthday AS DATE), {AS_OF_DATE}) / 365) AS INTEGER) AS user_age,
         usr.gender AS user_gender,
         prov.name AS province_name, prov.area_code AS province_area_code, prov.iso_code AS province_iso_code,
         prov.iso_3166_2 AS province_3166_2_code,
         prod.sku_name, prod.spu_id, prod.tm_id, prod.category3_id, prod.spu_name, prod.tm_name, prod.category3_name
  FROM ow LEFT JOIN usr ON ow.user_id = usr.id LEFT JOIN prov ON ow.province_id = prov.id
          LEFT JOIN prod ON ow.sku_id = prod.id)"""

PAYMENT = """pay AS (
  SELECT o_orderkey AS payment_id, o_orderkey AS order_id, o_custkey AS user_id,
         CAST(o_totalprice AS DECIMAL(18,2)) AS total_amount,
         CASE o_orderkey % 3 WHEN 0 THEN '1101' WHEN 1 THEN '1102' ELSE '1103' END AS payment_type,
         strftime(o_orderdate + to_minutes(CAST(o_orderkey % 60 AS BIGINT)), '%Y-%m-%d %H:%M:%S') AS payment_create_time,
         strftime(o_orderdate + to_minutes(CAST(o_orderkey % 60 AS BIGINT)), '%Y-%m-%d %H:%M:%S') AS callback_time,
         epoch_us(o_orderdate + to_minutes(CAST(o_orderkey % 60 AS BIGINT))) // 1000 AS callback_ts,
         CAST(NULL AS VARCHAR) AS subject
  FROM orders WHERE o_orderstatus = 'F')"""

PWIDE = OWE + ",\n" + PAYMENT + f""",
pw AS (
  SELECT pay.*, owe.detail_id, owe.sku_id, owe.sku_num, owe.order_price, owe.split_total_amount, owe.province_id,
         owe.order_status, owe.create_time AS order_create_time, owe.create_ts AS order_create_ts,
         owe.user_age, owe.user_gender, owe.province_name, owe.province_area_code, owe.province_iso_code,
         owe.province_3166_2_code, owe.sku_name, owe.spu_id, owe.tm_id, owe.category3_id, owe.spu_name,
         owe.tm_name, owe.category3_name, owe.create_date, owe.create_hour, {", ".join(f"owe.{c}" for c in (*NO_MONEY, *NO_TEXT))}
  FROM pay JOIN owe ON pay.order_id = owe.order_id
   AND owe.create_ts BETWEEN pay.callback_ts - 1800000 AND pay.callback_ts)"""



_PE_COLS = ("display_ct", "click_ct", "favor_ct", "cart_ct", "order_sku_num", "comment_ct", "good_comment_ct",
            "order_amount", "payment_amount", "refund_amount", "id_kind", "id_value")


def _pe(sku: str, ts: str, **set_: str) -> str:
    def default(c: str) -> str:
        if c.endswith("_amount"):
            return "CAST(0 AS DECIMAL(18,2))"
        return {"id_kind": "CAST(NULL AS VARCHAR)", "id_value": "CAST(NULL AS BIGINT)"}.get(c, "0")
    cols = ", ".join(f"{set_.get(c, default(c))} AS {c}" for c in _PE_COLS)
    return f"SELECT CAST({sku} AS BIGINT) AS sku_id, {ts} AS ts, {cols}"


def _product_events() -> str:
    cnt = "(SELECT count(*) FROM part)"
    sec = lambda c: f"epoch_us(date_trunc('second', {c})) // 1000"
    parse = lambda c: f"epoch_us(strptime({c}, '%Y-%m-%d %H:%M:%S')) // 1000"
    return PWIDE + f""",
pe0 AS (
  {_pe('item', 'ts', click_ct='1')} FROM log WHERE NOT is_start AND page_id = 'good_detail'
  UNION ALL
  {_pe('k', 'ts', display_ct='1')} FROM log WHERE event_type = 'view' AND k % 3 >= 1
  UNION ALL
  {_pe('sku_id', parse('create_time'), order_sku_num='sku_num', order_amount='split_total_amount',
       id_kind="'order'", id_value='order_id')} FROM owe
  UNION ALL
  {_pe('sku_id', parse('payment_create_time'), payment_amount='split_total_amount',
       id_kind="'paid'", id_value='order_id')} FROM pw
  UNION ALL
  {_pe('event_id % ' + cnt, sec('ts'), favor_ct='1')} FROM events WHERE event_type = 'signup'
  UNION ALL
  {_pe('event_id % ' + cnt, sec('ts'), cart_ct='1')} FROM events WHERE event_type = 'purchase'
  UNION ALL
  {_pe('l_partkey', sec('l_shipdate'), refund_amount=SPLIT, id_kind="'refund'", id_value='l_orderkey')}
  FROM lineitem WHERE l_returnflag = 'R'
  UNION ALL
  {_pe('event_id % ' + cnt, sec('ts'), comment_ct='1', good_comment_ct='CASE WHEN k < 50 THEN 1 ELSE 0 END')}
  FROM ev WHERE event_type = 'view'),
ps0 AS (
  SELECT ts // 10000 * 10000 AS wstart, sku_id,
         sum(display_ct) AS display_ct, sum(click_ct) AS click_ct, sum(favor_ct) AS favor_ct, sum(cart_ct) AS cart_ct,
         sum(order_sku_num) AS order_sku_num, CAST(sum(order_amount) AS DECIMAL(28,2)) AS order_amount,
         count(DISTINCT CASE WHEN id_kind = 'order' THEN id_value END) AS order_ct,
         CAST(sum(payment_amount) AS DECIMAL(28,2)) AS payment_amount,
         count(DISTINCT CASE WHEN id_kind = 'paid' THEN id_value END) AS paid_order_ct,
         count(DISTINCT CASE WHEN id_kind = 'refund' THEN id_value END) AS refund_order_ct,
         CAST(sum(refund_amount) AS DECIMAL(28,2)) AS refund_amount,
         sum(comment_ct) AS comment_ct, sum(good_comment_ct) AS good_comment_ct
  FROM pe0 GROUP BY 1, 2),
ps AS (
  SELECT {_fmt('wstart * 1000')} AS stt, {_fmt('(wstart + 10000) * 1000')} AS edt, ps0.sku_id,
         prod.sku_name, prod.price AS sku_price, prod.spu_id, prod.spu_name, prod.tm_id, prod.tm_name,
         prod.category3_id, prod.category3_name,
         CAST(display_ct AS BIGINT) AS display_ct, CAST(click_ct AS BIGINT) AS click_ct,
         CAST(favor_ct AS BIGINT) AS favor_ct, CAST(cart_ct AS BIGINT) AS cart_ct,
         CAST(order_sku_num AS BIGINT) AS order_sku_num, order_amount, order_ct, payment_amount, paid_order_ct,
         refund_order_ct, refund_amount, CAST(comment_ct AS BIGINT) AS comment_ct,
         CAST(good_comment_ct AS BIGINT) AS good_comment_ct, {AS_OF_MS} AS ts
  FROM ps0 LEFT JOIN prod ON ps0.sku_id = prod.id)"""


def _with(ctes: str, body: str) -> str:
    return f"WITH {ctes}\n{body}"


def oracle_sql() -> dict[str, str]:
    return _with_sql_forms(_oracle_sql())


def _oracle_sql() -> dict[str, str | None]:
    stt, edt = _win("create_ts")
    province = _with(_order_wide_core("offset") + ",\n" + PROVINCE, f"""
SELECT {stt} AS stt, {edt} AS edt, ow.province_id, prov.name AS province_name, prov.area_code,
       prov.iso_code, prov.iso_3166_2, CAST(sum(ow.split_total_amount) AS DECIMAL(28,2)) AS order_amount,
       count(DISTINCT ow.order_id) AS order_count, {AS_OF_MS} AS ts
FROM ow LEFT JOIN prov ON ow.province_id = prov.id
GROUP BY 1, 2, 3, 4, 5, 6, 7""")

    wstt, wedt = _win("ts")
    visitor = _with(PAGES + UV + _jumps(10_000) + """,
ve AS (
  SELECT vc, ch, ar, is_new, 0 AS uv_ct, 1 AS pv_ct, 0 AS sv_ct, 0 AS uj_ct, coalesce(during_time, 0) AS dur_sum, ts FROM pages
  UNION ALL SELECT vc, ch, ar, is_new, 0, 0, 1, 0, 0, ts FROM pages WHERE last_page_id IS NULL OR last_page_id = ''
  UNION ALL SELECT vc, ch, ar, is_new, 1, 0, 0, 0, 0, ts FROM uv
  UNION ALL SELECT vc, ch, ar, is_new, 0, 0, 0, 1, 0, ts FROM jumps)""", f"""
SELECT {wstt} AS stt, {wedt} AS edt, vc, ch, ar, is_new,
       CAST(sum(uv_ct) AS BIGINT) AS uv_ct, CAST(sum(pv_ct) AS BIGINT) AS pv_ct, CAST(sum(sv_ct) AS BIGINT) AS sv_ct,
       CAST(sum(uj_ct) AS BIGINT) AS uj_ct, CAST(sum(dur_sum) AS BIGINT) AS dur_sum, min(ts) AS ts
FROM ve GROUP BY 1, 2, 3, 4, 5, 6""")

    keyword = _with(PAGES + """,
kw AS (SELECT unnest(regexp_extract_all(lower(item), '{TOKEN}')) AS keyword, ts
       FROM pages WHERE page_id = 'good_list' AND item IS NOT NULL)""", f"""
SELECT keyword, count(*) AS ct, 'SEARCH' AS source, {wstt} AS stt, {wedt} AS edt, {AS_OF_MS} AS ts
FROM kw GROUP BY keyword, 4, 5""")

    rows = 'SELECT "offset", mid, ts, is_new FROM'
    return {
        "province_stats": province,
        "order_wide": _with(OWE, "SELECT * FROM owe"),
        "order_ship_join": _with(_order_wide_core("ship"), "SELECT * FROM ow"),
        "payment_wide": _with(PWIDE, "SELECT * FROM pw"),
        "product_stats": _with(LOG + ",\n" + _product_events(), "SELECT * FROM ps"),
        "visitor_stats": visitor,
        "keyword_stats": keyword,
        "keyword_actions": _with(LOG + ",\n" + _product_events() + """,
kwa AS (SELECT unnest(regexp_extract_all(lower(spu_name), '{TOKEN}')) AS keyword, click_ct, cart_ct, order_ct, stt, edt
        FROM ps)""", f"""
SELECT keyword, click_ct AS ct, 'CLICK' AS source, stt, edt, {AS_OF_MS} AS ts FROM kwa WHERE click_ct > 0
UNION ALL SELECT keyword, cart_ct, 'CART', stt, edt, {AS_OF_MS} FROM kwa WHERE cart_ct > 0
UNION ALL SELECT keyword, order_ct, 'ORDER', stt, edt, {AS_OF_MS} FROM kwa WHERE order_ct > 0"""),
        "new_visitor_repair": _with(PAGES, f"{rows} rlog"),
        "unique_visit": _with(PAGES + UV, f"{rows} uv"),
        "user_jump": _with(PAGES + _jumps(10_000), f"{rows} jumps"),
        "user_jump_1h": _with(PAGES + _jumps(3_600_000), f"{rows} jumps"),
        "log_parse": _with(LOG, """
SELECT "offset", mid, vc, ch, ar, is_new, is_start, page_id, last_page_id, item, during_time,
       CAST(n_displays AS INTEGER) AS n_displays, ts FROM log"""),
        "log_archive": _with(LOG, """
SELECT mid, vc, ch, ar, is_new, is_start, page_id, last_page_id, item, during_time,
       CAST(n_displays AS INTEGER) AS n_displays, ts FROM log WHERE day = (SELECT max(day) FROM log)"""),
        "log_split": _with(LOG, """
SELECT CASE WHEN is_start THEN 'start' ELSE 'page' END AS stream, "offset", mid, page_id, ts FROM log"""),
        "display_explode": _with(LOG, """
SELECT 'sku_id' AS item_type, CAST(k AS VARCHAR) AS item, page_id FROM log WHERE event_type = 'view' AND k % 3 >= 1
UNION ALL
SELECT 'activity_id', CAST(k + 1 AS VARCHAR), page_id FROM log WHERE event_type = 'view' AND k % 3 = 2"""),
        "route_changes": """
SELECT 'dim' AS branch, 'dim_user_info' AS sink_table, 'customer' AS "table", 'insert' AS type,
       CAST(c_custkey AS VARCHAR) AS id, 'id,name,nation_id,segment' AS columns, c_custkey * 4 AS "offset" FROM customer
UNION ALL
SELECT 'dim', 'dim_user_info', 'customer', 'update', CAST(c_custkey AS VARCHAR), 'id,segment', c_custkey * 4 + 1
FROM customer WHERE c_custkey % 7 = 0
UNION ALL
SELECT 'dim', 'dim_user_info', 'customer', 'bootstrap-insert', CAST(c_custkey AS VARCHAR), 'id,name,nation_id,segment',
       c_custkey * 4 + 2 FROM customer WHERE c_custkey % 11 = 0
UNION ALL
SELECT 'fact', 'dwd_user_delete', 'customer', 'delete', CAST(c_custkey AS VARCHAR), 'id', c_custkey * 4 + 3
FROM customer WHERE c_custkey % 13 = 0
UNION ALL
SELECT 'dim', 'dim_sku_info', 'part', 'insert', CAST(p_partkey AS VARCHAR), 'brand,sku_id,sku_name', p_partkey * 4
FROM part""",
        "dim_upsert": """
WITH cells AS (
  SELECT CAST(c_custkey AS VARCHAR) AS pk, c_custkey * 4 AS o, CAST(c_custkey AS VARCHAR) AS id, c_name AS name,
         CAST(c_nationkey AS VARCHAR) AS nation_id, c_mktsegment AS segment FROM customer
  UNION ALL
  SELECT CAST(c_custkey AS VARCHAR), c_custkey * 4 + 1, CAST(c_custkey AS VARCHAR), NULL, NULL, lower(c_mktsegment)
  FROM customer WHERE c_custkey % 7 = 0
  UNION ALL
  SELECT CAST(c_custkey AS VARCHAR), c_custkey * 4 + 2, CAST(c_custkey AS VARCHAR), upper(c_name),
         CAST(c_nationkey AS VARCHAR), c_mktsegment FROM customer WHERE c_custkey % 11 = 0),
long AS (
  SELECT pk, o, 'ID' AS "column", id AS value FROM cells
  UNION ALL SELECT pk, o, 'NAME', name FROM cells WHERE o % 4 <> 1
  UNION ALL SELECT pk, o, 'NATION_ID', nation_id FROM cells WHERE o % 4 <> 1
  UNION ALL SELECT pk, o, 'SEGMENT', segment FROM cells)
SELECT 'DIM_USER_INFO' AS sink_table, pk, "column", arg_max(value, o) AS value FROM long GROUP BY pk, "column"
UNION ALL SELECT 'DIM_SKU_INFO', CAST(p_partkey AS VARCHAR), 'SKU_ID', CAST(p_partkey AS VARCHAR) FROM part
UNION ALL SELECT 'DIM_SKU_INFO', CAST(p_partkey AS VARCHAR), 'SKU_NAME', p_name FROM part
UNION ALL SELECT 'DIM_SKU_INFO', CAST(p_partkey AS VARCHAR), 'BRAND', p_brand FROM part
""",
        "composite_lookup": _with(ORDER_INFO + ",\n" + USER, """
SELECT oi.id, oi.user_id, oi.province_id, usr.birthday, usr.gender
FROM oi LEFT JOIN usr ON oi.user_id = usr.id AND oi.province_id = usr.nation_id"""),
        "coalesce_merge": _with(ORDER_INFO + ",\n" + PAYMENT, """
SELECT coalesce(p.order_id, oi.id) AS id, coalesce(p.user_id, oi.user_id) AS user_id,
       CASE WHEN p.order_id IS NULL THEN oi.create_time ELSE p.payment_create_time END AS create_time,
       p.payment_type, oi.province_id, oi.order_status
FROM oi FULL JOIN pay p ON oi.id = p.order_id"""),
        "token_counts": """
SELECT token, count(*) AS ct FROM (SELECT unnest(string_split(text, ',')) AS token FROM documents)
WHERE length(token) > 0 GROUP BY token""",
        **{f"{k}_sql": None for k in ("province_stats", "keyword_stats", "keyword_actions")},
        "document_keywords": """
SELECT keyword, count(*) AS ct
FROM (SELECT unnest(regexp_extract_all(lower(text), '{TOKEN}')) AS keyword FROM documents)
GROUP BY keyword""",
    }


def _with_sql_forms(sql: dict[str, str | None]) -> dict[str, str]:
    """The SQL-text jobs give the same rows as their DataFrame forms: same check SQL."""
    return {k: (v if v is not None else sql[k.removesuffix("_sql")]).replace("{TOKEN}", TOKEN) for k, v in sql.items()}
