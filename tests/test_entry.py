"""The driver contract: entry() runs, every query has check SQL, and the batch jobs equal DuckDB."""

import decimal
import importlib.util
import os

import duckdb
import pytest

from conftest import ROOT
from storelens.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def _entry():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    m = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(m)
    return m


def test_entry_runs(spark):
    df = _entry().entry(spark)
    assert df.count() > 0
    assert df.columns == ["stt", "edt", "province_id", "province_name", "area_code", "iso_code", "iso_3166_2",
                          "order_amount", "order_count", "ts"]


def test_every_query_has_sql():
    m = _entry()
    assert set(registry.ALL) <= set(m.queries()) and set(registry.ALL) <= set(m.oracle_sql())
    assert set(m.oracle_sql()) <= set(m.queries())


def _norm(v):
    if isinstance(v, decimal.Decimal):
        return str(v.normalize())
    return repr(v)


BATCH = [n for n in registry.ALL if not n.endswith("_stream")]


@pytest.mark.parametrize("name", BATCH)
def test_batch_job_equals_sql(spark, name):
    m = _entry()
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = m.queries()[name](spark, SF)
    res = con.execute(m.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    scols = sorted(df.columns)
    srows = sorted(tuple(_norm(r[c]) for c in scols) for r in df.collect())
    idx = [dcols.index(c) for c in scols]
    drows = sorted(tuple(_norm(r[i]) for i in idx) for r in res.fetchall())
    assert srows == drows


def test_command_line_lists_every_job(capsys):
    from storelens.__main__ import main
    assert main(["list"]) == 0
    out = capsys.readouterr().out
    names = set(out.replace("batch:", " ").replace("stream:", " ").split())
    assert names == set(registry.ALL)
