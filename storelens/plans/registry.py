"""All registered jobs: DataFrame jobs, their SQL-text forms, and the streaming chains."""

from __future__ import annotations

from storelens.plans.jobs import QUERIES as DATAFRAME_JOBS
from storelens.plans.sql import SQL_QUERIES
from storelens.streaming.run import STREAM_QUERIES

BATCH = {**DATAFRAME_JOBS, **SQL_QUERIES}
STREAMS = dict(STREAM_QUERIES)
ALL = {**BATCH, **STREAMS}
