"""Registration of queries over trades, each with its DuckDB counterpart.

Results are rounded so that the order of sums doesn't show, and times are returned without a zone.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradebars.plans import sql
from tradebars.plans.fixtures import from_events

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
METRICS = ", ".join(["symbol", "time", sql.ROUNDED])


#: Added before rounding, so that sums in another order don't fall to either side of a tie.
_NUDGE = {4: 1e-7, 6: 1e-9}


def ready(df: DataFrame, digits: int = 4) -> DataFrame:
    """Rounded doubles, times without a zone, whole numbers as bigint."""
    columns = []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DoubleType):
            c = F.round(c + _NUDGE[digits], digits)
        elif isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        elif isinstance(f.dataType, T.IntegerType):
            c = c.cast("bigint")
        columns.append(c.alias(f.name))
    return df.select(*columns)


def query(name: str, oracle: str, source: Callable = from_events, digits: int = 4):
    """Register a function of trades."""

    def keep(f: Callable[[DataFrame], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: ready(f(source(spark, sf_dir)), digits)
        SQL[name] = re.sub(r", ([46])\) AS", lambda m: f" + {_NUDGE[int(m[1])]:g}, {m[1]}) AS", oracle)
        return f

    return keep
