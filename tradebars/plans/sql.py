"""DuckDB SQL of the operators, written from their meaning and not from their Spark form."""

from __future__ import annotations

from tradebars.functions.schema import COUNTS, METRICS
from tradebars.plans.fixtures import BUSY_SQL, EVENTS_SQL, LINEITEM_SQL, SPARSE_SQL, STRETCHED_SQL

#: Parameters of the registered queries: small enough that every branch is met at 10,000 events.
WINDOW, CAPACITY, BOOTSTRAP, MIN_TRADES, MAX_GAP, WARMUP = 7, 20, 65, 12, 1, 168

_R = lambda c, n=4: f"round({c}, {n}) AS {c}"
ROUNDED = ", ".join(m if m in COUNTS else _R(m) for m in METRICS)


def _sums() -> str:
    out = ["coalesce(sum(CASE WHEN NOT is_buyer_maker THEN qty END), 0) AS buy_vol", "coalesce(sum(CASE WHEN is_buyer_maker THEN qty END), 0) AS sell_vol", "count(*) AS n_trades"]
    out += ["count(*) FILTER (NOT is_buyer_maker) AS buy_count", "count(*) FILTER (is_buyer_maker) AS sell_count"]
    for p in ("p99", "p999"):
        for side, c in (("buy", "NOT is_buyer_maker"), ("sell", "is_buyer_maker")):
            out += [f"coalesce(sum(CASE WHEN qty >= {p} AND {c} THEN qty END), 0) AS whale_{side}_vol_{p}", f"count(*) FILTER (qty >= {p} AND {c}) AS whale_{side}_count_{p}"]
    out += ["coalesce(sum(CASE WHEN minute(time) < 30 THEN qty END), 0) AS vol_first_30min", "coalesce(sum(CASE WHEN minute(time) >= 30 THEN qty END), 0) AS vol_last_30min"]
    out += ["coalesce(sum(CASE WHEN NOT is_buyer_maker THEN price * qty END), 0) AS buy_vol_usd", "coalesce(sum(CASE WHEN is_buyer_maker THEN price * qty END), 0) AS sell_vol_usd"]
    return ", ".join([*out, "greatest(0.0, max(qty)) AS max_trade_size", "sum(price * qty) AS pq", "sum(qty) AS q", "sum(price * price * qty) AS ppq"])


def trades(source: str = "events") -> str:
    return f"t AS ({ {'events': EVENTS_SQL, 'lineitem': LINEITEM_SQL, 'stretched': STRETCHED_SQL, 'sparse': SPARSE_SQL, 'busy': BUSY_SQL}[source]})"


def limits(capacity: int | None = CAPACITY, bootstrap: int = BOOTSTRAP, window: int = WINDOW) -> str:
    pick = f"WHERE r <= {capacity}" if capacity else ""
    return f"""
days AS (SELECT DISTINCT symbol, CAST(time AS DATE) AS date FROM t),
numbered AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY date) AS day FROM days),
sample AS (SELECT symbol, date, agg_id, qty FROM (SELECT symbol, CAST(time AS DATE) AS date, agg_id, qty,
  row_number() OVER (PARTITION BY symbol, CAST(time AS DATE) ORDER BY md5('42:' || CAST(agg_id AS VARCHAR)), qty) AS r FROM t) {pick}),
rolling AS (SELECT n.symbol, n.date, quantile_cont(v.qty, 0.99) AS p99, quantile_cont(v.qty, 0.999) AS p999
  FROM numbered n JOIN numbered p ON p.symbol = n.symbol AND p.day BETWEEN n.day - {window} AND n.day - 1 JOIN sample v ON v.symbol = p.symbol AND v.date = p.date GROUP BY 1, 2),
early AS (SELECT t.symbol, n.date, t.qty, row_number() OVER (PARTITION BY t.symbol ORDER BY t.time, t.agg_id, t.qty) AS r FROM t JOIN numbered n ON n.symbol = t.symbol AND n.day = 1 AND CAST(t.time AS DATE) = n.date),
boot AS (SELECT symbol, date, quantile_cont(qty, 0.99) AS p99, quantile_cont(qty, 0.999) AS p999 FROM early WHERE r <= {bootstrap} GROUP BY 1, 2 HAVING count(*) >= {bootstrap}),
limits AS (SELECT d.symbol, d.date, coalesce(r.p99, b.p99, 5.0) AS p99, coalesce(r.p999, b.p999, 20.0) AS p999,
  CASE WHEN r.p99 IS NOT NULL THEN 'rolling' WHEN b.p99 IS NOT NULL THEN 'bootstrap' ELSE 'default' END AS source
  FROM days d LEFT JOIN rolling r USING (symbol, date) LEFT JOIN boot b USING (symbol, date))"""


def bars(name: str = "bars", where: str = "true") -> str:
    """Finished whale bars of the trades, by the limits."""
    return f"""
{name}_sums AS (SELECT t.symbol, date_trunc('hour', time) AS time, {_sums()} FROM t JOIN limits l ON l.symbol = t.symbol AND l.date = CAST(t.time AS DATE) WHERE {where} GROUP BY 1, 2),
{name} AS (SELECT symbol, time, {", ".join(m for m in METRICS if m not in ("vwap", "price_std"))}, CASE WHEN q > 0 THEN pq / q ELSE 0.0 END AS vwap,
  CASE WHEN q > 0 THEN sqrt(greatest(0.0, ppq / q - (pq / q) * (pq / q))) ELSE 0.0 END AS price_std, pq, q, ppq FROM {name}_sums)"""


def filled(max_gap: int = MAX_GAP) -> str:
    metric = lambda m: (
        f"CASE WHEN p.time = s.time THEN p.{m} WHEN gap <= {max_gap} THEN "
        + (f"CAST(trunc(p.{m} + w * (n.{m} - p.{m})) AS BIGINT)" if m in COUNTS else f"p.{m} + w * (n.{m} - p.{m})")
        + f" ELSE 0 END AS {m}"
    )
    return f"""
hours AS (SELECT symbol, unnest(generate_series(min(time), max(time), INTERVAL 1 HOUR)) AS time FROM bars GROUP BY symbol),
placed AS (SELECT s.symbol, s.time, p.time AS prev_time, n.time AS next_time FROM hours s ASOF JOIN bars p ON s.symbol = p.symbol AND s.time >= p.time ASOF JOIN bars n ON s.symbol = n.symbol AND s.time <= n.time),
gapped AS (SELECT *, CASE WHEN prev_time < time THEN date_diff('hour', prev_time, next_time) - 1 END AS gap, CASE WHEN prev_time < time THEN date_diff('hour', prev_time, time) END AS place FROM placed),
filled AS (SELECT s.symbol, s.time, {", ".join(map(metric, METRICS))}, CASE WHEN p.time = s.time THEN 'actual' WHEN gap <= {max_gap} THEN 'interpolated' ELSE 'zero' END AS fill_kind
  FROM (SELECT *, place / (gap + 1.0::DOUBLE) AS w FROM gapped) s JOIN bars p ON p.symbol = s.symbol AND p.time = s.prev_time JOIN bars n ON n.symbol = s.symbol AND n.time = s.next_time)"""


TRIMMED = f"""
trimmed AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY time) AS _r, count(*) OVER (PARTITION BY symbol) AS _n FROM filled) WHERE _r > {WARMUP} OR _n <= {WARMUP})"""

VERDICT = f"""
steps AS (SELECT symbol, time, lag(time) OVER (PARTITION BY symbol ORDER BY time) AS prev FROM (SELECT DISTINCT symbol, time FROM bars)),
gaps AS (SELECT symbol, prev + INTERVAL 1 HOUR AS start, time - INTERVAL 1 HOUR AS "end", date_diff('hour', prev, time) - 1 AS duration_hours FROM steps WHERE time > prev + INTERVAL 1 HOUR),
report AS (SELECT b.symbol, date_diff('hour', min(time), max(time)) + 1 AS n_expected, count(DISTINCT time) AS n_hours, date_diff('hour', min(time), max(time)) + 1 - count(DISTINCT time) AS n_missing,
  count(*) - count(DISTINCT time) AS n_duplicates, (SELECT count(*) FROM gaps g WHERE g.symbol = b.symbol) AS n_gaps, count(*) FILTER (n_trades < {MIN_TRADES}) AS n_low_activity FROM bars b GROUP BY b.symbol),
verdict AS (SELECT *, n_missing = 0 AND n_duplicates = 0 AS is_valid, concat_ws('; ', CASE WHEN n_duplicates > 0 THEN n_duplicates || ' duplicate hours' END, CASE WHEN n_missing > 0 THEN n_missing || ' missing hours' END,
  CASE WHEN n_low_activity > 0 THEN n_low_activity || ' hours with low activity' END) AS issues FROM report)"""


def say(select: str, *ctes: str, source: str = "events") -> str:
    return f"WITH {', '.join([trades(source), *ctes])} {select}"


def whale(select: str, *more: str, source: str = "events") -> str:
    return say(select, limits(), bars(), *more, source=source)
