"""Live progress of a stream of hourly bars: a listener that takes what each batch has observed, without a job of its own."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

_TRADES, _BARS = "trades_in", "bars_out"


def observed_trades(trades: DataFrame) -> DataFrame:
    """The stream, with the number of trades and their first and last time observed in each batch."""
    return trades.observe(_TRADES, F.count("*").alias("n"), F.min("time").alias("low"), F.max("time").alias("high"))


def observed_bars(bars: DataFrame) -> DataFrame:
    """The stream of closed hours, with their number observed in each batch."""
    return bars.observe(_BARS, F.count("*").alias("n"))


class LiveProgress(StreamingQueryListener):
    """Counts while a stream of `observed_trades` into `observed_bars` runs: hours still open, hours closed, trades, first and
    last date. Open hours are the rows of the aggregation's state."""

    def __init__(self, name: str | None = None):
        self._name, self._lock = name, threading.Lock()
        self._batches: dict[tuple[str, int], dict] = {}
        self.ended = threading.Event()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.set()

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if self._name is not None and p.name != self._name:
            return
        seen, made = p.observedMetrics.get(_TRADES), p.observedMetrics.get(_BARS)
        with self._lock:  # a batch that is repeated counts once
            self._batches[str(p.id), p.batchId] = {
                "trades": seen.n if seen else 0, "low": seen.low if seen else None, "high": seen.high if seen else None,
                "closed": made.n if made else 0, "open": sum(s.numRowsTotal for s in p.stateOperators),
            }

    def current(self) -> dict:
        """{n_pending, n_finalized, n_trades, first_date, last_date} up to the last batch."""
        with self._lock:
            batches = [self._batches[k] for k in sorted(self._batches)]
        lows, highs = [b["low"] for b in batches if b["low"]], [b["high"] for b in batches if b["high"]]
        return {
            "n_pending": batches[-1]["open"] if batches else 0, "n_finalized": sum(b["closed"] for b in batches), "n_trades": sum(b["trades"] for b in batches),
            "first_date": min(lows).date() if lows else None, "last_date": max(highs).date() if highs else None,
        }
