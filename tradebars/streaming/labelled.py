"""A stream of trades that builds its own thresholds, and hands over each month's bars once the month is closed.

State lies in a folder whose manifest names it, one state a batch, so a batch that fails is done again from the state before
it and one that is repeated changes nothing:

- `samples`: the least-hash sample of each day, merged from the samples of the batches. A day is closed once the newest time
  less `delay` has passed its end; days of the look-back before the open ones are kept, earlier ones let go.
- `waiting`: trades whose thresholds aren't known yet, since a day before theirs is open, or since they are of a symbol's
  first date, whose first trades give the bootstrap. These are the trades of the last `delay` and of first dates.
- `limits`: thresholds of all days so far, a row for each symbol and day, for trades that come late too. Those are labelled
  and counted as any others, but change no sample of a closed day; on a closed day that had no trade they take the defaults.
- `parts`: partial bars of hours in open months, in few folders; `months`: those of closed months, each written when the
  month closes and amended where hours come later.

All of it is distributed over a batch's rows: no symbol or day is gathered in one task.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tradebars.functions.schema import TRADES
from tradebars.functions.tables import written
from tradebars.functions.trades import month_of
from tradebars.operators import bars as B
from tradebars.operators import thresholds as H
from tradebars.streaming.hourly import Batches

_DAY = ["symbol", "date"]
_SAMPLES = "symbol string, date date, agg_id bigint, qty double"
_LIMITS = "symbol string, date date, p99 double, p999 double, source string"
_STATE = ("samples", "waiting", "limits", "parts", "months")


class LabelledStream:
    """The stream's state under a folder, and what can be read of it."""

    def __init__(self, spark: SparkSession, path: str, delay: dt.timedelta = dt.timedelta(hours=2), window: int = H.WINDOW_DAYS, capacity: int = H.CAPACITY, bootstrap_n: int = H.BOOTSTRAP_TRADES):
        self.spark, self.path, self.batches = spark, path, Batches(spark, path)
        self.delay, self.window, self.capacity, self.bootstrap_n = delay, window, capacity, bootstrap_n

    # What readers take

    def state(self) -> dict:
        return self.batches.snapshots.current()

    def _table(self, state: dict, name: str, schema) -> DataFrame:
        at = state.get(name)
        return self.spark.read.schema(schema).parquet(f"{self.path}/{at}") if at else self.spark.createDataFrame([], schema)

    def limits(self) -> DataFrame:
        """(symbol, date, p99, p999, source) of the days so far."""
        return self._table(self.state(), "limits", _LIMITS)

    def bars(self, state: dict | None = None) -> DataFrame | None:
        """Finished bars of all labelled trades so far; None before there are any."""
        state = self.state() if state is None else state
        at = [e["at"] for e in state.get("parts", [])] + [m["at"] for m in state.get("months", {}).values()]
        return B.finish(B.merge_bars(self.spark.read.parquet(*[f"{self.path}/{x}" for x in at]))) if at else None

    def month(self, month: str) -> DataFrame | None:
        """A closed month's bars; None while it is open."""
        held = self.state().get("months", {}).get(month)
        return B.finish(self.spark.read.parquet(f"{self.path}/{held['at']}")) if held else None

    def flushed(self) -> dict[str, int]:
        """Closed months, and how often each was written: once, and again for hours that came later."""
        return {m: v["times"] for m, v in self.state().get("months", {}).items()}

    def progress(self) -> dict:
        """Hours in open months, hours in closed ones, first and last date, and the trades that wait."""
        state = self.state()
        return state.get("progress", {"n_pending": 0, "n_finalized": 0, "first_date": None, "last_date": None, "n_waiting": 0})

    # What a batch does

    def write(self, trades: DataFrame) -> DataStreamWriter:
        return trades.writeStream.foreachBatch(self.take)

    def close(self) -> None:
        """The stream is over: all days and months are closed."""
        self._advance(self.spark.createDataFrame([], TRADES), None, dt.datetime.max)

    def take(self, batch: DataFrame, number: int) -> None:
        if number > self.state().get("batch", -1):
            batch = written(batch.select(*TRADES.names))
            newest = batch.agg(F.max(F.date_format("time", "yyyy-MM-dd HH:mm:ss"))).first()[0]
            before = self.state().get("newest")
            newest = max(x for x in (newest, before, "") if x is not None)
            low = dt.datetime.fromisoformat(newest) - self.delay if newest else dt.datetime.min
            self._advance(batch, number, low, newest)

    def _advance(self, batch: DataFrame, number: int | None, low: dt.datetime, newest: str = "") -> None:
        """Take a batch in; days and months that end by `low` are closed from now on."""
        state = self.state()
        was = dt.date.fromisoformat(state.get("open", "0001-01-01"))  # the earliest open day before and now
        now = max(was, low.date())
        closed_before, closed = F.lit(was.isoformat()).cast("date"), F.lit(now.isoformat()).cast("date")
        number = state.get("batch", -1) + 1 if number is None else number
        fresh = H.dated(batch).where(F.col("date") >= closed_before)
        samples = H.daily_sample(fresh.select(*TRADES.names), self.capacity)
        samples = written(H.merge_samples(self._table(state, "samples", _SAMPLES), samples, self.capacity))
        known = self._table(state, "limits", _LIMITS)
        waiting = H.dated(self._table(state, "waiting", TRADES).unionByName(batch))
        firsts = samples.groupBy("symbol").agg(F.min("date").alias("first"))
        firsts = written(firsts.join(known.select("symbol").distinct(), "symbol", "left_anti"))  # of symbols without thresholds so far
        marked = waiting.join(firsts, "symbol", "left")
        # A first date must be closed itself, other days need those before them closed.
        ready = F.when(F.col("date") == F.col("first"), F.col("date") < closed).otherwise(F.col("date") <= closed)
        marked = written(marked.withColumn("ready", ready))
        labelled, rest = marked.where("ready").select(*TRADES.names), marked.where("not ready").select(*TRADES.names)
        # The day that follows the closed ones has its thresholds too, whatever of it is still to come.
        days = samples.select(*_DAY).distinct().where(F.col("date") <= closed).join(firsts, "symbol", "left")
        days = days.where((F.col("first").isNull()) | (F.col("date") > F.col("first")) | (F.col("date") < closed)).select(*_DAY)
        days = days.join(known.select(*_DAY), _DAY, "left_anti")
        early = H.bootstrap(labelled.join(firsts.select("symbol"), "symbol", "left_semi"), self.bootstrap_n)
        # Of the day that is still open nobody asks a pool that holds it.
        values = samples.select(*_DAY, "qty", F.lit(1).cast("bigint").alias("freq"))
        limits = written(known.unionByName(H.limits_of(values, days, early, self.window)))
        entries = self.batches.put(B.partial_bars(H.classify(labelled, limits)), number, state.get("parts", []))
        content = {"batch": number, "newest": newest or state.get("newest"), "open": now.isoformat(), "parts": entries, "months": state.get("months", {})}
        content |= self._kept(samples, limits, rest, closed)
        content |= self._flush(content, low)
        content["progress"] = self._progress(content)
        self.batches.snapshots.commit(content)
        self.batches.snapshots.vacuum(list(_STATE))

    def _put(self, rows: DataFrame, table: str) -> str:
        at = self.batches.snapshots.new_path(table)
        rows.write.parquet(f"{self.path}/{at}")
        return at

    def _kept(self, samples: DataFrame, limits: DataFrame, waiting: DataFrame, closed) -> dict[str, str]:
        """Samples of open days and of the look-back before them, all limits, and the trades that wait."""
        newest = Window.partitionBy("symbol").orderBy(F.desc("date"))
        days = samples.select(*_DAY).distinct().withColumn("shut", F.col("date") < closed)
        rank = F.sum(F.col("shut").cast("int")).over(newest)
        days = written(days.withColumn("rank", rank).where(~F.col("shut") | (F.col("rank") <= self.window)).select(*_DAY))
        return {"samples": self._put(samples.join(days, _DAY, "left_semi"), "samples"), "limits": self._put(limits, "limits"), "waiting": self._put(waiting, "waiting")}

    def _flush(self, state: dict, low: dt.datetime) -> dict:
        """Move the hours of closed months to their months: at once where a month closes, and where more of one comes later."""
        parts = self.spark.read.parquet(*[f"{self.path}/{e['at']}" for e in state["parts"]])
        until = f"{low:%Y-%m}"
        found = sorted(r.month for r in parts.select(month_of().alias("month")).distinct().collect() if r.month < until)
        if not found:
            return {}
        months = dict(state["months"])
        merged = written(B.merge_bars(parts))
        for m in found:
            mine, old = merged.where(month_of() == m), months.get(m)
            if old:
                mine = B.merge_bars(mine, self.spark.read.parquet(f"{self.path}/{old['at']}"))
            months[m] = {"at": self._put(mine.orderBy("symbol", "time"), "months"), "times": (old["times"] if old else 0) + 1}
        at = self._put(merged.where(month_of() >= until), "parts")
        return {"months": months, "parts": [{"since": state["parts"][0]["since"], "upto": state["parts"][-1]["upto"], "at": at}]}

    def _progress(self, state: dict) -> dict:
        hours = lambda at: self.spark.read.parquet(*[f"{self.path}/{x}" for x in at]).select("symbol", "time").distinct() if at else None
        pending, closed = hours([e["at"] for e in state["parts"]]), hours([m["at"] for m in state["months"].values()])
        both = pending if closed is None else pending.unionByName(closed)
        low, high = both.agg(F.min(F.to_date("time")).cast("string"), F.max(F.to_date("time")).cast("string")).first()
        waiting = self._table(state, "waiting", TRADES).count()
        return {"n_pending": pending.count(), "n_finalized": closed.count() if closed is not None else 0, "first_date": low, "last_date": high, "n_waiting": waiting}
