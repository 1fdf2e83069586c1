"""Months: which to do, and building them one at a time from stored state with the same result as all at once."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradebars.functions.schema import BARS
from tradebars.functions.snapshots import Snapshots
from tradebars.functions.tables import written
from tradebars.functions.trades import between, month_of
from tradebars.operators.bars import hourly_bars
from tradebars.operators.thresholds import BOOTSTRAP_TRADES, CAPACITY, WINDOW_DAYS, classify, day_values, thresholds

_PARTS = ["symbol", "month"]
#: Of the stored tables.
VERSION = 2
_MARKS = "symbol string, month string, n_dates int, stale boolean, last_update timestamp"
_BOOTSTRAP = "symbol string, date date, p99 double, p999 double"


def months(spark: SparkSession, start: str, end: str) -> DataFrame:
    """(month) from start to end, both YYYY-MM and included; an end before the start is an error."""
    first, last = (dt.date.fromisoformat(f"{m}-01") for m in (start, end))
    if first > last:
        raise ValueError(f"the end month {end} is before the start month {start}")
    whole = F.explode(F.sequence(F.lit(first), F.lit(last), F.expr("interval 1 month")))
    return spark.range(1).select(whole.alias("day")).select(F.date_format("day", "yyyy-MM").alias("month"))


def pending(wanted: DataFrame, completed: DataFrame) -> DataFrame:
    """Wanted (symbol, month) rows that are not completed."""
    return wanted.join(completed.select(*_PARTS), _PARTS, "left_anti")


def month_bounds(month: str) -> tuple[dt.datetime, dt.datetime]:
    first = dt.datetime.fromisoformat(f"{month}-01")
    return first, dt.datetime(first.year + first.month // 12, first.month % 12 + 1, 1)


def bars_of_month(bars: DataFrame, month: str) -> DataFrame:
    """By a half-open range of time, which the scan can prune."""
    return between(bars, *month_bounds(month))


def union_bars(*parts: DataFrame) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


class Store:
    """The tables of an incremental build under one folder: bars and day values by month, marks of completed months with the
    number of their dates, and bootstrap thresholds with their date.

    A manifest names the data of each state, so readers see all of a build or nothing of it, and one that dies between two
    writes leaves the state before. Data of another version counts as none, and a build starts afresh.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self.snapshots = spark, folder, Snapshots(spark, folder)

    def _state(self) -> dict:
        state = self.snapshots.current()
        return state if state.get("version") == VERSION else {"version": VERSION, "months": {}}

    def _read(self, paths: list[str], schema: str | T.StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*[f"{self.folder}/{p}" for p in paths]) if paths else self.spark.createDataFrame([], schema)

    def _months(self, table: str, schema: str | T.StructType, wanted: Callable[[str], bool]) -> DataFrame:
        return self._read([v[table] for m, v in sorted(self._state()["months"].items()) if wanted(m)], schema)

    def bars(self, start: str = "", end: str = "~") -> DataFrame:
        """Bars, with their month, of completed months of the range; only their files are looked at."""
        rows = self._months("bars", BARS, lambda m: start <= m <= end).withColumn("month", month_of())
        return rows.join(self.completed(), _PARTS, "left_semi")

    def values(self, months: list[str] | None = None) -> DataFrame:
        """(symbol, date, qty, freq, month), also of months whose bars are stale."""
        return self._months("values", "symbol string, date date, qty double, freq bigint", lambda m: months is None or m in months).withColumn("month", month_of("date"))

    def bootstrap(self) -> DataFrame:
        """(symbol, date, p99, p999)"""
        return self._read([p for p in [self._state().get("bootstrap")] if p], _BOOTSTRAP)

    def marks(self) -> DataFrame:
        """(symbol, month, n_dates, stale, last_update) of every month that was built; stale ones are to be built again."""
        return self._read([p for p in [self._state().get("marks")] if p], _MARKS)

    def completed(self) -> DataFrame:
        return self.marks().where("not stale").select(*_PARTS)

    def stale(self) -> DataFrame:
        return self.marks().where("stale").select(*_PARTS)

    def save(self, bars: DataFrame, values: DataFrame, limits: DataFrame, window: int = WINDOW_DAYS) -> None:
        """Take over the bars and values(symbol, date, qty, freq) of some months, in place of what there is of the same symbols
        and months. A month that is new makes those later ones stale whose first dates look back into it."""
        state = self._state()
        values = written(values.withColumn("month", month_of("date")))
        done = written(values.groupBy(*_PARTS).agg(F.count_distinct("date").cast("int").alias("n_dates")))
        months = sorted(r.month for r in done.select("month").distinct().collect())
        if not months:
            return
        new: dict[str, str] = {}
        for table, rows in (("bars", bars.withColumn("month", month_of())), ("values", values)):
            again = [m for m in months if m in state["months"]]
            if again:  # other symbols of these months stay
                old = (self._months("bars", BARS, again.__contains__).withColumn("month", month_of()) if table == "bars" else self.values(again)).select(*rows.columns)
                rows = rows.unionByName(old.join(F.broadcast(done) if _fits(done) else done, _PARTS, "left_anti"))
            new[table] = self.snapshots.new_path(table)
            rows.write.partitionBy("month").parquet(f"{self.folder}/{new[table]}")
        old = self.marks()
        fresh = done.join(old.select(*_PARTS), _PARTS, "left_anti").select(*_PARTS, F.lit(True).alias("fresh"))
        now = done.select(*_PARTS, "n_dates", F.lit(False).alias("stale"), F.current_timestamp().alias("last_update"))
        rest = old.join(done.select(*_PARTS), _PARTS, "left_anti")
        marks = self.snapshots.new_path("marks")
        _stale_after(now.unionByName(rest).join(fresh, _PARTS, "left"), done.select(*_PARTS), window).coalesce(1).write.parquet(f"{self.folder}/{marks}")
        first = limits.where("source = 'bootstrap'").select("symbol", "date", "p99", "p999")
        kept = self.bootstrap().withColumn("month", month_of("date")).join(done.select(*_PARTS), _PARTS, "left_anti").drop("month")
        bootstrap = self.snapshots.new_path("bootstrap")
        first.unionByName(kept).coalesce(1).write.parquet(f"{self.folder}/{bootstrap}")
        named = {m: {t: f"{new[t]}/month={m}" for t in new} for m in months}
        self.snapshots.commit({"version": VERSION, "months": state["months"] | named, "marks": marks, "bootstrap": bootstrap})
        self.snapshots.vacuum(["marks", "bootstrap"])


def _fits(rows: DataFrame) -> bool:
    return rows.count() <= 1 << 16


def _stale_after(marks: DataFrame, done: DataFrame, window: int) -> DataFrame:
    """The marks, where those with fewer than `window` dates between themselves and a fresh month before become stale."""
    by = Window.partitionBy("symbol").orderBy("month")
    upto = F.sum("n_dates").over(by)
    rows = marks.withColumn("upto", upto).join(done.withColumn("built", F.lit(True)), _PARTS, "left")
    last = F.last(F.when(F.col("fresh"), F.col("upto")), ignorenulls=True).over(by.rowsBetween(Window.unboundedPreceding, -1))
    late = F.coalesce(F.col("upto") - F.col("n_dates") - last < window, F.lit(False)) & F.col("built").isNull()
    return rows.withColumn("late", late).select(*_PARTS, "n_dates", (F.col("stale") | F.col("late")).alias("stale"), "last_update")


def prior_values(store: Store, month: str, window: int = WINDOW_DAYS) -> DataFrame:
    """Stored day values of each symbol's last `window` present dates before a month; marks tell which months hold these."""
    by = Window.partitionBy("symbol").orderBy(F.desc("month")).rowsBetween(Window.unboundedPreceding, -1)
    near = store.marks().where(F.col("month") < month).withColumn("after", F.coalesce(F.sum("n_dates").over(by), F.lit(0))).where(F.col("after") < window).select(*_PARTS)
    read = sorted(r.month for r in near.select("month").distinct().collect())
    old = store.values(read).join(near, _PARTS, "left_semi")
    newest = old.select("symbol", "date").distinct().withColumn("rank", F.row_number().over(Window.partitionBy("symbol").orderBy(F.desc("date"))))
    return old.join(newest.where(F.col("rank") <= window).select("symbol", "date"), ["symbol", "date"]).select("symbol", "date", "qty", "freq")


def build_months(store: Store, trades: DataFrame, first: str, last: str, window: int = WINDOW_DAYS, capacity: int | None = CAPACITY, bootstrap_n: int = BOOTSTRAP_TRADES, symbols: DataFrame | None = None) -> None:
    """Build the trades of adjacent months, of all symbols or those given, with the thresholds of the stored days before them,
    and save them in one step. The trades are scanned once for the day values and once for the bars."""
    low, high = month_bounds(first)[0], month_bounds(last)[1]
    mine = between(trades, low, high)
    if symbols is not None:
        mine = mine.join(symbols.select("symbol"), "symbol", "left_semi")
    values = written(day_values(mine, capacity))
    before = store.bootstrap().where(F.col("date") < F.lit(low.date())).select("symbol", "p99", "p999")
    limits = thresholds(mine, window, capacity, bootstrap_n, prior_values(store, first, window), before, values)
    summed = values.groupBy("symbol", "date", "qty").agg(F.sum("freq").alias("freq"))
    store.save(hourly_bars(classify(mine, limits)), summed, limits, window)


def build_month(store: Store, trades: DataFrame, month: str, **parameters) -> None:
    build_months(store, trades, month, month, **parameters)


def _runs(left: DataFrame, together: int) -> list[tuple[str, str]]:
    """First and last month of each run of adjacent months that the same symbols lack, `together` of them at most."""
    sets = left.groupBy("month").agg(F.bit_xor(F.xxhash64("symbol")).alias("mark"), F.count("*").alias("n")).orderBy("month").collect()
    runs: list[tuple[str, str]] = []
    size = 0
    for before, r in zip([None, *sets], sets, strict=False):
        joins = before is not None and month_bounds(before.month)[1] == month_bounds(r.month)[0] and (before.mark, before.n) == (r.mark, r.n) and size < together
        if joins:
            runs[-1], size = (runs[-1][0], r.month), size + 1
        else:
            runs.append((r.month, r.month))
            size = 1
    return runs


def resume(store: Store, trades: DataFrame, start: str, end: str, together: int = 12, **parameters) -> DataFrame:
    """Build the pending months of the range in order, of the symbols that lack them, and return the range's bars; with none
    pending only read them.

    Months may come in any order: those later ones that a new month makes stale are built again, as far as the trades reach,
    and are pending until then.
    """
    months(store.spark, start, end)  # an error where they are the wrong way round
    present = lambda low, high: between(trades, month_bounds(low)[0], month_bounds(high)[1]).select("symbol", month_of().alias("month")).distinct()
    left = written(pending(present(start, end), store.completed()))
    while True:
        for first, last in _runs(left, together):
            build_months(store, trades, first, last, symbols=left.where(F.col("month") == first), **parameters)
        ends = store.stale().agg(F.min("month"), F.max("month")).first()
        if ends[0] is None or left.isEmpty():
            break
        left = written(present(*ends).join(store.stale(), _PARTS, "left_semi"))
    return store.bars(start, end).drop("month")
