"""The hourly aggregation on Structured Streaming."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tradebars.functions.snapshots import Snapshots
from tradebars.operators.bars import bar_sums, finish, merge_bars, partial_bars, with_flags
from tradebars.operators.thresholds import classify

#: Folders of one level that become one of the next.
FAN = 4


def stream_partial_bars(trades: DataFrame, delay: str = "2 hours", limits: DataFrame | None = None) -> DataFrame:
    """Hour state of a stream of trades; hours close when the watermark passes them, later trades are dropped.

    With `limits`, a static table of thresholds by symbol and date, trades are classified first.
    """
    timed = trades.withWatermark("time", delay)
    flagged = classify(timed, limits) if limits is not None else with_flags(timed)
    hours = flagged.groupBy("symbol", F.window("time", "1 hour").alias("hour")).agg(*bar_sums())
    return hours.withColumn("time", F.col("hour.start")).drop("hour")


def stream_bars(trades: DataFrame, delay: str = "2 hours", limits: DataFrame | None = None) -> DataFrame:
    return finish(stream_partial_bars(trades, delay, limits))


class Batches:
    """Partial bars of a stream's batches in few folders, which a manifest names.

    Each batch is a folder of its own at first. Whenever `FAN` neighbours of one level are there they become one of the next,
    so that n batches leave some FAN * log(n) folders, and every bar is merged as often as there are levels. The newest batch
    stays apart, since a stream that failed may repeat it.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.snapshots = spark, path, Snapshots(spark, path)

    def entries(self) -> list[dict]:
        """{since, upto, at} of each folder, in order."""
        return self.snapshots.current().get("parts", [])

    def _read(self, entries: list[dict]) -> DataFrame:
        return self.spark.read.parquet(*[f"{self.path}/{e['at']}" for e in entries])

    def _merged(self, entries: list[dict]) -> dict:
        at = self.snapshots.new_path("parts")
        merge_bars(self._read(entries)).write.parquet(f"{self.path}/{at}")
        return {"since": entries[0]["since"], "upto": entries[-1]["upto"], "at": at}

    def put(self, parts: DataFrame, number: int, entries: list[dict] | None = None) -> list[dict]:
        """The entries with a batch's partial bars, once it is written; a repeated batch takes the place of its first try."""
        at = self.snapshots.new_path("parts")
        parts.write.parquet(f"{self.path}/{at}")
        entries = [e for e in (self.entries() if entries is None else entries) if e["upto"] < number]
        level = lambda e: math.floor(math.log(e["upto"] - e["since"] + 1, FAN) + 1e-9)
        while len(entries) >= FAN and len({level(e) for e in entries[-FAN:]}) == 1:
            entries = [*entries[:-FAN], self._merged(entries[-FAN:])]
        return [*entries, {"since": number, "upto": number, "at": at}]

    def keep(self, parts: DataFrame, number: int) -> None:
        self.snapshots.commit({"parts": self.put(parts, number)})
        self.snapshots.vacuum(["parts"])

    def compact(self) -> None:
        """Merge all batches but the newest into one folder."""
        entries = self.entries()
        if len(entries) > 2:
            self.snapshots.commit({"parts": [self._merged(entries[:-1]), entries[-1]]})
            self.snapshots.vacuum(["parts"])

    def bars(self) -> DataFrame:
        """The finished bars of everything seen so far."""
        return finish(merge_bars(self._read(self.entries())))


def upsert_batches(trades: DataFrame, path: str, limits: DataFrame | None = None) -> DataStreamWriter:
    """Every batch's partial bars are kept by batch, so nothing is late and a repeated batch replaces itself.

    `Batches(spark, path).bars()` merges them at any time.
    """

    def keep(batch: DataFrame, number: int) -> None:
        flagged = classify(batch, limits) if limits is not None else batch
        Batches(batch.sparkSession, path).keep(partial_bars(flagged), number)

    return trades.writeStream.foreachBatch(keep)


def each_batch(trades: DataFrame, callback: Callable[[DataFrame, int], None]) -> DataStreamWriter:
    """Hand every batch of trades to a callback."""
    return trades.writeStream.foreachBatch(callback)
