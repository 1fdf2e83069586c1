"""The composed jobs, with a command line: full build, incremental build and quality report.

    python -m tradebars.plans.jobs build TRADES OUT
    python -m tradebars.plans.jobs resume TRADES STORE --start 2024-01 --end 2024-03
    python -m tradebars.plans.jobs report BARS

TRADES is Parquet of trades, or CSV or zip archives by the ending of the path.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from tradebars.functions.schema import utc
from tradebars.functions.tables import clear, written
from tradebars.operators import bars as B
from tradebars.operators import incremental as I
from tradebars.operators import quality as Q
from tradebars.operators import thresholds as H
from tradebars.sources import files


def build(trades: DataFrame, window: int = H.WINDOW_DAYS, capacity: int | None = H.CAPACITY, bootstrap_n: int = H.BOOTSTRAP_TRADES, max_gap: int = Q.MAX_GAP_HOURS, warmup: int = Q.WARMUP_HOURS) -> DataFrame:
    """Trades to labelled hourly bars, filled and trimmed.

    The trades are scanned twice, by pruned columns: for the thresholds and for the bars, and again only where the first
    trades of each symbol are. The shuffles carry what tasks have summed or sampled beforehand, not trades. The bars are
    written once: they are tiny against the trades, and filling uses them twice.
    """
    bars = written(B.hourly_bars(H.classify(trades, H.thresholds(trades, window, capacity, bootstrap_n))))
    return Q.trim_warmup(Q.fill_gaps(bars, max_gap), warmup)


def report(bars: DataFrame, min_trades: int = Q.MIN_TRADES) -> DataFrame:
    return Q.verdict(bars, min_trades)


def load(spark: SparkSession, path: str, symbol: str | None = None) -> DataFrame:
    if path.endswith(".zip"):
        return files.parse_trades(files.read_zipped_lines(spark, path), symbol)
    if path.endswith(".csv"):
        return files.parse_trades(files.read_lines(spark, path), symbol)
    return files.read_trades(spark, path)


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("job", choices=["build", "resume", "report"])
    parser.add_argument("source")
    parser.add_argument("target", nargs="?")
    parser.add_argument("--start")
    parser.add_argument("--end")
    parser.add_argument("--symbol", help="of CSV files whose names tell none")
    given = parser.parse_args(arguments)
    spark = utc(SparkSession.builder.getOrCreate())
    if given.job == "build":
        files.write_bars(build(load(spark, given.source, given.symbol)), given.target)
    elif given.job == "resume":
        bars = I.resume(I.Store(spark, given.target), load(spark, given.source, given.symbol), given.start, given.end)
        report(bars).show(truncate=False)
    else:
        report(spark.read.parquet(given.source)).show(truncate=False)
    clear(spark)


if __name__ == "__main__":
    main()
