"""Sources and sinks: trade CSV (plain or zipped), bars as Parquet or JSON, and threshold state."""

from __future__ import annotations

import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradebars.functions.schema import BARS, BOOTSTRAP, METRICS, SAMPLES, SHORT_BARS, TRADES
from tradebars.functions.tables import exists
from tradebars.functions.trades import epoch_to_time, month_of
from tradebars.sources import archives

_INTEGER = r"^[+-]?[0-9]{1,19}$"
_FLOAT = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"
#: The file-name form of monthly archives, which may also be folders of parts, and white space around lines.
FILE_NAME = r"([^/=]+)-aggTrades-([0-9]{4}-[0-9]{2})\.(?:csv|zip)(?:/[^/]*)?$"
BLANKS = " \t\r\n\x0b\x0c\x85\xa0"


def _file() -> Column:
    return F.col("_metadata.file_path")


def read_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(line, path) of text files, which Spark splits as it likes: no line depends on its place in the file."""
    return spark.read.text(paths).select(F.col("value").alias("line"), _file().alias("path"))


def _unzip(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for frame in frames:
        for path, content in zip(*(frame.column(k).to_pylist() for k in (0, 1)), strict=True):
            yield from archives.lines_of(io.BytesIO(content), path)


def read_zipped_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(line, path) of the first entry of each archive, read in place by the tasks; archives in a store that only Spark opens
    are read as binary rows, which bounds them to 2 GB each."""
    if archives.opened(paths):
        return archives.read(spark, paths)
    return unzip_lines(spark.read.format("binaryFile").load(paths))


def unzip_lines(files: DataFrame) -> DataFrame:
    """(line, path) of archives(path, content), where they are: an archive is read in blocks of lines."""
    return files.select("path", "content").mapInArrow(_unzip, archives.SCHEMA)


def _symbol(symbol: str | None) -> Column:
    """The symbol in the file's name, or else the one given."""
    return F.coalesce(F.nullif(F.regexp_extract("path", FILE_NAME, 1), F.lit("")), F.lit(symbol).cast("string"))


def _judged(lines: DataFrame, symbol: str | None) -> DataFrame:
    trimmed = F.btrim("line", F.lit(BLANKS))
    rows = lines.where(trimmed != "").withColumn("parts", F.split(trimmed, ",", -1))
    part = lambda i: F.get("parts", F.lit(i))
    whole = lambda i: part(i).rlike(_INTEGER) & part(i).try_cast("bigint").isNotNull()
    number = lambda i: part(i).rlike(_FLOAT) & (F.abs(part(i).try_cast("double")) < float("inf"))
    reason = (
        F.when(F.size("parts") < 7, "columns")
        .when(~F.coalesce(whole(0), F.lit(False)), "agg_id")
        .when(~F.coalesce(number(1), F.lit(False)), "price")
        .when(~F.coalesce(number(2), F.lit(False)), "qty")
        .when(~F.coalesce(whole(5), F.lit(False)), "time")
        .when(_symbol(symbol).isNull(), "symbol")
    )
    return rows.withColumn("reason", reason)


def _trades(good: DataFrame, symbol: str | None) -> DataFrame:
    part = lambda i: F.get("parts", F.lit(i))
    return good.select(
        _symbol(symbol).alias("symbol"), part(0).try_cast("bigint").alias("agg_id"), epoch_to_time(part(5).try_cast("bigint")).alias("time"),
        part(1).try_cast("double").alias("price"), part(2).try_cast("double").alias("qty"), (F.lower(part(6)) == "true").alias("is_buyer_maker"),
    )


def parse_trades(lines: DataFrame, symbol: str | None = None) -> DataFrame:
    """Trades of the good lines; a header is a line like any other whose agg_id is no integer.

    `symbol` is that of files whose names tell none; without it their lines are rejected.
    """
    return _trades(_judged(lines, symbol).where("reason is null"), symbol)


#: Why a line gives no trade.
REASONS = ("columns", "agg_id", "price", "qty", "time", "symbol")


class ParseCounts:
    """How many lines a parse read, how many gave trades, and how many were rejected for each reason; known once the trades
    have been computed, without a pass of their own."""

    def __init__(self, observation: Observation):
        self._observation = observation

    @property
    def all(self) -> dict[str, int]:
        return dict(self._observation.get)

    @property
    def trades(self) -> int:
        return self.all["n_trades"]


def parse_counted(lines: DataFrame, symbol: str | None = None) -> tuple[DataFrame, ParseCounts]:
    """The trades, as `parse_trades` gives them, and their counts: of the first action over them, which must read all."""
    counts = Observation()
    reason = F.col("reason")
    judged = _judged(lines, symbol).observe(counts, F.count("*").alias("n_lines"), F.count_if(reason.isNull()).alias("n_trades"), *[F.count_if(reason == r).alias(f"n_{r}") for r in REASONS])
    return _trades(judged.where("reason is null"), symbol), ParseCounts(counts)


def rejected_lines(lines: DataFrame, symbol: str | None = None) -> DataFrame:
    """(path, line, reason); headers are among them, by reason agg_id."""
    return _judged(lines, symbol).where("reason is not null").select("path", "line", "reason")


def count_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return spark.read.text(paths).groupBy(_file().alias("path")).agg(F.count("*").alias("n_lines"))


def discover_months(spark: SparkSession, folder: str) -> DataFrame:
    """(symbol, months, first_month, last_month) by the names of the files, without reading them."""
    names = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path", "length")
    found = names.select(F.regexp_extract("path", FILE_NAME, 1).alias("symbol"), F.regexp_extract("path", FILE_NAME, 2).alias("month")).where("month != ''").distinct()
    return found.groupBy("symbol").agg(F.sort_array(F.collect_list("month")).alias("months"), F.min("month").alias("first_month"), F.max("month").alias("last_month"))


def write_bars(bars: DataFrame, path: str) -> None:
    """Sorted within files by symbol and time, a folder a symbol, timestamps in milliseconds."""
    conf, name = bars.sparkSession.conf, "spark.sql.parquet.outputTimestampType"
    before = conf.get(name, None)
    conf.set(name, "TIMESTAMP_MILLIS")
    try:
        bars.repartitionByRange("symbol", "time").sortWithinPartitions("symbol", "time").write.mode("overwrite").partitionBy("symbol").parquet(path)
    finally:
        conf.unset(name) if before is None else conf.set(name, before)


def parquet_stats(spark: SparkSession, path: str) -> DataFrame:
    """(n_rows, n_bytes) of a Parquet output."""
    files = spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("n"), F.max(F.col("_metadata.file_size")).alias("size"))
    return files.agg(F.sum("n").alias("n_rows"), F.sum("size").alias("n_bytes"))


def write_month_json(bars: DataFrame, path: str) -> None:
    """One JSON array with short keys for each symbol and month, of at most 744 bars, sorted by time."""
    short = F.struct(F.unix_timestamp("time").alias("t"), *[F.col(m).alias(k) for m, k in METRICS.items()])
    arrays = bars.groupBy("symbol", month_of().alias("month")).agg(F.to_json(F.array_sort(F.collect_list(short))).alias("value"))
    arrays.repartition("symbol", "month").write.mode("overwrite").partitionBy("symbol", "month").text(path)


def read_month_json(spark: SparkSession, path: str) -> DataFrame:
    """Bars of all months; broken files give nothing, nor does a path that isn't there."""
    if not exists(spark, path):
        return spark.createDataFrame([], BARS)
    schema = T.StructType([*SHORT_BARS, *[T.StructField(c, T.StringType()) for c in ("_corrupt_record", "symbol", "month")]])
    rows = spark.read.schema(schema).option("multiLine", True).json(path)
    good = rows.where("_corrupt_record is null and t is not null")
    return good.select("symbol", F.timestamp_seconds("t").alias("time"), *[F.col(k).alias(m) for m, k in METRICS.items()])


def write_samples(sample: DataFrame, counts: DataFrame, path: str) -> None:
    """Threshold state: the sampled quantities and the number of trades of each day."""
    held = sample.groupBy("symbol", "date").agg(F.sort_array(F.collect_list("qty")).alias("samples"))
    held.join(counts, ["symbol", "date"]).select(*SAMPLES.names).write.mode("overwrite").parquet(path)


def read_samples(spark: SparkSession, path: str) -> DataFrame:
    """Stored day values (symbol, date, qty, freq), as thresholds take them for earlier dates."""
    return spark.read.schema(SAMPLES).parquet(path).select("symbol", "date", F.explode("samples").alias("qty"), F.lit(1).cast("bigint").alias("freq"))


def write_bootstrap(limits: DataFrame, path: str) -> None:
    """The bootstrap record of each symbol: from limits(symbol, date, p99, p999, source), whether there is one, and its thresholds."""
    mine = F.col("source") == "bootstrap"
    rows = limits.groupBy("symbol").agg(*[F.max(F.when(mine, F.col(p))).alias(p) for p in ("p99", "p999")], F.bool_or(mine).alias("bootstrapped"))
    rows.select(*BOOTSTRAP.names).write.mode("overwrite").parquet(path)


def read_bootstrap(spark: SparkSession, path: str) -> DataFrame:
    """(symbol, p99, p999) of the symbols that are bootstrapped."""
    return spark.read.schema(BOOTSTRAP).parquet(path).where("bootstrapped").drop("bootstrapped")


def read_trades(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TRADES).parquet(path)
