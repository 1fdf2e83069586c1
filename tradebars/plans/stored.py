"""Registered queries of sources and sinks, incremental builds and streams.

Each writes what it reads to the shared folder first, derived from a whole table, and returns what comes back; their SQL says
what that must be without any of it.
"""

from __future__ import annotations

import io
import uuid
import zipfile

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradebars.functions.schema import SHORT_BARS
from tradebars.functions.tables import new_path, written
from tradebars.functions.trades import month_of
from tradebars.operators import bars as B
from tradebars.operators import incremental as I
from tradebars.operators import thresholds as H
from tradebars.plans import sql
from tradebars.plans.fixtures import from_stretched
from tradebars.plans.registry import METRICS, query
from tradebars.sources import archives, files
from tradebars.streaming import hourly, labelled, progress

#: Lines of an archive at most, in the query of zipped lines.
ARCHIVED = 100_000
_HEADER = "agg_trade_id,price,quantity,first_trade_id,last_trade_id,transact_time,is_buyer_maker,best_match"
_GOOD = "agg_id % 50 NOT IN (7, 8)"
_FILES = "files AS (SELECT DISTINCT symbol, strftime(time, '%Y-%m') AS month FROM t)"
_PARSED = f"SELECT symbol, agg_id, time, round(price, 4) AS price, round(qty, 4) AS qty, is_buyer_maker FROM t WHERE {_GOOD}"


def _limits(t: DataFrame) -> DataFrame:
    return written(H.thresholds(t, sql.WINDOW, sql.CAPACITY, sql.BOOTSTRAP))


def _bars(t: DataFrame) -> DataFrame:
    return B.hourly_bars(H.classify(t, _limits(t)))


def _lines(t: DataFrame) -> DataFrame:
    """(line, file) of the trades as CSV with a header each; of fifty lines one has no number in front and one too few columns."""
    flag = F.when(F.col("is_buyer_maker"), "True").otherwise("false")
    whole = F.concat_ws(",", "agg_id", "price", "qty", "agg_id", "agg_id", F.unix_micros("time"), flag, F.lit("true"))
    line = F.when(F.col("agg_id") % 50 == 7, F.concat(F.lit("x"), whole)).when(F.col("agg_id") % 50 == 8, F.concat_ws(",", "agg_id", "price", "qty")).otherwise(whole)
    file = F.concat("symbol", F.lit("-aggTrades-"), month_of(), F.lit(".csv"))
    rows = t.select(line.alias("line"), file.alias("file"), "agg_id")
    return rows.union(rows.select("file").distinct().select(F.lit(_HEADER), "file", F.lit(0).cast("bigint")))


def _folder(t: DataFrame) -> str:
    path = new_path(t.sparkSession)
    _lines(t).select("line", "file").write.partitionBy("file").text(path)
    return path


@query("s1_parse_csv", sql.say(_PARSED))
def _s1(t):
    return files.parse_trades(files.read_lines(t.sparkSession, _folder(t)))


@query("s2_header_lines", sql.say("SELECT symbol, month, CAST(1 AS BIGINT) AS n_headers FROM files", _FILES))
def _s2(t):
    rejected = files.rejected_lines(files.read_lines(t.sparkSession, _folder(t))).where(F.col("line").startswith("agg_trade_id"))
    name = lambda g: F.regexp_extract("path", files.FILE_NAME, g)
    return rejected.groupBy(name(1).alias("symbol"), name(2).alias("month")).agg(F.count("*").alias("n_headers"))


@query("s3_rejected_lines", sql.say("SELECT reason, count(*) AS n FROM (SELECT CASE WHEN agg_id % 50 = 7 THEN 'agg_id' ELSE 'columns' END AS reason FROM t WHERE agg_id % 50 IN (7, 8) UNION ALL SELECT 'agg_id' FROM files) GROUP BY 1", _FILES))
def _s3(t):
    return files.rejected_lines(files.read_lines(t.sparkSession, _folder(t))).groupBy("reason").agg(F.count("*").alias("n"))


_COUNTED = """SELECT CAST(sum(lines) AS BIGINT) AS n_lines, CAST(sum(good) AS BIGINT) AS n_trades, CAST(sum(lines - good) AS BIGINT) AS n_rejected, CAST(sum(number) AS BIGINT) AS n_agg_id, CAST(sum(short) AS BIGINT) AS n_columns
FROM (SELECT 1 AS lines, CAST(agg_id % 50 NOT IN (7, 8) AS INT) AS good, CAST(agg_id % 50 = 7 AS INT) AS number, CAST(agg_id % 50 = 8 AS INT) AS short FROM t UNION ALL SELECT 1, 0, 1, 0 FROM files)"""


@query("s1_parse_counts", sql.say(_COUNTED, _FILES))
def _s1_counts(t):
    """Counts of lines, trades and rejections of the one pass that writes the trades."""
    spark = t.sparkSession
    trades, counts = files.parse_counted(files.read_lines(spark, _folder(t)))
    trades.write.parquet(new_path(spark))
    n = counts.all
    return spark.createDataFrame([(n["n_lines"], n["n_trades"], n["n_lines"] - n["n_trades"], n["n_agg_id"], n["n_columns"])], "n_lines bigint, n_trades bigint, n_rejected bigint, n_agg_id bigint, n_columns bigint")


def _archived(t: DataFrame) -> str:
    """A folder of archives in the shared folder, one for each file and block of trades, with a second entry each."""
    path, part = new_path(t.sparkSession), F.floor(F.col("agg_id") / ARCHIVED)

    def put(lines: pd.DataFrame) -> pd.DataFrame:
        system, folder = archives.file_system(path)
        system.create_dir(folder)
        name, held = f"{folder}/{lines['part'].iloc[0]}-{lines['file'].iloc[0].replace('.csv', '.zip')}", io.BytesIO()
        with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as archive:
            archive.writestr("trades.csv", "\n".join(lines["line"]) + "\n")
            archive.writestr("other.csv", "no part of it")
        with system.open_output_stream(f"{name}.tmp") as out:
            out.write(held.getvalue())
        system.move(f"{name}.tmp", name)
        return pd.DataFrame({"name": [name]})

    _lines(t).withColumn("part", part).groupBy("file", "part").applyInPandas(put, "name string").write.format("noop").mode("overwrite").save()
    return path


@query("s4_zipped_lines", sql.say(_PARSED))
def _s4(t):
    lines = files.read_zipped_lines(t.sparkSession, f"{_archived(t)}/*.zip")
    named = lines.withColumn("path", F.regexp_replace("path", "/[0-9]+-([^/]*)$", "/$1"))
    return files.parse_trades(named)


@query("s5_discover_months", sql.say("SELECT symbol, count(*) AS n_months, min(month) AS first_month, max(month) AS last_month FROM files GROUP BY 1", _FILES, source="stretched"), source=from_stretched)
def _s5(t):
    found = files.discover_months(t.sparkSession, _folder(t))
    return found.select("symbol", F.size("months").alias("n_months"), "first_month", "last_month")


@query("s6_write_bars", sql.whale(f"SELECT {METRICS} FROM bars"))
def _s6(t):
    path = new_path(t.sparkSession)
    bars = _bars(t)
    files.write_bars(bars, path)
    return t.sparkSession.read.schema(bars.schema).parquet(path)


@query("s7_parquet_stats", sql.whale("SELECT count(*) AS n_rows, true AS has_bytes FROM bars"))
def _s7(t):
    path = new_path(t.sparkSession)
    files.write_bars(B.hourly_bars(t), path)
    return files.parquet_stats(t.sparkSession, path).select("n_rows", (F.col("n_bytes") > 0).alias("has_bytes"))


@query("s8_month_json", sql.say("SELECT symbol, strftime(time, '%Y-%m') AS month, count(*) AS n_bars, sum(n) AS n_trades, true AS sorted FROM (SELECT symbol, date_trunc('hour', time) AS time, CAST(count(*) AS INT) AS n FROM t GROUP BY 1, 2) GROUP BY 1, 2", source="stretched").replace("sum(n) AS", "CAST(sum(n) AS BIGINT) AS"), source=from_stretched)
def _s8(t):
    path = new_path(t.sparkSession)
    files.write_month_json(B.hourly_bars(t), path)
    arrays = t.sparkSession.read.text(path).select("symbol", "month", F.from_json("value", f"array<{SHORT_BARS.simpleString()}>").alias("bars"))
    total = F.aggregate("bars.nt", F.lit(0).cast("bigint"), lambda acc, x: acc + x)
    return arrays.select("symbol", "month", F.size("bars").alias("n_bars"), total.alias("n_trades"), (F.sort_array("bars.t") == F.col("bars.t")).alias("sorted"))


@query("s9_read_month_json", sql.whale(f"SELECT {METRICS} FROM bars"))
def _s9(t):
    path = new_path(t.sparkSession)
    files.write_month_json(_bars(t), path)
    return files.read_month_json(t.sparkSession, path)


@query("s10_threshold_state", sql.say("SELECT symbol, date, round(qty, 6) AS qty, p99 IS NOT NULL AS bootstrapped, round(p99, 6) AS p99, round(p999, 6) AS p999 FROM sample LEFT JOIN (SELECT symbol, p99, p999 FROM boot) USING (symbol)", sql.limits(bootstrap=60)), digits=6)
def _s10(t):
    """The state of thresholds that need 60 trades to begin with, read back: samples, and each symbol's bootstrap record."""
    spark, samples, record = t.sparkSession, new_path(t.sparkSession), new_path(t.sparkSession)
    files.write_samples(H.daily_sample(t, sql.CAPACITY), H.day_counts(t), samples)
    files.write_bootstrap(H.thresholds(t, sql.WINDOW, sql.CAPACITY, 60), record)
    held = files.read_bootstrap(spark, record).withColumn("there", F.lit(True))
    return files.read_samples(spark, samples).join(held, "symbol", "left").select("symbol", "date", "qty", F.coalesce("there", F.lit(False)).alias("bootstrapped"), "p99", "p999")


@query("s11_count_lines", sql.say("SELECT symbol, count(*) + 1 AS n_lines FROM t GROUP BY symbol, strftime(time, '%Y-%m')", source="stretched"), source=from_stretched)
def _s11(t):
    counted = files.count_lines(t.sparkSession, _folder(t))
    name = lambda g: F.regexp_extract("path", files.FILE_NAME, g)
    return counted.groupBy(name(1).alias("symbol"), name(2).alias("month")).agg(F.sum("n_lines").alias("n_lines")).drop("month")


# Incremental builds, over several months

_SIZES = {"window": sql.WINDOW, "capacity": sql.CAPACITY, "bootstrap_n": sql.BOOTSTRAP}


def _ends(t: DataFrame) -> tuple[str, str]:
    low, high = t.agg(F.min(month_of()), F.max(month_of())).first()
    return low or "1970-01", high or "1970-01"


@query("i2_resume", sql.whale(f"SELECT {METRICS} FROM bars", source="stretched"), source=from_stretched)
def _i2(t):
    """The first month, then the rest: as if built at once."""
    store, (low, high) = I.Store(t.sparkSession, new_path(t.sparkSession)), _ends(t)
    I.resume(store, t, low, low, **_SIZES)
    return I.resume(store, t, low, high, **_SIZES)


@query("i3_checkpoint", sql.say("SELECT symbol, strftime(time, '%Y-%m') AS month, CAST(1 AS BIGINT) AS n_marks, true AS stored FROM t GROUP BY 1, 2", source="stretched"), source=from_stretched)
def _i3(t):
    """Half of the symbols, then all: every month of every symbol is marked once, and its bars and day values are there."""
    store, (low, high) = I.Store(t.sparkSession, new_path(t.sparkSession)), _ends(t)
    I.resume(store, t.where(F.crc32("symbol") % 2 == 0), low, high, **_SIZES)
    I.resume(store, t, low, high, **_SIZES)
    held = store.bars().select("symbol", "month").distinct().join(store.values().select("symbol", "month").distinct(), ["symbol", "month"]).withColumn("there", F.lit(True))
    marks = store.marks().groupBy("symbol", "month").agg(F.count("*").alias("n_marks"))
    return marks.join(held, ["symbol", "month"], "left").select("symbol", "month", "n_marks", F.coalesce("there", F.lit(False)).alias("stored"))


@query("i4_nothing_pending", sql.whale(f"SELECT {METRICS} FROM bars WHERE strftime(time, '%Y-%m') = (SELECT max(strftime(time, '%Y-%m')) FROM t)", source="stretched"), source=from_stretched)
def _i4(t):
    """With all months done, those asked for are only read: the trades given are none."""
    store, (low, high) = I.Store(t.sparkSession, new_path(t.sparkSession)), _ends(t)
    I.resume(store, t, low, high, **_SIZES)
    return I.resume(store, t.limit(0), high, high, **_SIZES)


# Streams


def _streamed(t: DataFrame, files_a_batch: int | None = None, parts: int = 4) -> DataFrame:
    path = new_path(t.sparkSession)
    t.repartition(parts).write.parquet(path)
    reader = t.sparkSession.readStream.schema(t.schema)
    return (reader.option("maxFilesPerTrigger", files_a_batch) if files_a_batch else reader).parquet(path)


def _run(writer) -> None:
    writer.trigger(availableNow=True).start().awaitTermination()


def _closed(stream: DataFrame) -> DataFrame:
    """What a stream of bars in append mode has emitted once its input is done."""
    spark, path = stream.sparkSession, new_path(stream.sparkSession)
    _run(stream.writeStream.outputMode("append").format("parquet").option("path", path).option("checkpointLocation", new_path(spark)))
    return spark.read.schema(stream.schema).parquet(path)


_CLOSED = "WHERE time + INTERVAL 3 HOUR <= (SELECT max(time) FROM t)"


@query("t1_hour_state", sql.say("SELECT symbol, date_trunc('hour', time) AS time, count(*) AS n_trades, round(sum(qty), 4) AS sum_q FROM t GROUP BY 1, 2"))
def _t1(t):
    """The state of all hours after four batches, in complete mode: the last batch's table stays."""
    path = new_path(t.sparkSession)
    hours = hourly.stream_partial_bars(_streamed(t, 1)).select("symbol", "time", "n_trades", "sum_q")
    _run(hours.writeStream.outputMode("complete").foreachBatch(lambda rows, n: rows.write.mode("overwrite").parquet(path)).option("checkpointLocation", new_path(t.sparkSession)))
    return t.sparkSession.read.schema(hours.schema).parquet(path)


@query("t2_closed_hours", sql.whale(f"SELECT symbol, time, n_trades, round(vwap, 4) AS vwap, round(price_std, 4) AS price_std FROM bars {_CLOSED}"))
def _t2(t):
    """Hours that a watermark of two hours has closed."""
    return _closed(hourly.stream_bars(_streamed(t))).select("symbol", "time", "n_trades", "vwap", "price_std")


@query("t3_kept_batches", sql.whale(f"SELECT {METRICS} FROM bars"))
def _t3(t):
    """Ten batches of whale bars, kept in levels as they come, and merged."""
    spark, path = t.sparkSession, new_path(t.sparkSession)
    limits = _limits(t)
    _run(hourly.upsert_batches(_streamed(t, 1, 10), path, limits).option("checkpointLocation", new_path(spark)))
    return hourly.Batches(spark, path).bars()


def _in_order(t: DataFrame, late: Column | None = None, parts: int = 3) -> DataFrame:
    """A stream that brings the trades in parts by time, one a batch, and those that are late with the last part."""
    spark, path = t.sparkSession, new_path(t.sparkSession)
    low, high = (int(x) for x in t.agg(F.min(F.unix_micros("time")), F.max(F.unix_micros("time"))).first()) if not t.isEmpty() else (0, 1)
    place = F.least(F.lit(parts - 1), F.floor((F.unix_micros("time") - low) * parts / F.lit(high - low + 1)).cast("int"))
    placed = t.withColumn("_part", place if late is None else F.when(late, parts - 1).otherwise(place))
    for k in range(parts):  # the stream reads files in the order in which they were written
        placed.where(F.col("_part") == k).drop("_part").coalesce(1).write.parquet(f"{path}/{k}")
    return spark.readStream.schema(t.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/*")


def _labelled(t: DataFrame, stream: DataFrame) -> labelled.LabelledStream:
    """The state of a stream that has built its own thresholds, once it is over."""
    out = labelled.LabelledStream(t.sparkSession, new_path(t.sparkSession), window=sql.WINDOW, capacity=sql.CAPACITY, bootstrap_n=sql.BOOTSTRAP)
    _run(out.write(stream).option("checkpointLocation", new_path(t.sparkSession)))
    out.close()
    return out


@query("t4_own_thresholds", sql.whale(f"SELECT {METRICS} FROM bars", source="stretched"), source=from_stretched)
def _t4_own(t):
    """Bars of a stream that labels each day by the days that it has itself closed."""
    return _labelled(t, _in_order(t)).bars()


@query("a9_streamed_thresholds", sql.say("SELECT symbol, date, round(p99, 6) AS p99, round(p999, 6) AS p999, source FROM limits", sql.limits(), source="stretched"), source=from_stretched, digits=6)
def _a9_streamed(t):
    """The thresholds of the same stream, from samples that its batches have merged."""
    return _labelled(t, _in_order(t)).limits()


@query("t3_flushed_months", sql.say("SELECT symbol, strftime(time, '%Y-%m') AS month, count(DISTINCT date_trunc('hour', time)) AS n_hours, count(*) AS n_trades, round(sum(qty), 4) AS volume FROM t GROUP BY 1, 2", source="stretched"), source=from_stretched)
def _t3_months(t):
    """Each closed month's bars, where a tenth of the trades comes after its month was handed over."""
    out = _labelled(t, _in_order(t, F.pmod(F.xxhash64("agg_id"), F.lit(10)) == 3))
    months = [out.month(m).withColumn("month", F.lit(m)) for m in sorted(out.flushed())]
    bars = I.union_bars(*months).groupBy("symbol", "month")
    return bars.agg(F.count("*").alias("n_hours"), F.sum("n_trades").alias("n_trades"), F.sum(F.col("buy_vol") + F.col("sell_vol")).alias("volume"))


@query("a17_live_progress", sql.say(f"""SELECT count(*) FILTER (NOT shut) AS n_pending, count(*) FILTER (shut) AS n_finalized, CAST(sum(n) AS BIGINT) AS n_trades, CAST(min(time) AS DATE) AS first_date, (SELECT CAST(max(time) AS DATE) FROM t) AS last_date
FROM (SELECT time, n, time + INTERVAL 3 HOUR <= (SELECT max(time) FROM t) AS shut FROM (SELECT symbol, date_trunc('hour', time) AS time, count(*) AS n FROM t GROUP BY 1, 2))"""))
def _a17_live(t):
    """What a listener has counted when a stream of hourly bars ends."""
    spark, name = t.sparkSession, f"bars_{uuid.uuid4().hex}"
    live = progress.LiveProgress(name)
    spark.streams.addListener(live)
    try:
        bars = progress.observed_bars(hourly.stream_bars(progress.observed_trades(_streamed(t))))
        path = new_path(spark)
        _run(bars.writeStream.queryName(name).outputMode("append").format("parquet").option("path", path).option("checkpointLocation", new_path(spark)))
        live.ended.wait(60)
    finally:
        spark.streams.removeListener(live)
    seen = live.current()
    return spark.createDataFrame([tuple(seen.values())], "n_pending bigint, n_finalized bigint, n_trades bigint, first_date date, last_date date")


@query("t4_classified_stream", sql.whale(f"SELECT {METRICS} FROM bars {_CLOSED}"))
def _t4(t):
    return _closed(hourly.stream_bars(_streamed(t), limits=_limits(t)))


@query("t5_batch_callback", sql.say("SELECT symbol, count(*) AS n_trades, 4 AS n_batches FROM t GROUP BY 1").replace("4 AS n_batches", "CAST(4 AS BIGINT) AS n_batches"))
def _t5(t):
    """A callback that counts each batch's trades by symbol."""
    spark, path = t.sparkSession, new_path(t.sparkSession)
    _run(hourly.each_batch(_streamed(t, 1), lambda rows, n: rows.groupBy("symbol").agg(F.count("*").alias("n_trades")).withColumn("batch", F.lit(n)).write.mode("append").parquet(path)).option("checkpointLocation", new_path(spark)))
    seen = spark.read.parquet(path)
    batches = seen.agg(F.count_distinct("batch").alias("n_batches"))
    return seen.groupBy("symbol").agg(F.sum("n_trades").alias("n_trades")).withColumn("n_batches", F.lit(batches.first()[0]))
