import zipfile

from helpers import bars, many, rows_of
from pyspark.sql import functions as F

from tradebars.operators import bars as B
from tradebars.operators import thresholds as H
from tradebars.sources import files

LINES = """agg_trade_id,price,quantity,first_trade_id,last_trade_id,transact_time,is_buyer_maker,best_match
1,100.5,0.25,1,1,1704067200000,true,true

2,101.0,5.0,2,3,1704067200000000,False,True
  3,101.0,1,4,4,1000000000000000,TRUE
4,101.0,1,4
x,101.0,1,4,4,1704067200000,true
5,abc,1,4,4,1704067200000,true
6,101.0, 1,4,4,1704067200000,true
7,101.0,1,4,4,1704067200000,maybe
8,1e400,1,4,4,1704067200000,true
9,NaN,1,4,4,1704067200000,true
10,1.0d,1,4,4,1704067200000,true
11,1,1,4,4,99999999999999999999,true
"""


def test_good_and_bad_lines(spark, tmp_path):
    path = tmp_path / "BTC-aggTrades-2024-01.csv"
    path.write_text(LINES)
    lines = files.read_lines(spark, str(path))
    good = {r.agg_id: r for r in files.parse_trades(lines).select("symbol", "agg_id", F.unix_micros("time").alias("us"), "is_buyer_maker", "qty").collect()}
    assert sorted(good) == [1, 2, 3, 7] and {r.symbol for r in good.values()} == {"BTC"}
    assert good[1].us == good[2].us == 1704067200000000 and good[3].us == 10**18
    assert [good[i].is_buyer_maker for i in (1, 2, 3, 7)] == [True, False, True, False]
    reasons = sorted(r.reason for r in files.rejected_lines(lines).collect())
    assert reasons == sorted(["agg_id", "columns", "agg_id", "price", "qty", "price", "price", "price", "time"])
    assert files.count_lines(spark, str(path)).first().n_lines == 14


def test_zip_equals_plain(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "ETH-aggTrades-2024-02.zip", "w") as z:
        z.writestr("first.csv", LINES)
        z.writestr("second.csv", "99,1,1,1,1,1,true\n")
    (tmp_path / "ETH-aggTrades-2024-02.csv").write_text(LINES)
    a = files.parse_trades(files.read_zipped_lines(spark, f"{tmp_path}/*.zip")).withColumn("time", F.unix_micros("time"))
    b = files.parse_trades(files.read_lines(spark, f"{tmp_path}/*.csv")).withColumn("time", F.unix_micros("time"))
    assert rows_of(a) == rows_of(b) and a.count() == 4


def test_archives_are_read_in_place_and_in_blocks(spark, tmp_path, monkeypatch):
    """No rows of archives and no exchange; small archives share a partition, and a batch holds a block of lines."""
    from tradebars.sources import archives

    lines = [f"{i},1.5,2,1,1,1704067200000,true" for i in range(5000)]
    for month in ("2024-01", "2024-02", "2024-03"):
        with zipfile.ZipFile(tmp_path / f"ETH-aggTrades-{month}.zip", "w") as z:
            z.writestr("first.csv", "\r\n".join(lines) + "\n")
            z.writestr("second.csv", "99,1,1,1,1,1,true\n")
    with zipfile.ZipFile(tmp_path / "ETH-aggTrades-2024-04.zip", "w"):
        pass
    read = files.read_zipped_lines(spark, f"{tmp_path}/*.zip")
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "binaryFile" not in plan.lower() and read.rdd.getNumPartitions() == 1
    assert files.parse_trades(read).count() == 15_000 and read.where("line like '%\r'").isEmpty()
    monkeypatch.setattr(archives, "BLOCK", 1000)
    path = f"{tmp_path}/ETH-aggTrades-2024-01.zip"
    sizes = [b.num_rows for b in archives.lines_of(open(path, "rb"), path)]
    assert sum(sizes) == 5000 and max(sizes) < 100
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1")
        assert len(archives.listed(spark, [f"{tmp_path}/*.zip"])) == 4
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert not archives.opened("viewfs://store/x.zip") and archives.opened(f"file:{path}")


def test_binary_rows_of_archives_give_the_same(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "ETH-aggTrades-2024-02.zip", "w") as z:
        z.writestr("first.csv", LINES)
    rows = files.unzip_lines(spark.read.format("binaryFile").load(f"{tmp_path}/*.zip"))
    assert "Exchange" not in rows._jdf.queryExecution().executedPlan().toString()
    assert rows_of(rows.select("line")) == rows_of(files.read_zipped_lines(spark, f"{tmp_path}/*.zip").select("line"))


def test_counts_come_with_the_one_pass(spark, tmp_path):
    path = tmp_path / "BTC-aggTrades-2024-01.csv"
    path.write_text(LINES)
    trades, counts = files.parse_counted(files.read_lines(spark, str(path)))
    assert trades._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    trades.write.parquet(f"{tmp_path}/out")
    assert counts.trades == 4 == spark.read.parquet(f"{tmp_path}/out").count()
    assert counts.all == {"n_lines": 13, "n_trades": 4, "n_columns": 1, "n_agg_id": 2, "n_price": 4, "n_qty": 1, "n_time": 1, "n_symbol": 0}


def test_discover_months(spark, tmp_path):
    for name in ("A-aggTrades-2024-02.zip", "A-aggTrades-2023-12.zip", "A-aggTrades-2024-02.csv", "B-aggTrades-2024-01.zip", "notes.txt"):
        (tmp_path / name).write_text("x")
    out = {r.symbol: (r.months, r.first_month, r.last_month) for r in files.discover_months(spark, str(tmp_path)).collect()}
    assert out == {"A": (["2023-12", "2024-02"], "2023-12", "2024-02"), "B": (["2024-01"], "2024-01", "2024-01")}


def test_parquet_round_trip(spark, tmp_path):
    b = B.hourly_bars(many(spark))
    files.write_bars(b, f"{tmp_path}/bars")
    back = spark.read.parquet(f"{tmp_path}/bars").select(*b.columns)
    assert rows_of(back) == rows_of(b)
    stats = files.parquet_stats(spark, f"{tmp_path}/bars").first()
    assert stats.n_rows == b.count() and stats.n_bytes > 0


def test_json_round_trip_and_broken_file(spark, tmp_path):
    b = bars(spark, [0, 1, 800], n_trades=lambda h: h, vwap=lambda h: h / 3)
    files.write_month_json(b, f"{tmp_path}/json")
    folder = tmp_path / "json" / "symbol=S" / "month=2024-03"
    folder.mkdir()
    (folder / "part-broken.txt").write_text("{bad")
    assert rows_of(files.read_month_json(spark, f"{tmp_path}/json").select(*b.columns)) == rows_of(b)


def test_threshold_state_round_trip(spark, tmp_path):
    t = many(spark)
    files.write_samples(H.daily_sample(t, 30), H.day_counts(t), f"{tmp_path}/state")
    back = files.read_samples(spark, f"{tmp_path}/state")
    assert rows_of(back.select("symbol", "date", "qty")) == rows_of(H.daily_sample(t, 30).select("symbol", "date", "qty"))


def test_symbol_of_files_without_one(spark, tmp_path):
    """The name's symbol, or the one given; with neither the lines are rejected, so no trade is without a symbol."""
    (tmp_path / "BTCUSDT.csv").write_text("1,100.5,0.25,1,1,1704067200000,true\n \t2,101.0,5.0,2,3,1704067200000,False\t\n")
    lines = files.read_lines(spark, f"{tmp_path}/BTCUSDT.csv")
    assert files.parse_trades(lines).count() == 0 and {r.reason for r in files.rejected_lines(lines).collect()} == {"symbol"}
    assert {(r.symbol, r.agg_id) for r in files.parse_trades(lines, "BTC").collect()} == {("BTC", 1), ("BTC", 2)}
    assert files.rejected_lines(lines, "BTC").count() == 0


def test_session_setting_outlives_writing(spark, tmp_path):
    name = "spark.sql.parquet.outputTimestampType"
    before = spark.conf.get(name)
    files.write_bars(bars(spark, [0, 1]), f"{tmp_path}/bars")
    assert spark.conf.get(name) == before


def test_missing_month_file_gives_nothing(spark, tmp_path):
    none = files.read_month_json(spark, f"{tmp_path}/nowhere")
    assert none.count() == 0 and "vwap" in none.columns


def test_bootstrap_record(spark, tmp_path):
    t = many(spark)
    limits = H.thresholds(t, bootstrap_n=50)
    files.write_bootstrap(limits, f"{tmp_path}/record")
    want = {(r.symbol, r.p99) for r in limits.where("source = 'bootstrap'").collect()}
    assert want and {(r.symbol, r.p99) for r in files.read_bootstrap(spark, f"{tmp_path}/record").collect()} == want
    files.write_bootstrap(H.thresholds(t, bootstrap_n=10**6), f"{tmp_path}/record")
    assert files.read_bootstrap(spark, f"{tmp_path}/record").count() == 0
