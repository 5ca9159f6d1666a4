from datetime import datetime, timedelta

from gantry.sources.partitioned import inventory, read_tree, upsert_tree, write_tree
from gantry.streaming.bars import stream_bars

SCHEMA = "ticker string, ts timestamp, price double, size long, seq long"


def ticks():
    t0 = datetime(2024, 1, 2, 14, 30)
    rows = [(k, t0 + timedelta(seconds=20 * i), 10.0 + (i * 7) % 5, i, i) for k in ("A", "B") for i in range(9)]
    return [*rows, rows[3], ("A", datetime(2024, 3, 1), 1.0, 1, 99)]


def test_tree_round_trip_prunes_folders(spark, tmp_path):
    df = spark.createDataFrame(ticks(), SCHEMA)
    write_tree(df, f"{tmp_path}/t")
    back = read_tree(spark, f"{tmp_path}/t", SCHEMA)
    assert sorted(map(tuple, back.select(*df.columns).collect())) == sorted(map(tuple, df.collect()))
    march = back.filter("ticker = 'A' AND month = 3")
    assert [r.seq for r in march.collect()] == [99]
    assert "PartitionFilters: [isnotnull(ticker" in march._jdf.queryExecution().toString()
    files = inventory(spark, f"{tmp_path}/t").collect()
    assert {(r.ticker, r.year, r.month) for r in files} == {("A", 2024, 1), ("B", 2024, 1), ("A", 2024, 3)} and all(r.size > 0 for r in files)


def test_stream_gives_the_batch_bars(spark, tmp_path):
    df = spark.createDataFrame(ticks(), SCHEMA)
    df.coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = stream_bars(spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/in"), ["ticker"])
    run = stream.writeStream.outputMode("complete").format("memory").queryName("bars").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
    run.awaitTermination(120)
    got = sorted(map(tuple, spark.table("bars").collect()))
    assert got == sorted(map(tuple, stream_bars(df, ["ticker"]).collect())) and len(got) == 7
    first = next(r for r in got if r[0] == "A")
    assert first[2:] == (10.0, 14.0, 10.0, 14.0, 3, 3)


def test_writes_replace_touched_folders_only(spark, tmp_path):
    df, root = spark.createDataFrame(ticks(), SCHEMA), f"{tmp_path}/t"
    write_tree(df, root)
    write_tree(df.filter("ticker = 'B' AND seq < 3"), root)
    back = read_tree(spark, root, SCHEMA)
    assert {r.ticker: r.n for r in back.groupBy("ticker").agg({"*": "count"}).withColumnRenamed("count(1)", "n").collect()} == {"A": 11, "B": 3}
    change = spark.createDataFrame([("A", datetime(2024, 1, 2, 15), 7.0, 1, 4), ("A", datetime(2024, 1, 2, 16), 8.0, 1, 50)], SCHEMA)
    upsert_tree(change, root, ["ticker", "seq"], SCHEMA, prune=True)
    rows = read_tree(spark, root, SCHEMA).collect()
    assert {r.seq for r in rows if r.ticker == "A"} == {0, 1, 2, 3, 4, 5, 6, 7, 8, 50}  # March is pruned
    assert [r.price for r in rows if r.ticker == "A" and r.seq == 4] == [7.0] and sum(r.ticker == "B" for r in rows) == 3
