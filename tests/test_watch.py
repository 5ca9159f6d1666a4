from datetime import datetime, timedelta


from gantry.streaming import files as S
from gantry.streaming import watch as W

T0 = datetime(2024, 1, 1)


def run(spark, root, batches):
    """Each batch is a restart from the checkpoint; what has been emitted after each."""
    seen = []
    for i, rows in enumerate(batches):
        df = spark.createDataFrame([(k, T0 + timedelta(minutes=m), n) for k, m, n in rows], "k string, at timestamp, n int")
        df.coalesce(1).write.mode("append").parquet(f"{root}/in")
        stream = W.stall_alarms(S.discovered(spark, f"{root}/in", "k string, at timestamp, n int"), "k", "at", 600, "n")
        S.drained(stream, f"{root}/out", f"{root}/checkpoint")
        out = spark.read.schema("key string, state string, at timestamp_ntz, last timestamp_ntz, pending long").parquet(f"{root}/out")
        seen.append(sorted((r["key"], r["state"], (r["at"] - T0).total_seconds() / 60, r["pending"]) for r in out.collect()))
    return seen


def test_silence_raises_one_alarm_and_one_recovery(spark, tmp_path):
    batches = [[("a", 0, 2), ("b", 0, 0)], [("b", 9, 0)], [("b", 15, 0)], [], [("b", 24, 0), ("a", 25, -1)], [("b", 30, 0)], []]
    seen = run(spark, tmp_path, batches)
    assert seen[1] == [] and seen[2] == [("a", "stalled", 10, 2)]
    assert seen[3] == seen[2]  # nothing new: no second alarm
    assert seen[4] == [("a", "recovered", 25, 2), ("a", "stalled", 10, 2)]
    assert seen[6] == seen[4]


def test_alarms_do_not_depend_on_batches(spark, tmp_path):
    rows = [("a", m, 1) for m in (0, 3, 20, 21, 50)] + [("b", m, 0) for m in range(0, 70, 5)]
    rows.sort(key=lambda r: r[1])
    whole = run(spark, tmp_path / "1", [rows])[-1]
    assert whole == run(spark, tmp_path / "2", [rows[:7], rows[7:11], rows[11:]])[-1]
    assert [x for x in whole if x[1] == "stalled"] == [("a", "stalled", 13, 2), ("a", "stalled", 31, 4), ("a", "stalled", 60, 5)]


def test_latest_rows_in_versions(spark, tmp_path):
    from gantry.sources import versioned as V

    def go():
        S.latest_per_key(S.discovered(spark, f"{tmp_path}/in", "k string, at long").drop("path"), f"{tmp_path}/t", f"{tmp_path}/c", ["k"], "at")
        return sorted(map(tuple, V.read(spark, f"{tmp_path}/t").collect()))

    put = lambda rows: spark.createDataFrame(rows, "k string, at long").write.mode("append").parquet(f"{tmp_path}/in")
    put([("a", 1), ("b", 5), ("a", 2)])
    assert go() == [("a", 2), ("b", 5)]
    put([("a", 1), ("c", 1)])
    assert go() == [("a", 2), ("b", 5), ("c", 1)]
    version = V.manifest(spark, f"{tmp_path}/t").version
    assert go() == [("a", 2), ("b", 5), ("c", 1)] and V.manifest(spark, f"{tmp_path}/t").version == version
    assert len(V.versions(spark, f"{tmp_path}/t")) <= 2
