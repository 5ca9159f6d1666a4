from gantry.streaming import files as S


def test_nulls_are_one_state(spark, tmp_path):
    """A null is a value of its own: logged once, also over batches."""
    for rows in ([(1, 2, "a"), (1, 1, "a"), (2, 1, None), (2, 2, None)], [(1, 3, "b"), (2, 3, None), (2, 4, "a"), (1, 4, "b")]):
        spark.createDataFrame(rows, "k long, at long, v string").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        found = S.discovered(spark, f"{tmp_path}/in", "k long, at long, v string")
        S.drained(S.changes(found, "k", "v", "at"), f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    got = sorted((r["key"], r["at"], r["value"]) for r in spark.read.parquet(f"{tmp_path}/out").collect())
    assert got == [("1", 1, "a"), ("1", 3, "b"), ("2", 1, None), ("2", 4, "a")]
