from lattica.operators import components, ranking
from lattica.streaming import events


def test_stream_equals_batch(spark, sf, tmp_path):
    batch = spark.read.parquet(f"{sf}/events.parquet")
    batch.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(batch.schema).parquet(str(tmp_path / "in"))
    q = events.tumbling(stream, "1 hour", late="3650 days").writeStream.format("memory").queryName("tumbling").outputMode("complete").option("checkpointLocation", str(tmp_path / "c")).start()
    q.processAllAvailable()
    q.stop()
    key = lambda r: (r["window_start"], r["event_type"], r["n"], round(r["value_sum"], 4))
    assert sorted(map(key, spark.table("tumbling").collect())) == sorted(map(key, events.tumbling(batch, "1 hour").collect()))


def test_totals_are_metamorphic(spark):
    rows = [("a", 1, 5, "observed"), ("a", 2, 0, "observed_zero"), ("b", 1, 7, "observed"), ("b", 2, None, "suppressed")]
    df = spark.createDataFrame(rows, "g string, k int, v long, s string")
    total = lambda d: {r["g"]: (r["total"], r["missing"]) for r in components.complete_case(d, ["g"], "v", "s", "k").collect()}
    assert total(df) == {"a": (5, ""), "b": (None, "2:suppressed")} == total(df.orderBy("v"))
    ranked = ranking.competition_rank(spark.createDataFrame([(1, 5), (2, 5), (3, 1), (4, None)], "i int, v long"), "v")
    assert {r["i"]: r["rank"] for r in ranked.collect()} == {1: 1, 2: 1, 3: 3, 4: None}
    up = ranking.competition_rank(spark.createDataFrame([(1, 5), (2, 5), (3, 1), (4, None)], "i int, v long"), "v", descending=False)
    assert {r["i"]: r["rank"] for r in up.collect()} == {1: 2, 2: 2, 3: 1, 4: None}
